import re

from pyspark.sql import functions as F

from salesguard.llm import urls
from salesguard.llm.queries import RULES


def expected(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = re.match(r"([^/?#]*)([^?#]*)", rest).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for text, verdict in RULES:
        h, _, p = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(text) > len(best[0])):
            best = (text, verdict)
    return host, path, best


URLS = [None, "", "nothing", "http://", "https://Example.ORG/es/1?x=/en/", "http://a.example.org/en/12#z", "http://org/", "http://org",
        "http://notorg/", "x://É.com/fr/", "http://com/de/9", "http://a.com/de", "http://b.com/fr/x\ny", "ftp://example.org?/es/",
        "http://q.example.org/es/", "http://w.net/en/1/2/3?a=1&b=2", "a://b://c.org/", "http://user@x.org:80/", "http://x.org:80/"]


def test_rules_host_and_path(spark):
    df = spark.createDataFrame(list(enumerate(URLS * 2)), "page_id long, url string")
    wide = df.withColumns({"host": F.lit("h"), "rule": F.lit("r"), "verdict": F.lit("v"), "label": F.lit(3)})
    got = urls.judge(wide, RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, best = expected(URLS[r.page_id % len(URLS)])
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def test_trees_learn_lexical_labels(spark):
    rows = []
    for k in range(400):
        spam = k % 2
        rows.append((f"http://{'cheap-pills-' if spam else 'news'}{k}.net/{'9' * 8 if spam else 'story'}/{k}", spam))
    fit, rest = rows[:300], rows[300:]
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rest)], "page_id long, url string")
    got = {r.page_id: r for r in urls.judge(pages, [], spark.createDataFrame(fit, "url string, label int")).collect()}
    right = sum((got[k].verdict == "block") == bool(y) for k, (_, y) in enumerate(rest))
    assert right >= 98 and all(r.rule is None for r in got.values())


def test_no_labels_one_class_and_empty(spark):
    kind = "page_id long, url string"
    pages = spark.createDataFrame([(1, "http://a.net/x"), (None, None)], kind)
    assert {r.verdict for r in urls.judge(pages, []).collect()} == {"allow"}
    one = spark.createDataFrame([("http://b.net", 1), (None, 1), ("c", None)], "url string, label int")
    assert {r.verdict for r in urls.judge(pages, [], one).collect()} == {"block"}
    assert urls.judge(spark.createDataFrame([], kind), RULES).collect() == []


def test_suffix_rates_are_of_all_labelled_urls(spark):
    sites = [("".join(chr(97 + (k * 7919 + 13 * j * j + k * j) % 26) for j in range(8)) + f"{k:03d}", k * 2654435761 % 7 < 3)
             for k in range(240)]
    fit = [(f"http://{s}.net/p/{j}", int(y)) for s, y in sites for j in range(5)]
    pages = spark.createDataFrame([(k, f"http://{s}.net/p/9") for k, (s, _) in enumerate(sites)], "page_id long, url string")
    got = {r.page_id: r.verdict == "block" for r in
           urls.judge(pages, [], spark.createDataFrame(fit, "url string, label int"), fit_rows=60).collect()}
    assert sum(got[k] == y for k, (_, y) in enumerate(sites)) >= 235


def test_copies_of_one_url_do_not_fill_the_sample(spark):
    rows = [(f"http://{'cheap-pills-' if k % 2 else 'news'}{k}.net/{'9' * 8 if k % 2 else 'story'}/{k}", k % 2) for k in range(300)]
    hashed = spark.createDataFrame(rows, "url string, label int").where("label = 1").orderBy(F.xxhash64("url")).first()
    fit = rows[:200] + [(hashed.url, 1)] * 400
    pages = spark.createDataFrame([(k, u) for k, (u, _) in enumerate(rows[200:])], "page_id long, url string")
    got = {r.page_id: r for r in
           urls.judge(pages, [], spark.createDataFrame(fit, "url string, label int"), fit_rows=100).collect()}
    assert sum((got[k].verdict == "block") == bool(y) for k, (_, y) in enumerate(rows[200:])) >= 98


def test_the_expression_is_the_fitted_model(spark):
    """The CASE expression gives the margin and probability of the model's own transform."""
    import random

    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    rng = random.Random(6)
    rows = [tuple(float(rng.randrange(12)) for _ in urls.FEATURES) for _ in range(400)]
    rows = [(*r, float(r[0] + r[1] > r[2] + 9 or r[3] > 10)) for r in rows]
    df = spark.createDataFrame(rows, ", ".join(f"{f} double" for f in urls.FEATURES) + ", label double")
    df = VectorAssembler(inputCols=urls.FEATURES, outputCol="_features").transform(df)
    model = GBTClassifier(featuresCol="_features", labelCol="label", maxIter=6, maxDepth=4, seed=3).fit(df)
    got = model.transform(df).withColumn("own", urls.trees_column(model)).select(
        "own", vector_to_array("rawPrediction")[1].alias("raw"), vector_to_array("probability")[1].alias("p")).collect()
    assert len({r.raw for r in got}) > 5
    for r in got:
        assert abs(r.own - r.raw) < 1e-9 and abs(1 / (1 + 2.718281828459045 ** (-2 * r.own)) - r.p) < 1e-9


def test_long_urls_nulls_and_other_columns(spark):
    rows = [(1, "http://a.org/" + "x" * 100_000, "h"), (2, None, "h"), (3, "", "h"), (4, "no scheme", "h"), (4, "http://b.com/de/", "h"), (None, "://", "h")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string"), RULES).collect()
    assert len(got) == 6 and {r.page_id: r.path for r in got if r.page_id == 1}[1] == "/" + "x" * 100_000
    assert all(r.verdict in ("allow", "block") for r in got) and all(r.host == "" for r in got if r.page_id in (2, 3, None))
