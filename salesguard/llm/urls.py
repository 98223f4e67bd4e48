"""URL filter: longest-match rules first, gradient-boosted trees for the rest.

The trees see lexical features only (lengths, depth, digit ratio, character
entropy, parameter counts, suffix statistics). They are fitted on URLs that
carry a label, by default those a rule decides. All of it is DataFrame
expressions and ``pyspark.ml``; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.llm.columns import ascii_lower, need

FEATURES = ["n_chars", "n_host", "n_path", "n_rest", "depth", "n_labels", "digit_ratio", "host_digits", "entropy",
            "host_entropy", "n_params", "n_hyphens", "n_escapes", "is_https", "longest_label", "top_rate",
            "site_rate", "head_rate"]
#: Distinct labelled URLs used to fit the trees at most: the smallest by a hash of the URL.
FIT_ROWS = 20_000


def parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both empty for a null URL or one without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return (df.withColumn("host", ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def rule_column(rules: list[tuple[str, str]], host: Column, path: Column, value: int) -> Column:
    """The longest rule that fits (``value`` 0: its text, 1: its verdict); null if none does.

    A rule is ``host/path``. It fits its host and every subdomain if the URL's
    path starts with the rule's. Equal lengths go by text.
    """
    out = None
    for text, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        result = F.lit((text, verdict)[value])
        out = F.when(fits, result) if out is None else out.when(fits, result)
    return F.lit(None).cast("string") if out is None else out


def _entropy(s: Column) -> Column:
    n = F.length(s)
    share = lambda c: (n - F.length(F.replace(s, c))) / n
    return F.coalesce(F.aggregate(F.array_distinct(F.split(s, "")), F.lit(0.0),
                                  lambda acc, c: acc - F.when(c != "", share(c) * F.log2(share(c))).otherwise(0.0)),
                      F.lit(0.0))


def _count(s: Column, chars: str) -> Column:
    return (F.length(s) - F.length(F.translate(s, chars, ""))).cast("double")


def lexical(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds the lexical features that need no statistics, and the suffix keys."""
    u = F.coalesce(F.col(url), F.lit(""))
    h, p = F.col("host"), F.col("path")
    n, nh = F.length(u), F.length(h)
    labels = F.split(h, r"\.")
    head = F.regexp_extract(p, r"^/([^/]*)/", 1)
    return df.withColumns({
        "n_chars": n.cast("double"), "n_host": nh.cast("double"), "n_path": F.length(p).cast("double"),
        "n_rest": (n - nh - F.length(p)).cast("double"), "depth": _count(p, "/"),
        "n_labels": _count(h, "."),
        "digit_ratio": F.when(n > 0, _count(u, "0123456789") / n).otherwise(0.0),
        "host_digits": _count(h, "0123456789"), "entropy": _entropy(u), "host_entropy": _entropy(h),
        "n_params": _count(u, "=&"), "n_hyphens": _count(h, "-_"), "n_escapes": _count(u, "%@~;"),
        "is_https": u.startswith("https:").cast("double"),
        "longest_label": F.array_max(F.transform(labels, F.length)).cast("double"),
        "top": F.element_at(labels, -1),
        "site": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "head": F.when(F.length(head) <= 3, head).otherwise(F.lit("")),
    })


def suffix_rates(labelled: DataFrame, key: str, name: str, base: float, label: str = "label", prior: float = 4.0) -> DataFrame:
    """Share of blocked URLs for each value of ``key`` among the labelled, smoothed
    towards ``base``, that of all. A row of ``labelled`` stands for ``n`` URLs with the sum ``label``."""
    by = labelled.groupBy(key).agg(F.sum(label).alias("_s"), F.sum("n").alias("_n"))
    return by.select(key, ((F.col("_s") + F.lit(prior * base)) / (F.col("_n") + prior)).alias(name))


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, id_col: str = "page_id",
          url: str = "url", fit_rows: int = FIT_ROWS, trees: int = 12, depth: int = 4, step: float = 0.3,
          seed: int = 7) -> DataFrame:
    """``id_col, host, path, rule, verdict, p_block`` for every row of ``pages``.

    ``labelled`` has ``url`` and ``label`` (1: block); by default the URLs that
    a rule decides serve. The suffix statistics are of all of them. The trees are
    fitted on at most ``fit_rows`` distinct pairs of URL and label, those with the
    smallest hash (ties by URL), weighted by their counts. A rule's verdict wins
    over theirs; elsewhere ``p_block >= 0.5`` blocks.

    Null or odd URLs have an empty host and path and are judged by the trees.
    With no labelled URL, or labels of one class only, the score is the share
    of blocked labels (0 if there are none). Repeated rows are each judged;
    extra columns are not read. An empty table gives no rows.
    """
    base = parts(need(pages, id_col, url).select(F.col(id_col).alias("_id"), F.col(url).alias("url")))
    base = base.withColumn("rule", rule_column(rules, F.col("host"), F.col("path"), 0)) \
               .withColumn("ruled", rule_column(rules, F.col("host"), F.col("path"), 1))
    if labelled is None:
        known = base.where("ruled is not null").select("url", "host", "path",
                                                       (F.col("ruled") == "block").cast("double").alias("label"))
    else:
        known = parts(need(labelled, "url", "label")).select("url", "host", "path",
                                                             F.col("label").cast("double").alias("label")) \
            .where("label is not null")
    # A URL's copies become one row with a count before anything else is done with them.
    known = known.groupBy("url", "host", "path", "label").agg(F.count("*").alias("n")).checkpoint()
    sums = (lexical(known).groupBy("top", "site", "head")
            .agg(F.sum(F.col("label") * F.col("n")).alias("label"), F.sum("n").alias("n")).checkpoint())
    seen = sums.agg((F.sum("label") / F.sum("n")).alias("a")).first()
    share = seen["a"] or 0.0
    rates = [(k, n, suffix_rates(sums, k, n, share)) for k, n in
             (("top", "top_rate"), ("site", "site_rate"), ("head", "head_rate"))]
    sample = lexical(known.orderBy(F.xxhash64("url"), "url", "label").limit(fit_rows)).withColumn(
        "_weight", F.col("n").cast("double"))

    def with_rates(df: DataFrame) -> DataFrame:
        for key, name, rate in rates:
            df = df.join(rate, key, "left").fillna({name: share})
        return df

    vector = VectorAssembler(inputCols=FEATURES, outputCol="_features")
    full = with_rates(lexical(base))
    if 0.0 < share < 1.0:
        model = GBTClassifier(featuresCol="_features", labelCol="label", predictionCol="_class",
                              weightCol="_weight", maxIter=trees, maxDepth=depth,
                              stepSize=step, seed=seed, maxBins=32)
        fitted = model.fit(vector.transform(with_rates(sample)).select("_features", "label", "_weight"))
        scored = trees_column(fitted)
        full = full.withColumn("p_block", F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * scored)))
    else:
        full = full.withColumn("p_block", F.lit(float(share)))
    verdict = F.coalesce("ruled", F.when(F.col("p_block") >= 0.5, "block").otherwise("allow"))
    return full.select(F.col("_id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "p_block")


def trees_column(model) -> Column:
    """The fitted ensemble's margin as one expression: a CASE per tree over the features."""

    def node(jn) -> Column:
        if jn.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(jn.prediction()))
        split = jn.split()
        return (F.when(F.col(FEATURES[split.featureIndex()]) <= split.threshold(), node(jn.leftChild()))
                .otherwise(node(jn.rightChild())))

    terms = [node(t._java_obj.rootNode()) * float(w)
             for t, w in zip(model.trees, model.treeWeights, strict=True)]
    return reduce(lambda a, b: a + b, terms)
