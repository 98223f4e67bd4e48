import numpy as np
from pyspark.sql import functions as F

from salesguard.llm import langid, queries

KIND = "doc_id long, text string, lang string"


def test_subwords_stay_in_words_and_pieces_agree():
    whole = np.sort(langid.subwords(b"abcd efg"))
    parts = np.sort(np.concatenate([langid.subwords(b"abcd"), langid.subwords(b"efg")]))
    assert (whole == parts).all() and len(langid.subwords(b"")) == 0
    assert (np.sort(langid.subwords(b"ABcd 12")) == np.sort(langid.subwords(b"abcd"))).all()


def test_gradient_descent_learns_and_calibrates():
    rows = [(b"lala lulu lilo " * 5, "x"), (b"kork kirk kurk " * 5, "y")] * 60
    model = langid.train(rows)
    assert model.predict(b"lalu")[0] == "x" and model.predict(b"kurk korik")[0] == "y"
    assert 0 <= model.threshold <= 1 and langid.train([]) is None
    long = b"lala lulu " * 200_000
    assert model.predict(long)[0] == "x"


def test_held_out_accuracy_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_subword_language(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.join(truth, "doc_id").where("held_out")
    right, n = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right >= 0.97


def test_null_blank_and_clashing_columns(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "en"), (4, "the thing", "en"), (4, "the thing", "en"), (5, "Ωμέγα", None), (None, "x", None)]
    df = spark.createDataFrame(rows, KIND).withColumns({"score": F.lit("s"), "_text": F.lit(0)})
    model = langid.train([(b"the thing " * 9, "en"), (b"der ding " * 9, "de")] * 20)
    got = langid.identify(df, model).collect()
    assert len(got) == 7 and {r.doc_id: r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == dict.fromkeys((1, 2, 3), "und")
    assert all(0 <= r.score <= 1 for r in got) and all(r.lang_pred in ("en", "de") for r in got if r.doc_id in (4, 5, None))
    assert [r.lang_pred for r in langid.identify(df, None).collect()] == ["und"] * 7
    none = df.limit(0)
    assert langid.identify(none, model).collect() == [] and langid.fit(none, F.lit(True)) is None


ENGLISH = "the thing and what they thought of this weather there"
GERMAN = "der ding und was sie dachten von diesem wetter dort"


def test_long_texts_take_part(spark):
    rows = [(k, " ".join(x.split()[(k + j) % 9] for j in range(8_000)), y) for k in range(30) for x, y in ((ENGLISH, "en"), (GERMAN, "de"))]
    assert min(len(t) for _, t, _ in rows) > 40_000
    df = spark.createDataFrame(rows, KIND)
    got = langid.identify(df, langid.fit(df, F.lit(True))).collect()
    assert all(r.lang_pred == r.lang and r.score > 0 for r in got) and len(got) == 60


def test_slices_reach_from_begin_to_end():
    raw = bytes(range(97, 123)) * 10_000
    got = langid.spread_slices(raw)
    assert len(got) < 50_000 and got.startswith(raw[:1000]) and got.endswith(raw[-1000:])
    assert langid.spread_slices(raw[:40_000]) == raw[:40_000]


def test_a_repeated_id_neither_fills_the_sample_nor_crowds_others_out(spark, monkeypatch):
    copies = [(7, ENGLISH, "en")] * 3_000 + [(8, f"{GERMAN} {k}", "de") for k in range(3_000)]
    others = [(100 + k, f"{ENGLISH} {'weather they'.split()[k % 2]} {k}", "en") for k in range(200)]
    df = spark.createDataFrame(copies + others + [(None, ENGLISH, "en"), (None, GERMAN, "de")], KIND).repartition(4)
    seen = []
    real = langid.train
    path = __import__("tempfile").mkdtemp() + "/seen"

    def train(rows):
        open(path, "w").write("\n".join(f"{y}" for _, y in rows))
        return real(rows)

    monkeypatch.setattr(langid, "train", train)
    model = langid.fit(df, F.lit(True), per_lang=150, in_all=280)
    seen = open(path).read().split()
    assert len(seen) <= 280 and 100 <= seen.count("en") <= 201 and 100 <= seen.count("de") <= 200
    assert model.predict(ENGLISH.encode())[0] == "en" and model.predict(GERMAN.encode())[0] == "de"
