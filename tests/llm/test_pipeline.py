import re
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from salesguard.llm import mixing, pii, queries, rules, simhash
from salesguard.session import cut

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = queries.table(spark, SF, "documents")
    out = [docs]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = cut(stage(spark, docs, SF), "t" + name)
        out.append(docs)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == out[0].columns and [f.dataType for f in docs.schema] == [f.dataType for f in out[0].schema]
    return [df.collect() for df in out]


def test_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "pii_surrogates", "source_mixture", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_rules_drop_what_fails_and_keep_labelled_good(stages, spark):
    before, after = stages[0], {r.doc_id: r for r in stages[1]}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    for r in before:
        n, _, _, _, again = __import__("test_rules").plain(r.text)
        if n < 50 or 100 * again > 50 * n:
            assert r.doc_id not in after
        elif r.doc_id in good:
            assert after[r.doc_id] == r
    assert len(after) < len(before)


def test_one_document_of_each_group_stays(stages):
    fps = {r.doc_id: simhash.fingerprint(r.text) for r in stages[1]}
    roots = __import__("test_simhash").groups(fps, 2)
    assert sorted(r.doc_id for r in stages[2]) == sorted(set(roots.values()))
    assert set(stages[2]) <= set(stages[1])


def test_private_data_is_gone(stages):
    before = {r.doc_id: r for r in stages[2]}
    for r in stages[3]:
        found = pii.find(before[r.doc_id].text)
        assert (r.text == before[r.doc_id].text) == (not found) and r.n_chars == len(r.text)
        for a, b, _, _ in found:
            assert before[r.doc_id].text[a:b] not in r.text
        assert len(pii.find(r.text)) == len(found)
    assert len(stages[3]) == len(before)


def test_mixture(stages):
    totals = {}
    for r in stages[3]:
        totals[r.source] = totals.get(r.source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    want = mixing.budgets(totals, mixing.tempered(totals, mixing.solve(totals, max_repeats=2.0)))
    assert set(stages[4]) == set(stages[3])
    for s, n in want.items():
        sizes = [len(r.text.split()) for r in stages[4] if r.source == s]
        assert n <= sum(sizes) < n + max(sizes)


def test_packed_ids(stages):
    slow = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    want = {}
    for r in stages[4]:
        ids = [*slow.encode(r.text, add_special_tokens=False).ids, 0]
        want.setdefault(r.doc_id, []).append(struct.pack(f"<{len(ids)}I", *ids))
    got = {}
    for p in stages[5]:
        got.setdefault(p.doc_id, []).append((p.start, bytes(p.ids)))
    for d, raws in want.items():
        assert sum(map(len, raws)) == sum(len(x) for _, x in got[d])
        for start, x in got[d]:
            assert raws[0][4 * start:4 * start + len(x)] == x
    assert set(got) == set(want)
    ends = {}
    for p in stages[5]:
        ends[p.sequence_id] = ends.get(p.sequence_id, 0) + p.length
    assert all(n <= 1024 and n & (n - 1) == 0 for n in ends.values())
    assert rules.COUNTS


def test_copies_of_a_document_are_an_epoch_apart(spark):
    rows = [(k, f"big {k} " + "w " * (1 + k % 90), "big") for k in range(900)]
    rows += [(1000 + k, f"small {k} " + "w " * (1 + k % 40), "small") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        mixed = cut(corpus_pipeline.source_mixture(spark, docs, SF), "tepochs")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert mixed.columns == docs.columns and len(mixed.inputFiles()) > 1
    pieces = corpus_pipeline.packed(spark, mixed, SF).where("start = 0").collect()
    queue = [p.doc_id for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)) if p.source == "small"]
    assert len(queue) > 100 and len(set(queue[:60])) == 60 and len(set(queue[60:])) == len(queue) - 60
    want = mixing.mix(docs, max_repeats=2.0).where("source = 'small'").orderBy("mix_epoch", "mix_block", "mix_order")
    assert queue == [r.doc_id for r in want.collect()]


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _id int, row string, key string, mix_epoch int, `a b` int, kept string, _t int, n_words string, pii_row int, n_entities int"
LONG = " ".join(f"w{k}" for k in range(30_000)) + " Write to anna.keller@example.org."


def odd_documents(spark):
    def row(i, text, lang="en", source="s"):
        return (i, text, lang, source, None if text is None else len(text), 1, "r", "k", 2, 3, "x", 4, "y", 5, 6)

    good = [" ".join(f"word{k}x{j}" for j in range(80)) for k in range(8)]
    rows = [row(k, t) for k, t in enumerate(good)] + [row(3, good[3]), row(3, good[4]), row(None, good[5] + " more"), row(20, None),
                                                      row(21, ""), row(22, " \n"), row(23, LONG, None, None)]
    return spark.createDataFrame(rows, COLUMNS)


def test_stages_on_odd_documents(spark):
    docs = odd_documents(spark)
    was = {(r.doc_id, r.text): r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema], name
            for r in out.collect():
                if name != "pii_surrogates":
                    assert r == was[r.doc_id, r.text]
                else:
                    assert r[5:14] == was[next(x for x in was if x[0] == r.doc_id)][5:14] and r.n_chars == (None if r.text is None else len(r.text))
        else:
            assert out.count() >= docs.count()
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.quality_rules(spark, docs, SF).collect()}
    assert not any(i in (20, 21, 22) for i, _ in kept) and (23, LONG) in kept
    hidden = {r.doc_id: r.text for r in corpus_pipeline.surrogates(spark, docs, SF).collect()}
    assert "keller" not in hidden[23] and hidden[23].startswith("w0 w1 ") and hidden[20] is None


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_empty_tables(spark, tmp_path, empty):
    for name in ("documents", "labels"):
        df = queries.table(spark, SF, name)
        (df.limit(0) if name == empty else df).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = queries.table(spark, str(tmp_path), "documents")
    if empty == "documents":
        assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, str(tmp_path)).collect() == []
    else:
        kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
        want = set()
        for r in docs.collect():
            n, _, _, _, again = __import__("test_rules").plain(r.text)
            if n >= 50 and 100 * again <= 50 * n:
                want.add(r.doc_id)
        assert kept == want


def test_null_and_repeated_ids_stand_for_their_own_groups(spark):
    def text(k):
        return " ".join(f"w{k}x{j}" for j in range(60))

    rows = [(None, text(1)), (None, text(2)), (None, text(2)), (None, text(3)), (7, text(3)), (5, text(4)), (5, text(5)),
            (5, text(5)), (6, text(4)), (8, text(5)), (9, text(6)), (9, text(6)), (None, None), (10, "")]
    docs = spark.createDataFrame([(*r, f"s{k % 3}" if k % 2 else None) for k, r in enumerate(rows)],
                                 "doc_id long, text string, source string")
    out = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    want = [(None, text(1)), (None, text(2)), (7, text(3)), (5, text(4)), (5, text(5)), (9, text(6)), (10, "")]
    assert got == sorted(want, key=str)
    again = corpus_pipeline.near_duplicates(spark, docs.repartition(5), SF)
    assert sorted(again.collect(), key=str) == sorted(out.collect(), key=str)
