import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesguard.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
KIND = "doc_id long, text string, source string"
TEXTS = ["", "a", " a", "a ", "two  blanks", "The cat's hat, isn't it?\nNew line", "\n\nlines\n\n\nmore", "tab\there", "x\r\ny", "É été ße 123 4567!",
         "<|endoftext|> within <|endoftext|>", "日本語 text 🙂 emoji", "nbsp here  em", "under_score __x__ 1st 2nd ½ ²", "'s 'll we'll  'x",
         "Les.\nEn laleenéelle la des et.", "a" * 500, "​ zero", "tail \n", "\x1c odd \x85 sep", "ﬁ ligature İ ǅ"]


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(PATH)


def same(ids, slow, texts):
    for t, got in zip(texts, ids.encode(texts), strict=True):
        assert np.frombuffer(got, np.uint16).tolist() == slow.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("group", [1, 30, 1 << 22])
def test_ids_are_the_tokenizers(slow, monkeypatch, group):
    monkeypatch.setattr(packing.units, "GROUP", group)
    ids = packing.Ids(PATH)
    assert ids.encode([]) == []
    for sep in (" ", "\n", "\n\n"):
        same(ids, slow, TEXTS + [x + sep + y for x in TEXTS for y in TEXTS])


def test_every_white_space(slow):
    white = [chr(c) for c in range(0x11000) if chr(c).isspace()]
    assert {"\x1c", "\x85", "\u2028", "\u3000"} < set(white)
    ids = packing.Ids(PATH)
    for w in white:
        same(ids, slow, [w, f"a{w}b", f"a {w}b c", f"a{w} b", f"a{w}{w}b", f"{w}a", f"a{w}", f"a{w}b  c", f"a{w}b\n\nc", f"a{w}1's {w}"])
    odd = [f"a{x}b{y}c" for x in [" ", "\n", "  ", "\t", " \t", "\u2003", ""] for y in [" ", "\n", " \n", "\t\t", "\x0b", ""]]
    same(ids, slow, odd)
    assert [t for t in odd if packing.plain(t)] == [f"a{x}b{y}c" for x in (" ", "\n", "") for y in (" ", "\n", "")]


def test_place_is_a_permutation_that_keeps_the_mixture():
    for totals, weights in (({"a": 100_000, "b": 40_000, "c": 3_000, "": 77}, None), ({"a": 5_000, "b": 5_000}, {"a": 3.0, "b": 1.0}),
                            ({"x": 1}, None), ({"a": 1024, "b": 1024}, {"a": 1.0}), ({}, None)):
        plan = packing.Plan(totals, weights)
        at = [plan.place(s, np.arange(totals[n])) for s, n in enumerate(plan.names)]
        every = np.concatenate([*at, np.empty(0, np.int64)])
        assert sorted(every.tolist()) == list(range(plan.total))
        if weights is None and totals.get("a", 0) > 50_000:
            share = {s: totals[n] / plan.total for s, n in enumerate(plan.names)}
            for s, x in enumerate(at):                     # the bound of the docstring, and a slot for the tails
                for end in range(1024, plan.slots * plan.slot, 1024):
                    assert abs((x < end).sum() - share[s] * end) <= (1.5 + share[s] * len(at) / 2) * plan.slot


def pack(spark, rows, **more):
    df = spark.createDataFrame(rows, KIND).repartition(3).withColumns({"ids": F.lit(1), "chunk": F.lit("c"), "start": F.lit(0)})
    return packing.pack(df, PATH, **more).collect()


def test_pieces_hold_each_id_once_without_padding(spark, slow):
    rows = [(k, t, f"s{k % 3}" if k % 5 else None) for k, t in enumerate(TEXTS * 3 + ["many words here " * 900, None])]
    pieces = pack(spark, rows)
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
    for k, t, _ in rows:
        want = [*slow.encode(t or "", add_special_tokens=False).ids, 0]
        parts = sorted(by_doc[k], key=lambda p: p.start)
        assert [p.start for p in parts] == np.r_[0, np.cumsum([p.length for p in parts])[:-1]].tolist()
        assert {p.doc_tokens for p in parts} == {len(want)}
        raw = b"".join(bytes(p.ids) for p in parts)
        assert raw == struct.pack(f"<{len(want)}I", *want)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for parts in by_seq.values():
        parts.sort()
        assert [o for o, _ in parts] == np.r_[0, np.cumsum([n for _, n in parts])[:-1]].tolist()
        size = sum(n for _, n in parts)
        assert size <= 1024 and size & (size - 1) == 0     # full, or a power of two


def test_target_weights_fill_windows_until_a_queue_ends(spark):
    rows = [(k, "word " * 200, "ab"[k % 2]) for k in range(200)]
    pieces = pack(spark, rows, weights={"a": 3.0, "b": 1.0})
    got = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        got[p.sequence_id][p.source] += p.length
    for s in range(24):                                    # the queue of a lasts 26 windows
        assert abs(got[s]["a"] - 768) <= 128


def test_repeated_rows_and_empty_tables(spark):
    pieces = pack(spark, [(1, "same", "a"), (1, "same", "a"), (None, None, None)])
    assert sum(p.length for p in pieces if p.doc_id == 1) == 2 * (1 + 1)
    assert [p.length for p in pieces if p.doc_id is None] == [1]
    assert pack(spark, []) == []


def test_query_checksums(spark, slow):
    from pyspark.sql import Row
    from salesguard.llm import queries
    sf = "/root/testdata/sf0.001"
    got = defaultdict(list)
    for r in queries.op2_mixture_packing(spark, sf).collect():
        got[r.doc_id].append(r)
    for d in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = [*slow.encode(d.text, add_special_tokens=False).ids, 0]
        assert isinstance(d, Row) and sum(r.length for r in got[d.doc_id]) == len(ids)
        for r in got[d.doc_id]:
            part = ids[r.start:r.start + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
