import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from salesguard.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = pieces.Vocabulary(PATH)
PARTS = ["a", "the", "ing", "tion", "的", "é", "😀", "<s>", "<0x0A>", "\x00", "한", "་", "̀", "\r", "\t", " ", "  ", "   ",
         "\n", "\n\n", "▁", "Zürich", "don't", "12345", "　", " "]


def own(text):
    return pieces.Encoder(VOCABULARY).encode([text], LIBRARY)[0]


def check(text):
    ids, want = own(text), LIBRARY.encode(text)
    assert ids.tolist() == want
    back = VOCABULARY.decode_all(ids.astype(np.int32), np.array([0, 0, len(ids), len(ids)])).to_pylist()
    assert back == ["", LIBRARY.decode(want) if want else "", ""]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40).filter(lambda s: s.isprintable() or s.isascii()))
def test_any_text(text):
    check(text)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=30))
def test_odd_parts(parts):
    check("".join(parts))


def test_every_white_space_and_long_words():
    white = [chr(c) for c in range(0x10000) if chr(c).isspace()]
    assert len(white) > 20
    for w in white:
        for text in (w, w + w, f"a{w}b", f"{w}a", f"a{w}", f"a {w}b", f"a{w} b", f"{w} {w}"):
            check(text)
    rng = random.Random(3)
    check("".join(rng.choice("abcdeéх的") for _ in range(20_000)))
    check(" " * 5_000 + "x" * 5_000 + "\n" * 500)


def test_decode_of_any_ids():
    rng = random.Random(5)
    for _ in range(5_000):
        ids = [rng.choice([rng.randrange(3, 259), rng.randrange(0, 4), rng.randrange(0, 32_000), 259])
               for _ in range(rng.randrange(1, 8))]
        assert VOCABULARY.decode(np.array(ids)) == LIBRARY.decode(ids), ids
        assert VOCABULARY.decode_all(np.array(ids * 2, np.int32), np.array([0, len(ids), 2 * len(ids)])).to_pylist() == [LIBRARY.decode(ids)] * 2


@pytest.mark.parametrize("group", [1, 25, 1 << 22])
def test_groups_of_texts(monkeypatch, group):
    texts = ["one two three four five six one two three", "", "two  one\n\nseven 😀", "three " + "x" * 100, " lead", "\n", "é", "a\nb c",
             "tail ", "  ", "x" * 70 + " 😀"]
    monkeypatch.setattr(pieces.units, "GROUP", group)
    ids, ends = pieces.Encoder(VOCABULARY).encode(texts * 2, LIBRARY)
    assert [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:])] == LIBRARY.encode(texts * 2)
    none, ends = pieces.Encoder(VOCABULARY).encode([])
    assert len(none) == 0 and ends.tolist() == [0]


def test_units_side_by_side_and_one_by_one():
    rng = random.Random(7)
    units = ["".join(rng.choice("aeinrst▁ ée的😀\n1") for _ in range(rng.randrange(1, 20))) for _ in range(3000)]
    symbols, counts = VOCABULARY.merge_units(units)
    at = 0
    for u, n in zip(units, counts.tolist()):
        want = VOCABULARY.merge(list(u.replace(" ", "▁")))
        got = symbols[at:at + n].tolist()
        assert len(want) == n and [VOCABULARY.pieces.get(x, VOCABULARY.symbols[ord(x)] if len(x) == 1 else None) for x in want] == got
        at += n


def test_rows(spark, monkeypatch):
    long = "word \n" * 60_000
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "Hello  world", "y", 2), (3, "Hello  world", "y", 2), (None, long, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, `a b` int")
    monkeypatch.setattr(pieces, "BATCH_IDS", 4)
    out = pieces.encode(docs, PATH, decoded=True)
    assert out.columns == ["doc_id", "text", "a b", "ids", "decoded"]
    got = sorted(out.collect(), key=str)
    assert len(got) == 5
    for r in got:
        assert r.ids == LIBRARY.encode(r.text or "") and r.decoded == (r.text or "")
    assert sorted(pieces.encode(docs, PATH, decoded=True, check="texts").collect(), key=str) == got
    back = pieces.decode(out.drop("decoded"), PATH)
    assert sorted(back.collect(), key=str) == got
    few = pieces.encode(docs, PATH, columns=["doc_id"], check=None)
    assert few.columns == ["doc_id", "ids"] and few.count() == 5
    none = pieces.encode(docs.where("false"), PATH, decoded=True)
    assert none.collect() == [] and pieces.decode(none, PATH).collect() == []


def test_decode_rows(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 259, None]), (4, [229, 0])], "k int, ids array<int>")
    got = {r.k: r.decoded for r in pieces.decode(rows, PATH).collect()}
    assert got == {1: "", 2: "", 3: " ", 4: LIBRARY.decode([229, 0])}
    with pytest.raises(Exception, match="outside the vocabulary"):
        pieces.decode(spark.createDataFrame([(1, [32_000])], "k int, ids array<int>"), PATH).collect()


def test_a_difference_is_an_error():
    with pytest.raises(AssertionError, match="differ"):
        pieces._same_texts(LIBRARY, ["one"], np.array([1]), np.array([0, 1]), None)
    keys = ["one", "\none", "", " ", "  x", "\n", "\n\n", "é的😀", "x" * 100, "\t", "two"]
    ids, at = pieces.Encoder(VOCABULARY).units(keys)
    pieces._same_units(LIBRARY, keys, ids, at)
    for k in (0, 1, 3, len(keys) - 1):
        other = ids.copy()
        other[at[k]] += 1
        with pytest.raises(AssertionError, match="differ"):
            pieces._same_units(LIBRARY, keys, other, at)
    with pytest.raises(AssertionError, match="differ"):
        pieces._same_units(LIBRARY, keys, np.r_[ids, 5], np.r_[at[:-1], at[-1] + 1])


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb
    spec = pb.ModelProto()
    spec.ParseFromString(open(PATH, "rb").read())
    spec.trainer_spec.model_type = spec.trainer_spec.UNIGRAM
    (tmp_path / "m.model").write_bytes(spec.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        pieces.Vocabulary(str(tmp_path / "m.model"))
