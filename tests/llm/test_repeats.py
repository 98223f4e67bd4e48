import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesguard.llm import repeats
from salesguard.llm.lyndon import batch_of

KIND = "doc_id long, text string"


def brute(texts, size):
    raws, count = [(t or "").encode() for t in texts], Counter()
    for r in raws:
        count.update(r[i:i + size] for i in range(len(r) - size + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, np.int8)
        for i in range(len(r) - size + 1):
            if count[r[i:i + size]] > 1:
                gone[i:i + size] = 1
        edges = np.flatnonzero(np.diff(np.r_[0, gone]))
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append(([(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2], strict=True)], hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_order_equals_sorting():
    rng = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 5)):
            letters = rng.choice([b"a", b"ab", b"abc", b"ab\x00\xff", bytes(range(256))])
            texts.append([bytes(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 4))])
        batch, _ = batch_of(texts)
        order = batch.sort()
        for k, t in enumerate(texts):
            flat = [x for n, s in enumerate(t) for x in [*(c + 1000 for c in s), n]]
            want = sorted(range(len(flat)), key=lambda i: flat[i:])
            a, z = batch.bounds[k], batch.bounds[k + 1]
            assert (order[a:z] - a).tolist() == want


def check(spark, texts, size=200, **more):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], KIND).withColumns({"t1": F.lit(0), "spans": F.lit("")})
    got = {r.doc_id: r for r in repeats.dedup(df, length=size, **more).collect()}
    assert len(got) == len(texts)
    for k, (spans, sha) in enumerate(brute(texts, size)):
        assert [(s.a, s.b) for s in got[k].spans] == spans
        assert got[k].kept_sha256 == sha and got[k].n_bytes == len((texts[k] or "").encode())


@pytest.mark.parametrize("common", [2048, 2])
def test_equals_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(repeats, "COMMON", common)         # 2: every marker is split
    rng = random.Random(common)
    base = ["".join(rng.choice("ab cé") for _ in range(rng.randint(0, 900))) for _ in range(6)]
    texts = []
    for _ in range(25):
        parts = []
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, 400)
            parts.append(rng.choice(base)[i:i + rng.randint(0, 500)] + rng.choice(["", "x", "a" * rng.randint(0, 300)]))
        texts.append("".join(parts))
    texts += [texts[0], texts[3], "", None, None, "a" * 450, "ab" * 260, "q" * 199, "q" * 200, "r" * 201, "xyz" * 70]
    check(spark, texts)


def test_long_text_is_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 700)
    rng = random.Random(2)
    t = "".join(rng.choice("abcdefgh") for _ in range(5000))
    check(spark, [t, "z" + t[600:1400] + "y", t[4700:] + t[:250]])


def test_empty(spark):
    assert repeats.dedup(spark.createDataFrame([], KIND)).collect() == []
