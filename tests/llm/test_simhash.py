import random
import re

import numpy as np
import pytest
import xxhash

from salesguard.llm import simhash
from salesguard.llm.components import stars

KIND = "doc_id long, text string"


def plain(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps, radius):
    ids = sorted(fps, key=lambda i: (i is None, i))
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)), key=lambda i: (i is None, i))
                root[y] = x
    return {i: top(i) for i in ids}


@pytest.mark.parametrize("text", [None, "", " \t\n\x0b\f\r", "one", "One TWO", "one two three", "Été ÉTÉ\u00a0x y z z z z", "a  b\tc\nd " * 300])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain(text)


def test_long_text_votes_over_many_blocks():
    rng = random.Random(4)
    text = " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(70_000))
    assert simhash.fingerprint(text) == plain(text)


@pytest.mark.parametrize("blocks", [None, (7, 11), (1, 1)])
def test_groups_equal_brute_force(spark, monkeypatch, blocks):
    if blocks:                                             # tiles of many cells
        monkeypatch.setattr(simhash, "HOME", blocks[0])
        monkeypatch.setattr(simhash, "VISIT", blocks[1])
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(40, 300))) for _ in range(40)]
    for t in texts[:25]:                                   # near copies in chains
        for _ in range(6):
            w = t.split()
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
            t = " ".join(w)
            texts.append(t)
    texts += [texts[0], texts[0].upper(), None, "", " ", "one"]
    rng.shuffle(texts)
    rows = list(enumerate(texts)) + [(None, texts[5])]
    got = {r.doc_id: r for r in simhash.near_duplicates(spark.createDataFrame(rows, KIND)).collect()}
    fps = {i: plain(t) for i, t in rows}
    want = groups(fps, 2)
    assert len(set(want.values())) < len(want) - 30
    assert {i: r.fp % (1 << 64) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == want


def test_tiles_find_every_link():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = np.array([b ^ np.uint64(1 << int(i)) ^ np.uint64(1 << int(j)) for b in base for i, j in rng.integers(0, 63, (20, 2))])
    every = np.unique(np.r_[base, near])
    a, b = simhash.tile_forest(every[:200], every[200:], 2)
    labels = {int(x): int(y) for x, y in zip(a, b, strict=True)}
    pairs = [(i, j) for i in range(200) for j in range(i + 1, len(every)) if int(every[i] ^ every[j]).bit_count() <= 2]
    assert pairs
    for i, j in pairs:
        x, y = int(every[i]), int(every[j])
        assert labels.get(x, x) == labels.get(y, y)


def test_cells_hold_every_pair_once_and_stay_small(spark, monkeypatch):
    monkeypatch.setattr(simhash, "HOME", 8)
    monkeypatch.setattr(simhash, "VISIT", 16)
    rows = [(t, k % 3 == 0, 1000 * t + k) for t, n in ((1, 90), (2, 7), (3, 2)) for k in range(n)] + [(4, False, 4000)]
    cells = {}
    for r in simhash._cells(spark.createDataFrame(rows, "tile int, home boolean, fp long")).collect():
        cells.setdefault((r.tile, r.x, r.y, r.late), ([], []))[r.side].append(r.fp)
    met = []
    for (_, x, y, late), (first, second) in cells.items():
        if x == y and not late:
            met += [frozenset((a, b)) for k, a in enumerate(first) for b in first[:k]]
        met += [frozenset((a, b)) for a in first for b in second]
    want = {frozenset((a, b)) for t, h, a in rows if h for u, _, b in rows if t == u and a != b}
    assert len(met) == len(set(met)) and set(met) == want
    assert max(len(x) for c in cells.values() for x in c) < 40


def test_repeated_ids_and_other_columns(spark):
    a, b = " ".join(f"a{k}" for k in range(50)), " ".join(f"b{k}" for k in range(50))
    rows = [(5, a, 1, 2), (5, b, 1, 2), (5, a, 1, 2), (3, b, 1, 2), (None, a, 1, 2), (None, "lone " * 9, 1, 2), (9, None, 1, 2), (8, "", 1, 2)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, KIND + ", fp long, component_id long")).collect()
    assert sorted(((r.doc_id, r.component_id, r.fp == 0) for r in got), key=str) == sorted(
        [(5, 5, False), (5, 3, False), (5, 5, False), (3, 3, False), (None, 5, False), (None, None, False), (9, 8, True), (8, 8, True)], key=str)


def test_moves_cover_every_difference():
    moves = set(simhash._moves(2))
    for m in moves:
        assert m == (0, 0, 0, 0) or tuple(-x for x in m) not in moves
    assert len(moves) == 21


def test_stars_settle_chains_and_hubs(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(5, 5), (None, 3), (200, 199), (199, 200)]
    got = {r.node: r.root for r in stars(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 160)} | {199: 199, 200: 199}
    assert stars(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], KIND)).collect() == []
