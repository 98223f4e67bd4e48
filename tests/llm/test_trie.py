import hashlib
import random
import re
import zlib

import pytest

from salesguard.llm import queries, trie

KIND = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, rebuilt=True):
    """Nodes of the conversations by brute force."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", hashlib.sha256(
                f"{len(r or '')}:{r or ''}{x or ''}".encode()).digest(), x or ""))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in convs.items()}
    full = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuilt else 0
        full[c] = own.get(c - c % 20, [])[:h] + v[h:] if rebuilt else v
    members = {}
    for c, v in full.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    out = set()
    for node, who in members.items():
        under = [k for k in members if k[:len(node)] == node]
        children = [k for k in under if len(k) == len(node) + 1]
        leaves = sum(not any(len(k) == len(x) + 1 and k[:len(x)] == x for k in under) for x in under)
        saved = sum((len(members[k]) - 1) * len(WORD.findall(k[-1][1])) for k in under if k)
        ends = ",".join(str(c) for c in sorted(who) if len(full[c]) == len(node))
        out.add((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(children), leaves, saved,
                 hashlib.sha256(ends.encode()).hexdigest()))
    return out


@pytest.fixture(params=[False, True])
def chunked(request, spark):
    """Once with few chunks, once with many small ones."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    if request.param:
        spark.conf.set("spark.sql.shuffle.partitions", 13)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for k, v in keep.items():
        spark.conf.set(k, v)


def made(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(0, 60), rng.randrange(0, 400)])
        size = rng.randrange(1, longest)
        rows = [r for r in rows if r[0] != c]
        rows += [(c, t, "ua"[t % 2] if rng.random() < 0.9 else None, rng.choice(["a", "a", "a b", "é é", None, " "]))
                 for t in range(size)]
    rng.shuffle(rows)
    return rows


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_rebuilt_conversations(spark, chunked, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    rows = made(1, 90, 7)
    df = spark.createDataFrame(rows, KIND).repartition(5)
    ids = trie.numbers(df)
    assert got(trie.nodes(trie.rebuild(trie.turns(df), ids), ids)) == plain(rows)


def test_long_conversations_ties_and_nulls(spark, chunked, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 16)
    monkeypatch.setattr(trie, "SPLIT", 3)
    long = [(7, t, "user", f"w {t % 3}") for t in range(150)] + [(9, t, "user", f"w {t % 3}") for t in range(130)]
    same = [(3, 0, "user", "again")] * 60 + [(4, 0, "user", "again")] * 40 + [(5, None, None, None), (5, None, "x", "y"), (5, 2, "x", "")]
    rows = long + same + [(None, 0, "user", "nobody's"), (6, 0, "user", "again"), (8, 0, "a", "b"), (8, 0, "a", "c")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows], KIND + ", pos int, key string")
    assert got(trie.trie(df)) == plain(rows, rebuilt=False)
    ids = trie.numbers(df)
    assert got(trie.nodes(trie.rebuild(trie.turns(df), ids), ids)) == plain(rows)


def test_equal_conversations(spark, chunked):
    rows = [(c, t, "user", f"{t}" + "x" * (t == 1 and c % 50 == 0)) for c in range(300) for t in range(3)]
    assert got(trie.trie(spark.createDataFrame(rows, KIND))) == plain(rows, rebuilt=False)


def test_without_turns_and_empty(spark):
    empty = spark.createDataFrame([], KIND)
    assert trie.trie(empty).collect() == []
    rows = [(22, 0, "user", "a")]                          # its first turn goes, and there is no conversation 20
    df = spark.createDataFrame(rows, KIND)
    ids = trie.numbers(df)
    assert zlib.crc32(b"22") % 4 > 0
    assert got(trie.nodes(trie.rebuild(trie.turns(df), ids), ids)) == plain(rows) == {
        (22, 0, None, 1, 0, 1, 0, hashlib.sha256(b"22").hexdigest())}


def test_registered_query(spark):
    found = queries.QUERIES["op12_prefix_trie"](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    assert got(found) == plain(rows)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint"] * 7 + ["string"]
