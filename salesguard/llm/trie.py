"""Prefix trie of conversations, summed up over an Euler tour.

A node is a distinct sequence of first turns; its number is the sum of
key(turn) * BASE^place modulo 2^127 - 1 with keys from SHA-256, so a prefix is a
prefix sum that chunks of one long conversation compute side by side. A node is
also known by its smallest member and its depth, and the nodes of one smallest
member form a path.

Each node has an enter and an exit arc. The tour goes from an enter arc to the
first child's, or at a leaf to its own exit arc; from an exit arc to the next
sibling's enter arc, or to the parent's exit arc. Runs of arcs within a block of
a path are one element of a list, which is ranked distributedly: every element
jumps to a splitter (a sixteenth of them, by hash), the splitters' list is
ranked by pointer doubling, and the rest adds its splitter's sum. A node's sums
over its subtree are the difference of those at its two arcs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesguard.llm.chunks import chunk_id, joined_sha, ordered, record_batch
from salesguard.llm.columns import need, words
from salesguard.session import cut, release

PRIME = (1 << 127) - 1
BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()) % PRIME
_LOW = (1 << 64) - 1
#: Nodes of a path that are put together before the list is ranked.
BLOCK = 1024
SPLIT = 16
NOTHING = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, pos, key, words`` for each turn: its place, the digest of its role
    and text, and the number of words of its text.

    Turns go by ``turn`` (null first), equal ones by role, digest and number of
    words; repeated rows stay. Null roles and texts are empty. Rows without a
    ``conv_id`` belong to no conversation and are left out."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = need(conversations, "conv_id", "turn", "role", "text").where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)).alias("key"),
        F.size(words(text)).cast("long").alias("words"))
    same = rows.groupBy("conv_id", "turn", "role", "key", "words").agg(F.count("*").alias("n"))
    order = ["conv_id", "turn", "role", "key", "words"]
    found = cut(ordered(same, *order).select("conv_id", "key", "words", "n").mapInArrow(_scan, SCAN), "turns")
    rows = _carried(found).select("conv_id", "key", "words", (F.col("at") + F.col("at0")).alias("pos"), "n")
    each = rows.withColumn("pos", F.explode(F.sequence("pos", F.col("pos") + F.col("n") - 1)))
    return each.select("conv_id", "pos", "key", "words")


def rebuild(rows: DataFrame, ids: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c of ``ids`` begins with the first h turns of c - c % ``group``
    and goes on with its own after its first h; h is crc32(c) % ``most``.
    ``rows`` are of ``turns``."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = rows.where(F.col("pos") >= h)
    heads = rows.where(F.col("pos") < most - 1).select(F.col("conv_id").alias("base"), "pos", "key", "words")
    takers = ids.select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")).where("h > 0")
    lent = heads.join(takers, "base").where("pos < h").select("conv_id", "pos", "key", "words")
    return own.unionByName(lent)


SCAN = ("frag boolean, conv_id long, chunk int, part long, at long, n long, key binary, words long, "
        "bhi long, blo long, ahi long, alo long, edge boolean")
_NAMES = [x.split()[0] for x in SCAN.split(", ")]
_KINDS = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(),
          *[pa.int64()] * 4, pa.bool_()]


def _pair(x: int) -> tuple[int, int]:
    """A number below 2^127 as two signed longs."""
    low = x & _LOW
    return x >> 64, low - (1 << 64) if low >> 63 else low


def _whole(hi: int, lo: int) -> int:
    return (int(hi) << 64) | (int(lo) & _LOW)


def _scan(batches: Iterator[pa.RecordBatch], sums: bool = False) -> Iterator[pa.RecordBatch]:
    """Place and, if asked, prefix sums before and after each row in its fragment of
    a conversation; and a row for each fragment, with its totals."""
    chunk, conv, part, at, total, power = chunk_id(), None, -1, 0, 0, 1
    for b in batches:
        out = []
        for c, key, w, n in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            if c != conv:
                if conv is not None:
                    out.append((True, conv, chunk, part, 0, at, None, None, 0, 0, *_pair(total), part == 0))
                conv, part, at, total, power = c, part + 1, 0, 0, 1
            before = total
            if sums:
                total = (total + int.from_bytes(key) * power) % PRIME
                power = power * BASE % PRIME
            out.append((False, c, chunk, part, at, n, None if sums else key, w, *_pair(before), *_pair(total), False))
            at += n
        yield record_batch(out, _NAMES, _KINDS)
    if conv is not None:
        yield record_batch([(True, conv, chunk, part, 0, at, None, None, 0, 0, *_pair(total), True)], _NAMES, _KINDS)


def _scan_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _scan(batches, sums=True)


def _chain(frags: pd.DataFrame) -> pd.DataFrame:
    """What lies before each of a conversation's fragments, and after it."""
    n = total = 0
    out = []
    for r in frags.sort_values("chunk").itertuples():
        before = total
        total = (total + _whole(r.ahi, r.alo) * pow(BASE, n, PRIME)) % PRIME
        out.append((r.conv_id, r.chunk, r.part, n, *_pair(before), n + r.n, *_pair(total)))
        n += r.n
    return pd.DataFrame(out, columns=["conv_id", "chunk", "part", "at0", "hi0", "lo0", "upto", "hi", "lo"])


def _chains(found: DataFrame) -> DataFrame:
    """Two fragments of a chunk at most can belong to longer conversations; these
    are chained, a conversation's in one group."""
    edges = found.where("frag and edge").select("conv_id", "chunk", "part", "n", "ahi", "alo")
    return edges.groupBy("conv_id").applyInPandas(
        _chain, "conv_id long, chunk int, part long, at0 long, hi0 long, lo0 long, upto long, hi long, lo long")


def _carried(found: DataFrame) -> DataFrame:
    """The rows, with place and sum before their fragment (0 but for long conversations)."""
    before = _chains(found).where("at0 > 0").select("chunk", "part", "at0", "hi0", "lo0")
    return found.where("not frag").join(before, ["chunk", "part"], "left").withColumn("at0", F.coalesce("at0", F.lit(0)))


def _shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "depth", "hi", "lo", "phi", "plo", "words"]
    for b in batches:
        out = []
        for c, at, at0, h0, l0, bh, bl, ah, al, w in zip(*(x.to_pylist() for x in b.columns), strict=True):
            start, power = _whole(h0, l0), pow(BASE, at0, PRIME)
            before, after = ((start + power * _whole(h, lo)) % PRIME for h, lo in ((bh, bl), (ah, al)))
            out.append((c, at0 + at + 1, *_pair(after), *_pair(before), w))
        yield record_batch(out, names, [pa.int64()] * 7)


def prefixes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """For rows ``conv_id, pos, key, words``: every conversation's prefixes ``conv_id,
    depth, hi, lo, phi, plo, words`` (number of the node, of its parent) and their
    ends ``conv_id, depth, hi, lo``."""
    order = ["conv_id", "pos", "key", "words"]
    found = cut(ordered(rows.select(*order, F.lit(1).cast("long").alias("n")), *order)
                .select("conv_id", "key", "words", "n").mapInArrow(_scan_sums, SCAN), "prefixes")
    placed = _carried(found)
    near = placed.where("at0 = 0").select("conv_id", (F.col("at") + 1).alias("depth"), F.col("ahi").alias("hi"),
                                          F.col("alo").alias("lo"), F.col("bhi").alias("phi"), F.col("blo").alias("plo"), "words")
    far = placed.where("at0 > 0").select("conv_id", "at", "at0", "hi0", "lo0", "bhi", "blo", "ahi", "alo", "words").mapInArrow(
        _shift, "conv_id long, depth long, hi long, lo long, phi long, plo long, words long")
    last = _chains(found).groupBy("conv_id").agg(
        F.max("upto").alias("depth"), F.max_by("hi", "chunk").alias("hi"), F.max_by("lo", "chunk").alias("lo"))
    ends = found.where("frag and not edge").select("conv_id", F.col("n").alias("depth"), F.col("ahi").alias("hi"),
                                                   F.col("alo").alias("lo"))
    return near.unionByName(far), ends.unionByName(last)


FAMILY = ("report boolean, depth long, conv_id long, n_convs long, words long, parent long, next long, chunk int, "
          "lost boolean, tail boolean, fd long, fhi long, flo long, fconv long, kd long, khi long, klo long, kconv long, "
          "td long, thi long, tlo long")
_FAMILY = [x.split()[0] for x in FAMILY.split(", ")]
_FAMILY_KINDS = [pa.bool_(), *[pa.int64()] * 6, pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 11]
_GAP = (None,) * 11


def _families(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children with their parent's conversation and the next sibling's, from rows
    of parents, each followed by its children. Marks children whose parent's row
    is in an earlier chunk, and the chunk's last row if it is a child; reports
    the chunk's first row, last parent and last child."""
    chunk, key, parent, held, first = chunk_id(), None, None, None, None
    for b in batches:
        out = []
        for d, hi, lo, child, conv, n, w in zip(*(b.column(k).to_pylist() for k in range(7)), strict=True):
            now = (d, hi, lo)
            first = first or (*now, conv if child else None)
            if held:                                       # the child before waited for what follows it
                follows = conv if child and held[0] == now else None
                out.append((False, held[0][0], *held[1:5], follows, chunk, held[5], False, *_GAP))
                held = None
            if child:
                held = (now, conv, n, w, parent if key == now else None, key != now)
            else:
                key, parent = now, conv
        yield record_batch(out, _FAMILY, _FAMILY_KINDS)
    out = []
    if held:
        out.append((False, held[0][0], *held[1:5], None, chunk, held[5], True, *_GAP))
    if first:
        out.append((True, *(None,) * 6, chunk, False, False, *first, *(key or (None,) * 3), parent,
                    *(held[0] if held else (None,) * 3)))
    yield record_batch(out, _FAMILY, _FAMILY_KINDS)


def families(found: DataFrame) -> DataFrame:
    """``conv_id, depth, n_convs, words, parent, next`` of all nodes but the root,
    which alone is no row of ``found`` (``depth, hi, lo, phi, plo, conv_id, n_convs, words``)."""
    children = found.select("depth", F.col("phi").alias("hi"), F.col("plo").alias("lo"), F.lit(True).alias("child"),
                            "conv_id", "n_convs", "words")
    parents = found.select((F.col("depth") + 1).alias("depth"), "hi", "lo", F.lit(False).alias("child"), "conv_id",
                           F.lit(0).cast("long").alias("n_convs"), F.lit(0).cast("long").alias("words"))
    return _adjoin(ordered(children.unionByName(parents), "depth", "hi", "lo", "child", "conv_id"))


def _adjoin(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    seen = cut(rows.mapInArrow(_families, FAMILY), "families")
    reports = sorted(seen.where("report").select("chunk", *_FAMILY[10:]).collect())     # one for each chunk
    fixes, key, conv = [], None, None
    for k, r in enumerate(reports):
        start, tail = (r.fd, r.fhi, r.flo), (r.td, r.thi, r.tlo)
        then = reports[k + 1] if k + 1 < len(reports) else None
        follows = then.fconv if then and tail == (then.fd, then.fhi, then.flo) else None
        fixes.append((r.chunk, conv if key == start else None, follows))
        if r.kd is not None:
            key, conv = (r.kd, r.khi, r.klo), r.kconv
    fixes = spark.createDataFrame(fixes, "chunk int, lost_parent long, tail_next long")
    return seen.where("not report").join(fixes, "chunk").select(
        "conv_id", "depth", "n_convs", "words", F.when(F.col("lost"), F.col("lost_parent")).otherwise(F.col("parent")).alias("parent"),
        F.when(F.col("tail"), F.col("tail_next")).otherwise(F.col("next")).alias("next"))


def _jump(items: DataFrame, is_open: Column) -> DataFrame:
    """Every element jumps over the one it points to, and adds its sums, while
    ``is_open`` holds for where it points."""
    now = cut(items, "list")
    while not now.where(is_open).isEmpty():
        over = now.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("na").alias("ma"), F.col("nb").alias("mb"),
                          F.col("w1").alias("v1"), F.col("w2").alias("v2"))
        jumped = now.where(is_open).join(over, ["na", "nb"]).select(
            "a", "b", F.col("ma").alias("na"), F.col("mb").alias("nb"), (F.col("w1") + F.col("v1")).alias("w1"),
            (F.col("w2") + F.col("v2")).alias("w2"))
        then = cut(now.where(~is_open).unionByName(jumped), "list")
        release(now)
        now = then
    return now


def rank(items: DataFrame) -> DataFrame:
    """Sums ``a, b, s1, s2`` from each element of a linked list to its end.

    ``items``: ``a, b`` (an element's number), ``na, nb`` (the next one's, null at
    the end), ``w1, w2``. Elements jump until they point to a splitter, which takes
    about log2 of the longest gap in rounds and touches fewer each time; then
    only the splitters' list is doubled."""
    splitter = lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(SPLIT)) == 0
    near = _jump(items, F.col("na").isNotNull() & ~splitter("na", "nb"))
    marks = _jump(near.where(splitter("a", "b")), F.col("na").isNotNull())
    rest = marks.select(F.col("a").alias("na"), F.col("b").alias("nb"), F.col("w1").alias("r1"), F.col("w2").alias("r2"))
    total = lambda w, r: F.col(w) + F.coalesce(r, F.lit(0))
    return near.join(rest, ["na", "nb"], "left").select("a", "b", total("w1", "r1").alias("s1"), total("w2", "r2").alias("s2"))


def tour(found: DataFrame) -> DataFrame:
    """Adds ``n_leaves`` and ``saved_tokens`` to nodes ``conv_id, depth, parent, next,
    first, n_convs, n_children, words`` by sums over their Euler tour.

    Of a path's block, the enter arcs follow each other and are one element; so
    are the exit arcs from a node up to the next that has a sibling to go on to.
    Windows are over at most ``BLOCK`` nodes of a path."""
    block = W.partitionBy("conv_id", F.floor(F.col("depth") / BLOCK)).orderBy("depth")
    upto = block.rowsBetween(W.unboundedPreceding, W.currentRow)
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    laid = found.withColumns({"leaf": leaf, "saving": (F.col("n_convs") - 1) * F.col("words")}).withColumns({
        "enter": F.min("depth").over(upto),
        "run": F.coalesce(F.max(F.when(F.col("next").isNotNull(), F.col("depth"))).over(upto), F.min("depth").over(upto)),
        "deepest": F.lead("depth").over(block).isNull(),
        "leaf0": F.sum("leaf").over(upto) - F.col("leaf"), "saving0": F.sum("saving").over(upto) - F.col("saving")})
    laid = cut(laid, "laid")
    down = F.col("n_children") > 0
    enters = laid.where("deepest").select(
        F.col("conv_id").alias("a"), (2 * F.col("enter")).alias("b"), F.when(down, F.col("first")).otherwise(F.col("conv_id")).alias("na"),
        F.when(down, 2 * F.col("depth") + 2).otherwise(2 * F.col("run") + 1).alias("nb"),
        (F.col("leaf0") + F.col("leaf")).alias("w1"), (F.col("saving0") + F.col("saving")).alias("w2"))
    above = laid.select(F.col("conv_id").alias("parent"), (F.col("depth") + 1).alias("depth"), F.col("run").alias("up"))
    on = F.col("next").isNotNull()
    none = F.lit(0).cast("long")
    exits = laid.where("depth = run").select("conv_id", "depth", "parent", "next").join(above, ["parent", "depth"], "left").select(
        F.col("conv_id").alias("a"), (2 * F.col("depth") + 1).alias("b"), F.coalesce("next", "parent").alias("na"),
        F.when(on, 2 * F.col("depth")).otherwise(2 * F.col("up") + 1).alias("nb"), none.alias("w1"), none.alias("w2"))
    sums = cut(rank(enters.unionByName(exits)), "sums")
    into = sums.select(F.col("a").alias("conv_id"), F.expr("b div 2").alias("enter"), F.col("s1").alias("e1"),
                       F.col("s2").alias("e2"), F.expr("b % 2").alias("kind")).where("kind = 0").drop("kind")
    out = sums.select(F.col("a").alias("conv_id"), F.expr("b div 2").alias("run"), F.col("s1").alias("x1"),
                      F.col("s2").alias("x2"), F.expr("b % 2").alias("kind")).where("kind = 1").drop("kind")
    return laid.join(into, ["conv_id", "enter"]).join(out, ["conv_id", "run"]).select(
        *found.columns, (F.col("e1") - F.col("leaf0") - F.col("x1")).alias("n_leaves"),
        (F.col("e2") - F.col("saving0") - F.col("x2")).alias("saved_tokens"))


def nodes(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie's nodes, from the turns ``conv_id, pos, key, words`` and the numbers
    ``conv_id`` of all conversations (distinct, those without turns too).

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null at the root),
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, the
    digest of the members that end at the node. The root is there as soon as there
    is a conversation; an empty table gives no rows."""
    ids = cut(ids.select("conv_id"), "ids")
    n, least = ids.agg(F.count("*"), F.min("conv_id")).first()
    every, ends = prefixes(rows)
    found = cut(every.groupBy("depth", "hi", "lo").agg(
        F.min("phi").alias("phi"), F.min("plo").alias("plo"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.min("words").alias("words")), "found")
    zero = F.lit(0).cast("long")
    top = (ids.limit(0 if n == 0 else 1).select(zero.alias("depth"), zero.alias("hi"), zero.alias("lo"), zero.alias("phi"),
                                                zero.alias("plo"), F.lit(least).cast("long").alias("conv_id"),
                                                F.lit(n).cast("long").alias("n_convs"), zero.alias("words")))
    kin = families(found.unionByName(top)).where("depth > 0")
    gone = F.lit(None).cast("long")
    kin = cut(kin.unionByName(top.select("conv_id", "depth", "n_convs", "words", gone.alias("parent"), gone.alias("next"))), "kin")
    kids = kin.where("depth > 0").groupBy(F.col("parent").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count("*").alias("n_children"), F.min("conv_id").alias("first"))
    kin = kin.join(kids, ["conv_id", "depth"], "left").withColumn("n_children", F.coalesce("n_children", zero))
    summed = tour(kin)
    bare = ids.join(ends.select("conv_id"), "conv_id", "left_anti").select("conv_id", *[zero.alias(c) for c in ("depth", "hi", "lo")])
    texts = joined_sha(ends.unionByName(bare).withColumn("item", F.col("conv_id").cast("string")), ["depth", "hi", "lo"],
                       ["conv_id"], "item", b",", cut)
    texts = found.unionByName(top).select("depth", "hi", "lo", "conv_id").join(texts, ["depth", "hi", "lo"]).select(
        "conv_id", "depth", "sha")
    return summed.join(texts, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(NOTHING)).alias("ends_sha256"))


def trie(conversations: DataFrame) -> DataFrame:
    """``nodes`` of the conversations as they are."""
    return nodes(turns(conversations), numbers(conversations))


def numbers(conversations: DataFrame) -> DataFrame:
    """All conversations' numbers."""
    return need(conversations, "conv_id").where("conv_id is not null").select(F.col("conv_id").cast("long")).distinct()
