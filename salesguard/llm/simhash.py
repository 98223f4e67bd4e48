"""SimHash near-duplicates by tiled exact comparison.

A fingerprint has a bit set where more than half of the shingle hashes have
it. Distinct fingerprints go to tiles by the population counts of their
16-bit quarters. Two fingerprints at most r bits apart have quarter counts at
most r apart in total, so tile pairs further apart are skipped; the others are
compared in full with numpy's exclusive-or and bit counts. A tile's own
fingerprints and those that visit it are dealt to blocks of bounded size, and
two blocks are one task's cell, however many a tile has. A cell sends a
spanning forest of the links it finds, not the links, and alternating stars
join the forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.llm.columns import LOWER, UPPER, WHITE, need
from salesguard.llm.components import stars

SHINGLE, RADIUS, SEED, QUARTERS = 3, 2, 42, 4
CELLS = 1 << 21
#: Fingerprints of a block, about: of a tile's own, and of its visitors.
HOME, VISIT = 1 << 16, 1 << 19
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPACES = bytes.maketrans(WHITE.encode(), b" " * len(WHITE))


def shingles(text: str | None, size: int) -> list[bytes]:
    """Space-joined word shingles of the text with A-Z lower-cased, repeats
    included; fewer words than ``size``: all of them as one; no word: none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).translate(_SPACES).split(b" ")
    words = [w for w in words if w]
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    return [joined[a:b] for a, b in zip(starts, ends[size - 1:])]  # noqa: B905  one start per full shingle


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """The text's fingerprint; 0 without words."""
    parts = shingles(text, size)
    if not parts:
        return 0
    digest = xxhash.xxh64_intdigest
    votes = np.zeros(64, np.int64)
    for at in range(0, len(parts), 1 << 16):
        h = np.array([digest(s, seed) for s in parts[at:at + (1 << 16)]], np.uint64)
        for k in range(0, len(h), 255):                   # counts fit a byte
            votes += np.unpackbits(h[k:k + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
                .sum(axis=0, dtype=np.uint8)
    return int(np.packbits(votes * 2 > len(parts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE) -> DataFrame:
    """``id_col, fp`` (the unsigned fingerprint's bits as a long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, size) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return need(docs, id_col, "text").mapInArrow(run, f"{id_col} {kind}, fp long")


def _moves(radius: int, parts: int = QUARTERS) -> list[tuple[int, ...]]:
    """Differences of quarter counts within the radius, one of each pair of opposites, and none."""
    near = [d for d in product(range(-radius, radius + 1), repeat=parts) if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= (0,) * parts]


def _counts(fp: Column) -> list[Column]:
    return [F.bit_count(fp.bitwiseAND(F.lit(0xFFFF << 16 * k if k < 3 else (0xFFFF << 48) - (1 << 64))))
            for k in range(QUARTERS)]


def connect(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Gives the ends of every link, and all labelled like them, one label: the smallest."""
    while len(i):
        a, b = labels[i], labels[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(labels, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def tile_forest(home: np.ndarray, visitors: np.ndarray, radius: int, inner: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Links within ``home`` (if ``inner``) and from it to ``visitors`` (both distinct), as
    (node, root) pairs of a spanning forest; the root is the first of its tree."""
    every = np.concatenate([home, visitors])
    labels = np.arange(len(every))
    n = len(home)
    wide = max(1, CELLS // max(1, n))
    for at in range(0 if inner else n, len(every), wide):
        part = every[at:at + wide]
        top = min(n, at + len(part))                       # home pairs once
        i, j = np.nonzero(np.bitwise_count(home[:top, None] ^ part[None, :]) <= radius)
        j += at
        connect(labels, i[i != j], j[i != j])
    tied = np.flatnonzero(labels != np.arange(len(every)))
    return every[tied], every[labels[tied]]


def _cells(at: DataFrame) -> DataFrame:
    """``tile, x, y, late, side, fp``: the cells that each row of ``tile, home, fp`` takes part in.

    Cell (x, x) has the tile's own block x (side 0) and the visitors' first block
    (side 1); (x, y) two blocks of its own; and, ``late``, block x and the visitors'
    block y. Sizes of tiles are few (17^4 at most), so they are broadcast."""
    sizes = at.groupBy("tile").agg(F.ceil(F.sum(F.col("home").cast("long")) / HOME).alias("own"),
                                   F.greatest(F.ceil(F.sum((~F.col("home")).cast("long")) / VISIT), F.lit(1)).alias("guests"))
    sizes = sizes.where("own > 0")                         # a tile without fingerprints of its own links nothing
    rows = at.join(F.broadcast(sizes), "tile").withColumn(
        "part", F.pmod(F.xxhash64("fp"), F.when(F.col("home"), F.col("own")).otherwise(F.col("guests"))))
    part = F.col("part")
    cell = lambda x, y, late, side: F.struct(x.alias("x"), y.alias("y"), late.alias("late"), side.alias("side"))
    owns, guests = F.sequence(F.lit(0).cast("long"), F.col("own") - 1), F.sequence(F.lit(0).cast("long"), F.col("guests") - 1)
    no, yes, zero, one = F.lit(False), F.lit(True), F.lit(0), F.lit(1)
    among = F.transform(owns, lambda k: cell(F.least(part, k), F.greatest(part, k), no, F.when(part > k, one).otherwise(zero)))
    received = F.transform(F.filter(guests, lambda k: k > 0), lambda k: cell(part, k, yes, zero))
    visiting = F.transform(owns, lambda k: cell(k, F.when(part == 0, k).otherwise(part), part > 0, one))
    at = F.when(F.col("home"), F.concat(among, received)).otherwise(visiting)
    return rows.select("tile", F.explode(at).alias("c"), "fp").select("tile", "c.x", "c.y", "c.late", "c.side", "fp")


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Forest links ``a, b`` among the distinct, non-null longs of column ``fp``
    whose bits differ in ``radius`` places or fewer; their components are exact."""
    moves = F.array(*[F.struct(*[F.lit(x).alias(f"d{k}") for k, x in enumerate(m)]) for m in _moves(radius)])
    c = [F.col(f"c{k}") for k in range(QUARTERS)]
    at = fps.select("fp", *[x.alias(f"c{k}") for k, x in enumerate(_counts(F.col("fp")))])
    at = at.select("fp", F.explode(F.transform(moves, lambda m: F.struct(
        *[(c[k] + m[f"d{k}"]).alias(f"t{k}") for k in range(QUARTERS)],
        (F.abs(m["d0"]) + F.abs(m["d1"]) + F.abs(m["d2"]) + F.abs(m["d3"]) == 0).alias("home")))).alias("x"))
    inside = [F.col(f"x.t{k}").between(0, 16) for k in range(QUARTERS)]
    tile = sum((F.col(f"x.t{k}") * 17 ** k for k in range(1, QUARTERS)), F.col("x.t0"))
    at = at.where(inside[0] & inside[1] & inside[2] & inside[3]).select(
        tile.cast("int").alias("tile"), F.col("x.home").alias("home"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(cell, first, second):
            if first and sum(map(len, first)):
                x, y, late = cell[1:]
                a, b = tile_forest(np.concatenate(first).view(np.uint64), np.concatenate([*second, np.empty(0, np.int64)]).view(np.uint64),
                                   radius, inner=x == y and not late)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        now, first, second = None, [], []
        for b in batches:
            *key, side, fp = (b.column(k).to_numpy(zero_copy_only=False) for k in range(6))
            cuts = np.r_[0, np.flatnonzero(np.any([np.diff(k.astype(np.int64)) != 0 for k in key], axis=0)) + 1, len(fp)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if lo == hi:
                    continue
                cell = tuple(int(k[lo]) for k in key)
                if cell != now:
                    yield from forest(now, first, second)
                    now, first, second = cell, [], []
                mine = side[lo:hi] == 0
                first.append(fp[lo:hi][mine])
                second.append(fp[lo:hi][~mine])
            first = [np.concatenate(first)] if len(first) > 1 else first
            second = [np.concatenate(second)] if len(second) > 1 else second
        yield from forest(now, first, second)

    order = ["tile", "x", "y", "late"]
    return _cells(at).repartition(*order).sortWithinPartitions(*order).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``id_col, fp, component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of fingerprints
    ``radius`` or fewer bits apart, equal ones included. Null and blank texts
    have fingerprint 0 and link like any other. Rows that repeat an id stay;
    each counts with its own text. Null ids take part and are never the
    smallest unless a component has no other. An empty table gives no rows;
    extra columns are not read.
    """
    # Fingerprints are cut once: they cost the pass over the texts, and three steps read them.
    fps = fingerprints(docs, id_col, size).checkpoint()
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("_least"))
    roots = stars(links(distinct.select("fp"), radius))
    at = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("_root")).checkpoint()
    least = at.groupBy("_root").agg(F.min("_least").alias("component_id"))
    by_fp = at.join(least, "_root").select("fp", "component_id")
    return fps.join(by_fp, "fp").select(id_col, "fp", "component_id")
