"""Removal of repeated byte strings by suffix sorting.

Every window of ``length`` bytes has a marker: the least hash of the
``gram``-byte strings in it. Equal windows have equal markers, so the windows
of the corpus are dealt to groups by marker, as runs of neighbouring windows.
Runs whose marker stands nowhere else hold no repeat and go no further; the
bytes under the others are sorted group by group (``lyndon``), and neighbours
in suffix order that share ``length`` bytes are the repeats. A marker that is
very common is split by what all windows at one distance from it share, which
equal windows share too. The result is exact; nothing is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesguard.llm.lyndon import batch_of
from salesguard.session import cut

LENGTH, GRAM = 200, 50
#: Bytes of a text hashed at a time, of groups held and sorted at a time, and of runs sent at a time.
PIECE, HOLD, BATCH, SEND = 1 << 18, 1 << 24, 2_000_000, 1 << 23
#: Runs of a marker from which it is split, and distances that share a part.
COMMON, STEP = 2048, 16
BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.cumprod(out, dtype=_U)


class Hasher:
    """Hashes of all strings of a given length in a byte array, from prefix sums modulo 2**64."""

    def __init__(self, n: int):
        self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)

    def prefix(self, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(b) + 1, _U)
        np.cumsum((b + _U(1)) * self.up[:len(b)], out=out[1:])
        return out

    def strings(self, prefix: np.ndarray, size: int) -> np.ndarray:
        return mixed((prefix[size:] - prefix[:-size]) * self.down[:len(prefix) - size])


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(29))
    h *= _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def least(h: np.ndarray, wide: int) -> np.ndarray:
    """The least of every ``wide`` neighbours."""
    n = len(h)
    blocks = np.full(-(-n // wide) * wide, _U(0xFFFFFFFFFFFFFFFF))
    blocks[:n] = h
    blocks = blocks.reshape(-1, wide)
    after = np.minimum.accumulate(blocks, axis=1).ravel()
    before = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(before[:n - wide + 1], after[wide - 1:n])


def runs(raw: bytes, length: int, gram: int, hasher: Hasher) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs (marker, first window, last window, again): neighbouring windows with one marker;
    ``again`` if the marker stands more than once in the run."""
    wide = length - gram + 1
    b = np.frombuffer(raw, np.uint8)
    for at in range(0, len(b) - length + 1, PIECE - length):
        piece = b[at:at + PIECE - 1]
        if len(piece) < length:
            break
        h = hasher.strings(hasher.prefix(piece), gram)
        m = least(h, wide)
        first = np.flatnonzero(np.r_[True, m[1:] != m[:-1]])
        last = np.r_[first[1:] - 1, len(m) - 1]
        view = np.lib.stride_tricks.sliding_window_view(h, wide)
        left = first + view[first].argmin(axis=1)
        right = last + wide - 1 - view[last][:, ::-1].argmin(axis=1)
        yield m[first], first + at, last + at, left != right


def split(raw: bytes, first: int, last: int, marker: int, length: int, gram: int, hasher: Hasher) -> list[tuple]:
    """A common marker's run as (key, first, last) by the distance from a window to its
    marker, in steps, and by the bytes that all windows at these distances share."""
    wide = length - gram + 1
    b = np.frombuffer(raw[first:last + length], np.uint8)
    out = []
    for at in range(0, len(b) - length + 1, PIECE - length):
        prefix = hasher.prefix(b[at:at + PIECE - 1])
        n = len(prefix) - length                          # windows
        places = np.flatnonzero(hasher.strings(prefix, gram) == _U(marker))
        window = np.arange(n)
        mark = places[np.searchsorted(places, window)]
        part = (mark - window) // STEP
        new = np.flatnonzero(np.r_[True, (mark[1:] != mark[:-1]) | (part[1:] != part[:-1])])
        ends = np.r_[new[1:] - 1, n - 1]
        near, far = part[new] * STEP, np.minimum(part[new] * STEP + STEP - 1, wide - 1)
        lo, hi = mark[new] - near, mark[new] - far + length                   # what the part's windows share
        core = (prefix[hi] - prefix[lo]) * hasher.down[lo]
        key = mixed(core * _U(BASE) + mixed(np.full(len(new), marker, _U)) + part[new].astype(_U))
        out += zip(key.view(np.int64).tolist(), (new + at + first).tolist(), (ends + at + first).tolist(), strict=True)
    return out


def repeated(problems: list[dict[bytes, list]], length: int) -> Iterator[tuple[list, int, int]]:
    """Runs of repeated window starts, (places, first, last), in the strings of each
    problem; a string that stands at several places counts as often."""
    texts = [list(p) for p in problems]
    batch, begins = batch_of(texts)
    order = batch.sort()
    strings = [s for t in texts for s in t]
    sizes = np.array([len(s) for s in strings], np.int64)
    of = np.repeat(np.arange(len(strings)), sizes + 1)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    weight = np.array([len(p[s]) for p, t in zip(problems, texts, strict=True) for s in t], np.int64)
    whole = np.arange(batch.n) - begins[of] + length <= sizes[of]
    v = order[whole[order]]
    raw = batch.letters
    same = np.empty(max(0, len(v) - 1), bool)
    view = np.lib.stride_tricks.sliding_window_view(raw, min(length, max(1, len(raw))))
    for at in range(0, len(same), 1 << 14):               # most neighbours differ early, so look at a part first
        a, b = v[at:at + (1 << 14)], v[at + 1:at + 1 + (1 << 14)]
        a = a[:len(b)]
        eq = text[of[a]] == text[of[b]]
        for probe in (0, length - 1, length // 2, length // 4, 3 * length // 4):
            eq &= raw[a + probe] == raw[b + probe]
        k = np.flatnonzero(eq)
        eq[k] = (view[a[k]] == view[b[k]]).all(axis=1)
        same[at:at + len(b)] = eq
    start = np.flatnonzero(np.r_[True, ~same][:len(v)])
    total = np.add.reduceat(weight[of[v]], start) if len(v) else np.empty(0, int)
    hit = np.zeros(batch.n + 1, bool)
    hit[v[np.repeat(total >= 2, np.diff(np.r_[start, len(v)]))]] = True
    edges = np.flatnonzero(np.diff(np.r_[False, hit].astype(np.int8)))
    places = [p[s] for p, t in zip(problems, texts, strict=True) for s in t]
    for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        s = of[a]                                          # a string's end is never hit, so a run is in one string
        yield places[s], a - int(begins[s]), z - 1 - int(begins[s])


def text_key(text) -> list:
    """Two 64-bit hashes that stand for a text; rows of one text share its result."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit(1), t).alias("t2")]


def removals(docs: DataFrame, text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``t1, t2, n_bytes, spans, kept`` of every distinct text of which a window
    stands elsewhere, in this or another text: the removed byte spans (maximal,
    [a, b)) and the remaining bytes. Copies of a text share a row and don't
    count as elsewhere here (see ``dedup``)."""
    texts = docs.select(*text_key(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text")).where(
        F.octet_length("text") >= length)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(PIECE)
        for b in batches:
            found = []
            for k, t in enumerate(b.column(2).to_pylist()):
                for m, lo, hi, again in runs(t.encode(), length, gram, hasher):
                    found.append((m.view(np.int64), np.full(len(m), k), lo.astype(np.int32), hi.astype(np.int32), again))
            if found:
                m, k, lo, hi, again = (np.concatenate(x) for x in zip(*found, strict=True))
                rows = pa.array(k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(m), b.column(0).take(rows), b.column(1).take(rows), pa.array(lo), pa.array(hi),
                     pa.array(again)], ["marker", "t1", "t2", "lo", "hi", "again"])

    marks = texts.mapInArrow(scan, "marker long, t1 long, t2 long, lo int, hi int, again boolean")
    by = W.partitionBy("marker")
    marks = marks.withColumns({"n": F.count("*").over(by), "several": (
        (F.min("t1").over(by) != F.max("t1").over(by)) | (F.min("t2").over(by) != F.max("t2").over(by))
        | (F.min("lo").over(by) != F.max("lo").over(by)))})
    wanted = marks.where("several OR again").groupBy("t1", "t2").agg(
        F.collect_set(F.struct("lo", "hi", "marker", (F.col("n") > COMMON).alias("common"))).alias("runs"))
    held = cut(texts.join(wanted, ["t1", "t2"]).select("t1", "t2", "text", "runs"), "repeats")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, before, rows, full = Hasher(PIECE), None, [], 0

        def batch():
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                              ["marker", "t1", "t2", "lo", "bytes"])

        for b in batches:
            for k in range(b.num_rows):
                t1, t2 = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                if (t1, t2) == before:                     # copies follow each other
                    continue
                before, raw = (t1, t2), b.column(2)[k].as_py().encode()
                for r in b.column(3)[k].as_py():
                    parts = [(r["marker"], r["lo"], r["hi"])]
                    if r["common"]:
                        parts = split(raw, r["lo"], r["hi"], r["marker"] % (1 << 64), length, gram, hasher)
                    for key, lo, hi in parts:
                        rows.append((key, t1, t2, lo, raw[lo:hi + length]))
                        full += hi + length - lo
                    if full >= SEND:
                        yield batch()
                        rows, full = [], 0
        yield batch()

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, problems, full = None, {}, [], 0

        def spans():
            # Groups of one size take about as many steps, so they are sorted together.
            problems.sort(key=lambda p: (sum(map(len, p)), min(p)))
            out, part, size = [], [], 0
            for k, p in enumerate(problems):
                part.append(p)
                size += sum(map(len, p))
                if size >= BATCH or k == len(problems) - 1:
                    out += [(t1, t2, lo + a, lo + z) for places, a, z in repeated(part, length)
                            for t1, t2, lo in set(places)]
                    part, size = [], 0
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = list(zip(*out, strict=True)) or [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                              ["t1", "t2", "first", "last"])

        for b in batches:
            for key, t1, t2, lo, raw in zip(*(b.column(n).to_pylist() for n in range(5)), strict=True):
                if key != now:
                    now, group = key, {}
                    if full >= HOLD:
                        yield spans()
                        problems, full = [], 0
                    problems.append(group)
                if raw not in group:
                    group[raw] = []
                    full += len(raw)
                if (t1, t2, lo) not in group[raw][-1:]:
                    group[raw].append((t1, t2, lo))
        yield spans()

    parts = held.mapInArrow(send, "marker long, t1 long, t2 long, lo int, bytes binary")
    hits = (parts.repartition("marker").sortWithinPartitions("marker", "t1", "t2", "lo")
            .mapInArrow(sort, "t1 long, t2 long, first int, last int"))
    hits = hits.groupBy("t1", "t2").agg(F.collect_list(F.struct("first", "last")).alias("starts"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t1, t2, t, starts in zip(*(b.column(n).to_pylist() for n in range(4)), strict=True):
                raw, spans = t.encode(), []
                for s in sorted((s["first"], s["last"] + length) for s in starts):
                    if spans and s[0] <= spans[-1][1]:
                        spans[-1] = (spans[-1][0], max(spans[-1][1], s[1]))
                    else:
                        spans.append(s)
                ends = [0, *(z for _, z in spans)]
                kept = b"".join(raw[a:z] for a, z in zip(ends, [*(a for a, _ in spans), len(raw)], strict=True))
                out.append((t1, t2, len(raw), [{"a": a, "b": z} for a, z in spans], kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])),
                     pa.binary())
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)],
                                             ["t1", "t2", "n_bytes", "spans", "kept"])

    return held.select("t1", "t2", "text").join(hits, ["t1", "t2"]).mapInArrow(
        apply, "t1 long, t2 long, n_bytes long, spans array<struct<a:int,b:int>>, kept binary")


def dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``id_col, n_bytes, spans, kept_sha256`` for every row: the byte spans
    covered by a string of ``length`` bytes that also starts elsewhere, and the
    digest of the other bytes (whose texts ``removals`` has).

    Strings are judged on the input, and never cross texts. Rows that repeat a
    text, whatever their id, repeat all of it. Null texts are empty; texts
    shorter than ``length`` lose nothing. Empty tables give no rows; extra
    columns are not read. Text lengths are 32-bit.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(F.col(id_col), *text_key(F.col(text)), F.octet_length(t).cast("long").alias("n_bytes"),
                        F.sha2(t, 256).alias("whole"))
    counts = light.groupBy("t1", "t2").agg((F.count("*") > 1).alias("copied"))
    found = removals(docs, text, length).select("t1", "t2", F.col("spans").alias("own"),
                                                F.sha2("kept", 256).alias("rest"))
    found = found.dropDuplicates(["t1", "t2"])             # copies that a join did not bring together
    gone = F.col("copied") & (F.col("n_bytes") >= length)
    one = F.array(F.struct(F.lit(0).alias("a"), F.col("n_bytes").cast("int").alias("b")))
    none = F.array().cast("array<struct<a:int,b:int>>")
    return (light.join(counts, ["t1", "t2"]).join(found, ["t1", "t2"], "left").select(
        id_col, "n_bytes", F.when(gone, one).otherwise(F.coalesce("own", none)).alias("spans"),
        F.when(gone, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("rest", "whole")).alias("kept_sha256")))
