"""Mixture-controlled packing of token streams into windows.

Each source is a queue: its documents' ids one after the other. The queues are
served in slots (an eighth of a window) by deficit round robin. A source's
deficit grows with its target weight and falls by one for a served slot; the
source is served when its deficit reaches a slot, counters starting at half a
slot. A source of weight w is thus served its slot i at virtual time
(i + 1/2) / w, and the place of that slot among all is a sum of one whole
number per source. So a task finds where its slots go, with the deficits all
earlier windows and partitions left, without replaying them. At any virtual
time a source is within half a slot of its due, so after any number of windows
one of share p among S is within 1/2 + p S / 2 slots of it. Every window is
full, and a queue that ends leaves its share to the others.

Tails shorter than a slot follow at the end, and what does not fill a last
window goes to sequences of the powers of two it is the sum of: no padding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesguard.llm import units
from salesguard.llm.columns import need
from salesguard.session import cut

WINDOW, SLOTS, END_ID = 1024, 8, 0
#: Weights are rounded to millionths or so, that products with slot numbers fit 64 bits.
UNIT = 1 << 20
BATCH_IDS = 1 << 24


def plain(text: str) -> bool:
    """Whether the text's white space is single blanks and line feeds between
    other characters: as many runs of other characters as separators and one,
    and no further white space."""
    runs, parts = text.split(), text.count(" ") + text.count("\n")
    return len(runs) == parts + 1 and sum(map(len, runs)) + parts == len(text)


class Ids:
    """Token ids of texts by a byte-level BPE of the ``tokenizers`` file format.

    Its pre-tokenizer never joins characters across single white space, so of a
    group of texts each distinct ``" word"`` is encoded once, all of them as one
    string, whose ids are cut where their bytes say. Texts with other white space
    are encoded whole, and those with one of the file's special strings by
    ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        self.slow, self.special = Tokenizer.from_file(path), [t["content"] for t in spec["added_tokens"]]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]     # bytes the file writes as themselves
        byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in
                                             enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte[c] for c in w): n for w, n in spec["model"]["vocab"].items() if w not in self.special}
        self.kind = np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for raw, n in ranks.items():
            self.sizes[n] = len(raw)
        pattern = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        self.fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def pack(self, ids) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in the width of ``kind``."""
        out = [b""] * len(texts)
        easy = []
        for k, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[k] = self.pack(self.slow.encode(text, add_special_tokens=False).ids)
            elif not plain(text):
                out[k] = self.pack(self.fast.encode_ordinary(text))
            else:
                easy.append(k)
        some = [texts[k] for k in easy]
        for a, z in units.groups(some):
            for k, raw in zip(easy[a:z], self._group(some[a:z]), strict=True):
                out[k] = raw
        return out

    def _group(self, texts: list[str]) -> list[bytes]:
        words, of, ends = units.split(texts)
        first = np.r_[0, ends[:-1]]                        # no blank is in front of a text's first word
        firsts = [self.fast.encode_ordinary(words[k]) for k in of[first].tolist()]
        of[first] = len(words) + np.arange(len(texts))
        # A line feed alone would join the one that begins the next word.
        parts = ["" if w == "\n" else w if w[:1] == "\n" else " " + w for w in words]
        ids = self.fast.encode_to_numpy("".join(parts), disallowed_special=()).astype(np.int64)
        upto = np.r_[0, np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(p.encode()) for p in parts])) + 1]
        empty = np.flatnonzero([not p for p in parts])
        for k in empty:                                    # at most one
            upto[k + 1] = upto[k]
        extra = [*firsts, *(self.fast.encode_ordinary("\n") for _ in empty)]
        size = np.array([len(x) for x in extra], np.int64)
        begin, count = np.r_[upto[:-1], len(ids) + np.cumsum(size) - size], np.r_[np.diff(upto), size]
        for k in empty:
            begin[k], count[k] = begin[-1], count[-1]
        every, stops = units.gather(np.r_[ids, np.concatenate([np.array(x, np.int64) for x in extra])], begin, count, of, ends)
        raw, width = every.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        return [raw[a * width:z * width] for a, z in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


def file_order(docs: DataFrame) -> list[Column]:
    """File and place in it of each row of a table read from files; empty for
    other tables. Readers take files by size, so their partitions are not in the
    order in which a sorted table was written: its part numbers are."""
    name = F.col("_metadata.file_name")
    at = [F.concat(F.lpad(F.regexp_extract(name, r"^part-(\d+)", 1), 12, "0"), name), F.col("_metadata.file_block_start")]
    try:
        docs.select(*at).schema  # noqa: B018  resolves the columns
    except AnalysisException:
        return []
    return at


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", source: str | None = "source",
             as_written: bool = False) -> DataFrame:
    """``id_col, source, file, block, chunk, before, n, wide, ids`` per row: its ids
    and an end id, with the number of ids of its source before it in its chunk
    (partition) or, ``as_written``, in its part of a file within that."""
    kind = docs.schema[id_col].dataType.simpleString()
    place = (file_order(docs) if as_written else []) or [F.lit(""), F.lit(0)]
    rows = docs.select(F.col(id_col), F.coalesce("text", F.lit("")),
                       F.coalesce(F.col(source).cast("string"), F.lit("")) if source else F.lit(""),
                       place[0].alias("file"), place[1].cast("long").alias("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, chunk, queued = Ids(path), TaskContext.get().partitionId(), {}
        end = ids.pack([END_ID])
        for whole in batches:
            texts = whole.column(1).to_pylist()
            for a, z in units.groups(texts):                # handed on group by group, to hold little
                b = whole.slice(a, z - a)
                blobs = [x + end for x in ids.encode(texts[a:z])]
                before = []
                n = [len(x) // len(end) for x in blobs]
                for *at, k in zip(*(b.column(c).to_pylist() for c in (2, 3, 4)), n, strict=True):
                    at = tuple(at)
                    before.append(queued.get(at, 0))
                    queued[at] = before[-1] + k
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(2), b.column(3), b.column(4), pa.array([chunk] * len(n), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array([len(end) == 4] * len(n)),
                     pa.array(blobs, pa.binary())],
                    [id_col, "source", "file", "block", "chunk", "before", "n", "wide", "ids"])

    return rows.mapInArrow(run, f"`{id_col}` {kind}, source string, file string, block long, chunk int, before long, "
                                "n long, wide boolean, ids binary")


class Plan:
    """Where the ids of each source go. ``totals``: ids by source; ``weights``:
    target shares by source (default: the totals)."""

    def __init__(self, totals: dict[str, int], weights: dict[str, float] | None = None, window: int = WINDOW):
        self.names = sorted(totals)
        self.at = {s: k for k, s in enumerate(self.names)}
        self.window, self.slot = window, window // SLOTS
        n = np.array([totals[s] for s in self.names], np.int64)
        given = [float((weights or totals).get(s, 0) or 0) for s in self.names]
        top = max(given, default=0) or 1.0
        self.weights = np.array([max(1, round(UNIT * g / top)) for g in given], np.int64)
        self.full = n // self.slot
        self.slots, self.total = int(self.full.sum()), int(n.sum())
        tails = n - self.full * self.slot
        self.tail_at = self.slots * self.slot + np.cumsum(tails) - tails
        whole = self.total // window * window
        ends = [whole]
        while self.total - ends[-1]:
            ends.append(ends[-1] + (1 << (self.total - ends[-1]).bit_length() - 1))
        self.whole, self.rest = whole, np.array(ends, np.int64)

    def rank(self, s: int, i: np.ndarray) -> np.ndarray:
        """The place among all full slots of slots ``i`` of source ``s``."""
        out = np.zeros(len(i), np.int64)
        own = self.weights[s]
        for t, (w, most) in enumerate(zip(self.weights, self.full, strict=True)):
            time = (2 * i + 1) * w - (t > s)             # equal times go by source
            out += i if t == s else np.minimum((time - own) // (2 * own) + 1, most)
        return out

    def place(self, s: int, at: np.ndarray) -> np.ndarray:
        """Where in the whole stream the ids at places ``at`` of a source's queue go."""
        i = at // self.slot
        inside = i < self.full[s]
        out = self.tail_at[s] + at - self.full[s] * self.slot
        out[inside] = self.rank(s, i[inside]) * self.slot + at[inside] % self.slot
        return out

    def sequence(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset in it, and where it ends, for places in the whole stream."""
        k = np.searchsorted(self.rest, at, side="right")
        late = at >= self.whole
        first = np.where(late, self.rest[np.maximum(k - 1, 0)], at // self.window * self.window)
        end = np.where(late, self.rest[np.minimum(k, len(self.rest) - 1)], first + self.window)
        seq = np.where(late, self.whole // self.window + k - 1, at // self.window)
        return seq, at - first, end

    def pieces(self, source: np.ndarray, off: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        """Pieces (row, start, length, sequence, offset) of rows whose ids stand at
        ``off`` in the queue of ``source``, in order of row and start."""
        first = off // self.slot
        count = (off + n - 1) // self.slot - first + 1
        row = np.repeat(np.arange(len(n)), count)
        i = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
        lo = np.maximum(off[row], i * self.slot)
        hi = np.minimum(off[row] + n[row], (i + 1) * self.slot)
        done = []
        while len(row):                                   # again for what runs past the end of its sequence
            at = np.empty(len(row), np.int64)
            for s in np.unique(source[row]):
                mine = source[row] == s
                at[mine] = self.place(s, lo[mine])
            seq, offset, end = self.sequence(at)
            size = np.minimum(hi - lo, end - at)
            done.append((row, lo - off[row], size, seq, offset))
            more = lo + size < hi
            row, lo, hi = row[more], (lo + size)[more], hi[more]
        out = [np.concatenate(x) for x in zip(*done, strict=True)] if done else [np.empty(0, np.int64)] * 5
        order = np.lexsort((out[1], out[0]))
        return tuple(x[order] for x in out)


def pack(docs: DataFrame, path: str, weights: dict[str, float] | None = None, id_col: str = "doc_id",
         source: str | None = "source", window: int = WINDOW, as_written: bool = False) -> DataFrame:
    """Pieces ``id_col, source, start, length, doc_tokens, sequence_id, offset, ids``
    of every row's ids (little-endian unsigned 32-bit), each id in one piece.

    ``weights`` are target shares of the sources (missing: the least weight;
    default: the shares of ids, so that all queues end together). The totals
    of the sources come to the driver: one number for each source. A source's
    queue runs in the order the table is read or, ``as_written``, in that of its
    files' part numbers and the rows in them; null sources are one. Null and
    empty texts are the end id alone. Rows that repeat an id are packed each.
    Empty tables give no rows; extra columns are not read.
    """
    rows = cut(tokenize(docs, path, id_col, source, as_written), "ids")
    by = rows.groupBy("source", "file", "block", "chunk").agg(F.sum("n").alias("ids_in"))
    upto = W.partitionBy("source").orderBy("file", "block", "chunk").rowsBetween(W.unboundedPreceding, -1)
    by = by.withColumn("base", F.coalesce(F.sum("ids_in").over(upto), F.lit(0))).checkpoint()
    totals = {r["source"]: r["n"] for r in by.groupBy("source").agg(F.sum("ids_in").alias("n")).collect()}
    plan = Plan(totals, weights, window)
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "source", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            sizes = np.cumsum(whole.column("n").to_numpy())
            cuts = [0]
            while cuts[-1] < whole.num_rows:
                done = sizes[cuts[-1] - 1] if cuts[-1] else 0
                cuts.append(max(cuts[-1] + 1, int(np.searchsorted(sizes, done + BATCH_IDS, side="right"))))
            for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                b = whole.slice(a, z - a)
                n = b.column("n").to_numpy()
                sources = np.array([plan.at[s] for s in b.column("source").to_pylist()])
                row, start, size, seq, offset = plan.pieces(sources, b.column("at").to_numpy(), n)
                wide = np.uint32 if b.column("wide")[0].as_py() else np.uint16
                data = np.frombuffer(b"".join(b.column("ids").to_pylist()), wide).astype("<u4")
                ends = np.r_[0, np.cumsum(size) * 4].astype(np.int32)
                ids = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(row)), b.column("source").take(pa.array(row)), pa.array(start),
                     pa.array(size), pa.array(n[row]), pa.array(seq), pa.array(offset), ids], names)

    placed = rows.join(by.select("source", "file", "block", "chunk", "base"), ["source", "file", "block", "chunk"]).select(
        id_col, "source", (F.col("base") + F.col("before")).alias("at"), "n", "wide", "ids")
    return placed.mapInArrow(run, f"`{id_col}` {kind}, source string, start long, length long, doc_tokens long, "
                                  "sequence_id long, offset long, ids binary")
