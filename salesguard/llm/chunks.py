"""Work along an order that one task need not hold.

Rows are range-partitioned and sorted, so a key's rows are consecutive and a
large key lies in several chunks (partitions). Each task works on its chunk and
reports its fragments; only a chunk's first and last fragment can go on in
another chunk, so what has to be settled between chunks is two rows for each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE = 1 << 20


def ordered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` in chunks by ``order``, each sorted by it (nulls first)."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def chunk_id() -> int:
    return TaskContext.get().partitionId()


def record_batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names)


class Texts:
    """Digests of texts, each the joined items of one key, from a chunk's stream.

    ``add`` takes the key's items in order, ``done`` ends its fragment. ``rows``
    collects ``(*key, sha, chunk, piece, raw)``: the digest of a small fragment
    inside the chunk, else the fragment's pieces of bounded size."""

    def __init__(self, chunk: int, between: bytes):
        self.chunk, self.between, self.frag = chunk, between, 0
        self.rows: list[tuple] = []
        self._open()

    def _open(self) -> None:
        self.held, self.size, self.piece = [], 0, 0

    def add(self, item: bytes, key: tuple) -> None:
        self.held.append(item)
        self.size += len(item) + len(self.between)
        if self.size >= PIECE:
            self._flush(key)

    def _flush(self, key: tuple) -> None:
        if self.held:
            self.rows.append((*key, None, self.chunk, self.piece, self.between.join(self.held)))
            self.piece += 1
        self.held, self.size = [], 0

    def done(self, key: tuple, last: bool) -> None:
        if self.frag == 0 or last or self.piece:
            self._flush(key)
        else:
            self.rows.append((*key, hashlib.sha256(self.between.join(self.held)).hexdigest(), self.chunk, 0, None))
        self.frag += 1
        self._open()


def finish_texts(parts: DataFrame, keys: list[str], between: bytes) -> DataFrame:
    """``keys, sha`` of the rows of ``Texts`` (columns ``keys, sha, chunk, piece, raw``):
    fragments with a digest are ready, the others are joined in order."""
    ready = parts.where("sha is not null").select(*keys, "sha")
    rest = parts.where("raw is not null").select(*keys, "chunk", "piece", "raw")
    n = len(keys)
    kinds = ", ".join(f"`{k}` {parts.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            columns = [b.column(k).to_pylist() for k in range(n)]
            out = []
            for k, raw in enumerate(b.column(n).to_pylist()):
                now = tuple(c[k] for c in columns)
                if state is None or now != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256()
                else:
                    state.update(between)
                state.update(raw)
            yield record_batch(out, [*keys, "sha"], [b.schema.field(k).type for k in range(n)] + [pa.string()])
            kept = [b.schema.field(k).type for k in range(n)]
        if state is not None:
            yield record_batch([(*key, state.hexdigest())], [*keys, "sha"], kept + [pa.string()])

    joined = (rest.repartition(*keys).sortWithinPartitions(*keys, "chunk", "piece").select(*keys, "raw")
              .mapInArrow(run, f"{kinds}, sha string"))
    return ready.unionByName(joined)


def joined_sha(df: DataFrame, keys: list[str], order: list[str], item: str, between: bytes,
               cut: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``keys, sha``: the SHA-256 of each key's items (strings), joined in order."""
    n = len(keys)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, key = Texts(chunk_id(), between), None
        names, types = [*keys, "sha", "chunk", "piece", "raw"], None
        for b in batches:
            types = [b.schema.field(k).type for k in range(n)] + [pa.string(), pa.int32(), pa.int64(), pa.binary()]
            columns = [b.column(k).to_pylist() for k in range(n)]
            for k, x in enumerate(b.column(n).to_pylist()):
                now = tuple(c[k] for c in columns)
                if now != key:
                    if key is not None:
                        texts.done(key, False)
                    key = now
                texts.add(x.encode(), now)
            yield record_batch(texts.rows, names, types)
            texts.rows.clear()
        if key is not None:
            texts.done(key, True)
            yield record_batch(texts.rows, names, types)

    rows = ordered(df.select(*keys, *[o for o in order if o not in keys], F.col(item).alias("item\0")), *keys, *order)
    parts = rows.select(*keys, "item\0").mapInArrow(run, f"{kinds}, sha string, chunk int, piece long, raw binary")
    return finish_texts(cut(parts, "texts"), keys, between)
