"""Per-key work in Arrow: many small keys side by side, without a call for each.

Rows are hash-partitioned by their keys once and sorted by them, so a task sees
each key's rows together. Batches are cut where a key ends; a key holds one row
per day or so, which bounds what is held over.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def by_keys(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Hash-partition by the group keys once, so per-key steps need no further shuffle.

    The count is explicit (default ``spark.sql.shuffle.partitions``): the work per
    row is far above what its size suggests, so letting AQE coalesce the exchange
    by size would starve it of parallelism.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def key_starts(table: pa.Table, n_keys: int) -> np.ndarray:
    """Places where a row's key differs from the one before (the first row's is 0)."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(n_keys):
        codes = pc.dictionary_encode(table.column(k).combine_chunks(), null_encoding="encode")
        codes = codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes
        new[1:] |= np.diff(codes.indices.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(new)


def whole_keys(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole keys and where each starts; the first ``n_keys`` columns are the key."""
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        now = pa.Table.from_batches([b])
        now = pa.concat_tables([held, now]) if held is not None else now
        starts = key_starts(now, n_keys)
        if len(starts) > 1:
            yield now.slice(0, int(starts[-1])), starts[:-1]
        held = now.slice(int(starts[-1]))
    if held is not None:
        yield held, np.zeros(1, np.int64)


Columns = Callable[[pa.Table, np.ndarray], list[pa.Array]]


def add_per_key(df: DataFrame, keys: list[str], sort: list[str], add: list[T.StructField], fn: Columns) -> DataFrame:
    """``df``, partitioned by ``keys``, with the columns ``add`` that ``fn`` makes from
    tables of whole keys, whose rows are sorted by ``sort`` (nulls first)."""
    names = {f.name for f in add}
    rest = [f for f in df.schema.fields if f.name not in keys and f.name not in names]
    fields = [*(df.schema[k] for k in keys), *rest]
    columns = [f.name for f in fields]
    out = [f for f in df.schema.fields if f.name not in names] + add

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_keys(batches, len(keys)):
            for c, f in zip(fn(table, starts), add, strict=True):
                table = table.append_column(f.name, c)
            yield from table.combine_chunks().to_batches()

    rows = df.select(*[F.col(f"`{c}`") for c in columns]).sortWithinPartitions(*[f"`{c}`" for c in [*keys, *sort]])
    got = rows.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType) for f in [*fields, *add]]))
    return got.select(*[F.col(f"`{f.name}`") for f in out])


def one_per_key(df: DataFrame, keys: list[str], sort: list[str], add: list[T.StructField], fn: Columns) -> DataFrame:
    """One row for each key: the keys, then the columns ``add`` of ``fn`` (one value a key; rows
    whose first added value is null are left out)."""
    schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys] + add)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in whole_keys(batches, len(keys)):
            made = fn(table, starts)
            top = table.take(pa.array(starts)).select(list(range(len(keys))))
            for c, f in zip(made, add, strict=True):
                top = top.append_column(f.name, c)
            yield from top.filter(pc.is_valid(top.column(len(keys)))).combine_chunks().to_batches()

    cols = [*keys, *[c for c in df.columns if c not in keys]]
    rows = df.select(*[F.col(f"`{c}`") for c in cols]).sortWithinPartitions(*[f"`{c}`" for c in [*keys, *sort]])
    return rows.mapInArrow(run, schema)


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """A numeric column as doubles, nulls as NaN."""
    return pc.fill_null(table.column(name).cast(pa.float64()), np.nan).to_numpy()
