"""Structured Streaming scorer.

Order lines arrive as files (or any streaming source); finished days are
summed per store key with a tumbling 1-day event-time window and a watermark
(state holds one row per key and open day, dropped once the watermark passes
the window end). ``foreachBatch`` scores each batch against the range table as it
is then (its newest commit, or a fixed frame) and merges the days out of range
into the alert table: one row per day and key, the newest batch winning, with the
version of the ranges it was held against. The alert table is bucketed by day, so
a batch rewrites the buckets of its days only; its commit names the batch, so a
replayed batch is not merged twice, and what an interrupted one left is not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from salesguard.functions.scalar import flag
from salesguard.sources.sinks import RANGE_TABLE_SCHEMA, latest_commit, read_table, upsert_to_path


def daily_tumbling(stream: DataFrame, ts_col: str, keys: list[str], value: str,
                   watermark: str = "1 day", window: str = "1 day") -> DataFrame:
    """Event-time daily sums per key, append mode (late rows past the watermark are dropped).

    ``withWatermark`` needs a ``timestamp`` column (not ``timestamp_ntz``);
    the session time zone should be UTC so the cast keeps wall-clock days.
    """
    s = stream.withColumn("_ts", F.col(ts_col).cast("timestamp"))
    return (s.withWatermark("_ts", watermark)
             .groupBy(F.window("_ts", window).alias("_w"), *keys)
             .agg(F.sum(value).alias("sales_quantity"))
             .select(F.to_date(F.col("_w.start")).alias("date_"), *keys, "sales_quantity"))


def score(daily: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """R2: left join with the range table (M29 on a stream, static or per batch)."""
    r = ranges.select(*keys, F.col("min").alias("range_min"), F.col("max").alias("range_max"))
    v = F.col("sales_quantity").cast("double")
    return (daily.join(r, keys, "left")
                 .withColumn("out_of_range", flag((v < F.col("range_min")) | (v > F.col("range_max")))))


def current_ranges(spark: SparkSession, ranges: DataFrame | str) -> tuple[DataFrame, int | None]:
    """The range table as it is now and its version: the newest commit of the table
    at a path (see ``sinks.upsert_to_path``), or a frame, which has none."""
    if isinstance(ranges, DataFrame):
        return ranges, None
    commit = latest_commit(spark, ranges)
    if commit is None:
        return spark.createDataFrame([], RANGE_TABLE_SCHEMA), None
    return read_table(spark, ranges, commit["version"]), commit["version"]


def alert_writer(path: str, keys: list[str], ranges: DataFrame | str | None = None, fmt: str = "parquet",
                 writer: str = "scorer"):
    """Scores a batch of daily sums against the ranges of this moment and merges
    its out-of-range days into the alert table at ``path``. Without ``ranges`` the
    batch is scored already. A batch without such days writes nothing. Batches
    are numbered for each ``writer``, that is for each checkpoint."""
    def write(batch: DataFrame, batch_id: int) -> None:
        version = None
        if ranges is not None:
            table, version = current_ranges(batch.sparkSession, ranges)
            batch = score(batch, table, keys)
        alerts = batch.filter(F.col("out_of_range") == 1).withColumns({
            "batch_id": F.lit(batch_id).cast("long"), "range_version": F.lit(version).cast("long"),
            "scored_at": F.current_timestamp()})
        upsert_to_path(batch.sparkSession, alerts, path, ["date_", *keys], "scored_at", fmt, batch=(writer, batch_id))
    return write


def start_scorer(spark: SparkSession, source: DataFrame, ranges: DataFrame | str, out_path: str, checkpoint: str,
                 keys: list[str] = ("facility_id", "item_id"), ts_col: str = "order_date",
                 value: str = "sales_quantity", watermark: str = "1 day",
                 available_now: bool = True) -> StreamingQuery:
    """``ranges``: the path of a committed range table, read anew for every batch, or a fixed frame."""
    keys = list(keys)
    daily = daily_tumbling(source, ts_col, keys, value, watermark)
    w = (daily.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
              .foreachBatch(alert_writer(out_path, keys, ranges, writer=f"scorer {checkpoint}")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
