"""Sinks (S4-S9, O5): CSV/parquet writers, declared schemas, upsert.

Files have no MERGE, so an upserted table is kept in buckets of its keys, and a
commit says which folder holds each bucket:

    base/_commits/00000000000000000007.json   version 7: schema, bucket -> folder
    base/data/7-<attempt>/bucket=12/...       the buckets that version 7 wrote

An upsert reads and rewrites only the buckets its rows fall in, writes them to a
folder of its own, and then publishes the commit by one rename that fails if
the version is taken. Readers go by the newest commit, so what an interrupted
write left behind is never seen, and a replay starts from the table as it was.
Where the target is a table with row-level operations, ``merge_into`` does the
same by ``MERGE INTO``.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared output contracts (S9): name, type, description.
RANGE_TABLE_SCHEMA = T.StructType([
    T.StructField("facility_id", T.IntegerType(), metadata={"comment": "facility the range holds for"}),
    T.StructField("item_id", T.IntegerType(), metadata={"comment": "item the range holds for"}),
    T.StructField("min", T.DoubleType(), metadata={"comment": "lowest usual daily quantity"}),
    T.StructField("max", T.DoubleType(), metadata={"comment": "highest usual daily quantity"}),
    T.StructField("updated_at", T.TimestampType(), metadata={"comment": "time of the computation, Indian Standard Time"}),
])
RANGE_ERROR_SCHEMA = T.StructType([
    T.StructField("facility_id", T.IntegerType()), T.StructField("item_id", T.IntegerType()),
    T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()),
    T.StructField("error_reason", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to a declared schema, carrying the descriptions."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name, metadata=f.metadata) for f in schema.fields])


def upsert_latest(existing: DataFrame, incoming: DataFrame, keys: list[str], incremental: str) -> DataFrame:
    """One row per key, the one with the greatest ``incremental`` value (nulls
    are least; ties: the incoming row, and of several incoming rows the greatest).

    A grouped ``max_by``: rows of a key are reduced before the shuffle. Null keys
    are a key like others. Columns that one side lacks are null there.
    """
    both = (existing.withColumn("_src", F.lit(0))
                    .unionByName(incoming.withColumn("_src", F.lit(1)), allowMissingColumns=True))
    rest = [c for c in both.columns if c not in (*keys, "_src")]
    row = F.struct(*[F.col(f"`{c}`") for c in rest])
    place = F.struct(F.col(f"`{incremental}`").isNotNull(), F.col(f"`{incremental}`"), F.col("_src"), row)
    best = both.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by(row, place).alias("_row"))
    return best.select(*[F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in both.columns if c != "_src"])


def sorted_for_keys(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Cluster output files by the sink's sort key."""
    d = df.repartition(partitions, *keys) if partitions else df.repartition(*keys)
    return d.sortWithinPartitions(*keys)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
          partition_by: list[str] | None = None) -> None:
    """Rebuild (overwrite), append, or truncate (overwrite with the frame)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


# ------------------------------------------------------------------ committed upsert
BUCKETS = 256


class ConcurrentCommit(RuntimeError):
    """Another writer published this version first."""


class _Files:
    """The few operations on a table's folder that a commit needs, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, base: str):
        self.sc, self.jvm = spark.sparkContext, spark.sparkContext._jvm
        self.base = base.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def names(self, folder: str) -> list[str]:
        p = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(p)] if self.fs.exists(p) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Writes a file whole or not at all; raises if it is there already. The file is
        written beside and renamed without overwriting, as streaming queries do with
        their logs: one step on file systems with an atomic rename."""
        folder, _, last = name.rpartition("/")
        attempt = self.path(f"{folder}/.{last}.{uuid.uuid4().hex}")
        stream = self.fs.create(attempt, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        kind = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.sc._gateway.new_array(kind, 1)
        how[0] = kind.NONE
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(attempt.toUri(), self.sc._jsc.hadoopConfiguration())
        try:
            context.rename(self.fs.makeQualified(attempt), self.fs.makeQualified(self.path(name)), how)
        except Py4JJavaError as e:
            self.fs.delete(attempt, False)
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            raise ConcurrentCommit(name) from e

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def _commits(files: _Files) -> list[str]:
    return sorted(n for n in files.names("_commits") if n.endswith(".json") and not n.startswith("."))


def latest_commit(spark: SparkSession, base: str) -> dict | None:
    """The newest committed version: ``version, format, keys, bucket_by, buckets,
    schema, folders`` (bucket to folder) and ``batches`` (last batch of each writer)."""
    files = _Files(spark, base)
    names = _commits(files)
    return json.loads(files.read(f"_commits/{names[-1]}")) if names else None


def _load(spark: SparkSession, base: str, commit: dict, folders: list[str]) -> DataFrame:
    schema = T.StructType.fromJson(commit["schema"])
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).format(commit["format"])
    reader = reader.option("header", True) if commit["format"] == "csv" else reader
    return reader.load([f"{base.rstrip('/')}/{f}" for f in folders])


def read_table(spark: SparkSession, base: str, version: int | None = None) -> DataFrame | None:
    """The rows of the newest committed version, or of ``version``; None if there is none."""
    files = _Files(spark, base)
    names = _commits(files)
    if version is not None:
        names = [n for n in names if int(n.split(".")[0]) == version]
    if not names:
        return None
    commit = json.loads(files.read(f"_commits/{names[-1]}"))
    return _load(spark, base, commit, sorted(commit["folders"].values()))


def upsert_to_path(spark: SparkSession, incoming: DataFrame, base: str, keys: list[str], incremental: str,
                   fmt: str = "parquet", bucket_by: list[str] | None = None, buckets: int = BUCKETS,
                   batch: tuple[str, int] | None = None, attempts: int = 5) -> int:
    """S6 on files: merges ``incoming`` into the table at ``base``; returns its version.

    ``bucket_by`` (some of the keys, by default the first) decides the bucket, so
    rows of few facilities, or days, rewrite few buckets. Both settings hold
    from the first commit on. ``batch`` is a writer's name and running number:
    a number that a commit already has is not merged again. If another writer
    takes the version, the merge starts again from that version's rows, at most
    ``attempts`` times. New columns are added to the table, null in old rows.
    Rows that share a key are reduced first; no rows make no commit (-1 if the
    table has none). An interrupted call leaves a folder that no commit names;
    ``vacuum`` deletes it.
    """
    for _ in range(attempts):
        try:
            return _merge(spark, incoming, base, keys, incremental, fmt, bucket_by, buckets, batch)
        except ConcurrentCommit as e:
            taken = e
    raise taken


def _merge(spark, incoming, base, keys, incremental, fmt, bucket_by, buckets, batch) -> int:
    files, old = _Files(spark, base), latest_commit(spark, base)
    version = old["version"] if old else -1
    batches = dict(old["batches"]) if old else {}
    if batch and batches.get(batch[0], -1) >= batch[1]:
        return version
    if old:
        fmt, bucket_by, buckets = old["format"], old["bucket_by"], old["buckets"]
        if old["keys"] != list(keys):
            raise ValueError(f"the table's keys are {old['keys']}")
    bucket_by = list(bucket_by or keys[:1])
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in bucket_by]), F.lit(buckets)).cast("int")
    touched = [r[0] for r in incoming.select(bucket.alias("bucket")).distinct().collect()]      # at most ``buckets``
    if not touched:
        return version
    known = dict(old["folders"]) if old else {}
    there = _load(spark, base, old, [known[str(b)] for b in touched if str(b) in known]) if old else incoming.limit(0)
    merged = upsert_latest(there, incoming, list(keys), incremental)
    schema = merged.schema
    out = (merged.withColumn("bucket\0", bucket).repartition("bucket\0").sortWithinPartitions("bucket\0", *[f"`{k}`" for k in keys])
           .withColumnRenamed("bucket\0", "_bucket"))
    folder = f"data/{version + 1}-{uuid.uuid4().hex}"
    write(out, f"{files.base}/{folder}", fmt, "errorifexists", ["_bucket"])
    known |= {str(b): f"{folder}/_bucket={b}" for b in touched}
    if batch:
        batches[batch[0]] = batch[1]
    commit = {"version": version + 1, "format": fmt, "keys": list(keys), "bucket_by": bucket_by, "buckets": buckets,
              "schema": json.loads(schema.json()), "folders": known, "batches": batches}
    files.fs.mkdirs(files.path("_commits"))
    files.publish(f"_commits/{version + 1:020d}.json", json.dumps(commit))
    return version + 1


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Deletes data folders that none of the newest ``keep`` commits names, and older
    commits. Not to be run beside a writer, whose folder has no commit yet."""
    files = _Files(spark, base)
    names = _commits(files)
    kept = names[-keep:]
    live = {f.split("/")[1] for n in kept for f in json.loads(files.read(f"_commits/{n}"))["folders"].values()}
    gone = [f"data/{n}" for n in files.names("data") if n not in live]
    gone += [f"_commits/{n}" for n in files.names("_commits") if n not in kept and not n.endswith(".crc")]
    for name in gone:
        files.delete(name)
    return gone


def merge_into(incoming: DataFrame, table: str, keys: list[str], incremental: str) -> None:
    """S6 on a catalog table with row-level operations: the newest incoming row of
    each key replaces an older one or is inserted. Spark raises an
    ``UnsupportedOperationException`` if the table's format can't; plain files can't."""
    best = upsert_latest(incoming.limit(0), incoming, keys, incremental).alias("new")
    same = [F.col(f"new.`{k}`").eqNullSafe(F.col(f"{table}.`{k}`")) for k in keys]
    on = same[0]
    for x in same[1:]:
        on = on & x
    new, old = F.col(f"new.`{incremental}`"), F.col(f"{table}.`{incremental}`")
    best.mergeInto(table, on).whenMatched(old.isNull() | (new >= old)).updateAll().whenNotMatched().insertAll().merge()
