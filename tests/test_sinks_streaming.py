"""Upsert, versioned sink and the streaming scorer (file source, AvailableNow)."""

import datetime as dt
import os

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from salesguard.sources import sinks as SK
from salesguard.streaming import scorer as SC

RANGE = "facility_id int, item_id int, min double, max double, updated_at timestamp_ntz"


def test_upsert_latest_and_idempotent(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    old = spark.createDataFrame([(1, 1, 1.0, 5.0, t1), (1, 2, 2.0, 6.0, t1)], RANGE)
    new = spark.createDataFrame([(1, 1, 1.5, 4.0, t2), (1, 3, 1.0, 2.0, t2)], RANGE)
    once = SK.upsert_latest(old, new, ["facility_id", "item_id"], "updated_at")
    twice = SK.upsert_latest(once, new, ["facility_id", "item_id"], "updated_at")
    got = sorted(tuple(r) for r in once.collect())
    assert got == sorted(tuple(r) for r in twice.collect())
    assert {(r[1], r[2]) for r in got} == {(1, 1.5), (2, 2.0), (3, 1.0)}


def test_upsert_latest_ties_nulls_and_columns(spark):
    old = spark.createDataFrame([(1, 5, "old"), (2, None, "old"), (None, 1, "old"), (4, 9, "old")], "k int, at int, x string")
    new = spark.createDataFrame([(1, 5, "new", 1), (2, 0, "new", 1), (None, 2, "new", 1), (4, 8, "new", 1), (5, None, "a", 1),
                                 (5, None, "b", 1)], "k int, at int, x string, y int")
    got = {(r.k, r.at, r.x, r.y) for r in SK.upsert_latest(old, new, ["k"], "at").collect()}
    assert got == {(1, 5, "new", 1), (2, 0, "new", 1), (None, 2, "new", 1), (4, 9, "old", None), (5, None, "b", 1)}
    plan = SK.upsert_latest(old, new, ["k"], "at")._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_max_by" in plan


T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
KEYS = ["facility_id", "item_id"]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_path(spark, scratch):
    base = f"{scratch}/ranges"
    a = spark.createDataFrame([(1, 1, 1.0, 5.0, T1), (2, 1, 1.0, 5.0, T1)], RANGE)
    assert SK.read_table(spark, base) is None and SK.latest_commit(spark, base) is None
    assert SK.upsert_to_path(spark, a.limit(0), base, KEYS, "updated_at") == -1
    assert SK.upsert_to_path(spark, a, base, KEYS, "updated_at") == 0
    assert SK.upsert_to_path(spark, a, base, KEYS, "updated_at") == 1
    assert rows(SK.read_table(spark, base)) == rows(a) == rows(SK.read_table(spark, base, 0))
    b = spark.createDataFrame([(2, 1, 2.0, 6.0, T2, "n"), (3, 1, 1.0, 1.0, T2, "n")], RANGE + ", note string")
    SK.upsert_to_path(spark, b, base, KEYS, "updated_at")
    assert rows(SK.read_table(spark, base)) == [(1, 1, 1.0, 5.0, T1, None), (2, 1, 2.0, 6.0, T2, "n"), (3, 1, 1.0, 1.0, T2, "n")]
    assert rows(SK.read_table(spark, base, 1)) == rows(a)
    with pytest.raises(ValueError, match="keys"):
        SK.upsert_to_path(spark, a, base, ["item_id"], "updated_at")


def test_csv_upsert(spark, scratch):
    a = spark.createDataFrame([(1, "x", 1), (2, "y, z", 1)], "k int, t string, at int")
    SK.upsert_to_path(spark, a, f"{scratch}/c", ["k"], "at", fmt="csv")
    SK.upsert_to_path(spark, a.where("k = 2").withColumn("at", F.lit(2)), f"{scratch}/c", ["k"], "at", fmt="csv")
    assert rows(SK.read_table(spark, f"{scratch}/c")) == [(1, "x", 1), (2, "y, z", 2)]


@pytest.mark.parametrize("when", ["files", "marker"])
def test_an_interrupted_upsert_leaves_the_table_as_it_was(spark, scratch, monkeypatch, when):
    base = f"{scratch}/ranges"
    a = spark.createDataFrame([(k, 1, 1.0, 5.0, T1) for k in range(20)], RANGE)
    SK.upsert_to_path(spark, a, base, KEYS, "updated_at", buckets=4)
    b = spark.createDataFrame([(k, 1, 2.0, 6.0, T2) for k in range(10, 30)], RANGE)

    def die(*args, **kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if when == "files":                                # some files are there, no _SUCCESS
            m.setattr(SK, "write", lambda df, path, *r: (df.limit(3).write.parquet(path), os.remove(f"{path}/_SUCCESS"), die()))
        else:                                              # all files, and the text of the commit, but not its name
            m.setattr(SK._Files, "publish", lambda self, name, text: (open(f"{base}/_commits/.{name[9:]}.x", "w").write(text[:9]), die()))
        with pytest.raises(KeyboardInterrupt):
            SK.upsert_to_path(spark, b, base, KEYS, "updated_at")
    assert rows(SK.read_table(spark, base)) == rows(a)
    assert SK.upsert_to_path(spark, b, base, KEYS, "updated_at") == 1
    want = [(k, 1, 1.0, 5.0, T1) for k in range(10)] + [(k, 1, 2.0, 6.0, T2) for k in range(10, 30)]
    assert rows(SK.read_table(spark, base)) == want
    assert len(SK._Files(spark, base).names("data")) == 3
    gone = SK.vacuum(spark, base, keep=1)
    assert sum(g.startswith("data/") for g in gone) >= 1 and rows(SK.read_table(spark, base)) == want
    assert SK.upsert_to_path(spark, a, base, KEYS, "updated_at") == 2 and rows(SK.read_table(spark, base)) == want


def test_a_leftover_folder_is_no_version(spark, scratch):
    base = f"{scratch}/ranges"
    a = spark.createDataFrame([(1, 1, 1.0, 5.0, T1)], RANGE)
    os.makedirs(f"{base}/data/0-leftover/_temporary")
    os.makedirs(f"{base}/version=3/_temporary")
    assert SK.upsert_to_path(spark, a, base, KEYS, "updated_at") == 0
    assert rows(SK.read_table(spark, base)) == rows(a)


def test_two_writers(spark, scratch, monkeypatch):
    base = f"{scratch}/ranges"
    SK.upsert_to_path(spark, spark.createDataFrame([(0, 0, 0.0, 0.0, T1)], RANGE), base, KEYS, "updated_at", buckets=1)
    publish, first = SK._Files.publish, []

    def late(self, name, text):
        if not first:                                      # another writer is quicker, in the same bucket
            first.append(name)
            SK.upsert_to_path(spark, spark.createDataFrame([(1, 1, 1.0, 1.0, T1)], RANGE), base, KEYS, "updated_at")
        publish(self, name, text)

    monkeypatch.setattr(SK._Files, "publish", late)
    assert SK.upsert_to_path(spark, spark.createDataFrame([(2, 2, 2.0, 2.0, T1)], RANGE), base, KEYS, "updated_at") == 2
    assert [r[0] for r in rows(SK.read_table(spark, base))] == [0, 1, 2]
    first.clear()
    with pytest.raises(SK.ConcurrentCommit):
        SK.upsert_to_path(spark, spark.createDataFrame([(3, 3, 2.0, 2.0, T1)], RANGE), base, KEYS, "updated_at", attempts=1)
    assert [r[0] for r in rows(SK.read_table(spark, base))] == [0, 1, 2]


def test_one_facility_of_a_hundred_rewrites_one_bucket(spark, scratch):
    base = f"{scratch}/ranges"
    a = spark.range(10_000).select((F.col("id") % 100).cast("int").alias("facility_id"), F.floor(F.col("id") / 100).cast("int").alias("item_id"),
                                   F.lit(1.0).alias("min"), F.lit(2.0).alias("max"), F.lit(T1).cast("timestamp_ntz").alias("updated_at"))
    SK.upsert_to_path(spark, a, base, KEYS, "updated_at", buckets=1000)
    before = SK.latest_commit(spark, base)["folders"]
    b = a.where("facility_id = 7").withColumns({"max": F.lit(3.0), "updated_at": F.lit(T2).cast("timestamp_ntz")})
    SK.upsert_to_path(spark, b, base, KEYS, "updated_at")
    after = SK.latest_commit(spark, base)["folders"]
    assert len(before) >= 90 and [k for k in after if after[k] != before[k]] and sum(after[k] != before[k] for k in after) == 1
    assert SK.read_table(spark, base).groupBy("max").count().orderBy("max").collect() == [(2.0, 9900), (3.0, 100)]


def test_merge_into_needs_row_level_operations(spark, scratch):
    a = spark.createDataFrame([(1, 1)], "k int, at int")
    a.write.mode("overwrite").option("path", f"{scratch}/t").saveAsTable("plain_files")
    try:
        with pytest.raises(UnsupportedOperationException, match="MERGE"):
            SK.merge_into(a, "plain_files", ["k"], "at")
    finally:
        spark.sql("DROP TABLE plain_files")


def stream_source(spark, path, days, sales=lambda d, q: q + (20 if d == 2 else 0)):
    data = [(dt.datetime(2024, 1, 1 + d, 10), 1, 1, sales(d, q)) for d in days for q in (3, 4)]
    spark.createDataFrame(data, "order_date timestamp_ntz, facility_id int, item_id int, sales_quantity int").write.mode("append").parquet(path)
    return spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)


def test_streaming_scorer_available_now(spark, scratch):
    src = f"{scratch}/src"
    stream = stream_source(spark, src, range(5))
    late = spark.createDataFrame([(dt.datetime(2023, 12, 1, 10), 1, 1, 999)], stream.schema)
    late.write.mode("append").parquet(src)
    ranges = spark.createDataFrame([(1, 1, 5.0, 10.0, dt.datetime(2024, 1, 1))], RANGE)
    q = SC.start_scorer(spark, stream, ranges, f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(120)
    table = SK.read_table(spark, f"{scratch}/out")
    got = {r["date_"]: (r["sales_quantity"], r["out_of_range"]) for r in table.collect()}
    # of the windows closed by the watermark, these are out of range (the old row came with the first batch)
    assert got == {dt.date(2023, 12, 1): (999, 1), dt.date(2024, 1, 3): (47, 1)}
    # a replayed batch changes nothing, and one without alerts writes nothing
    was, version = rows(table), SK.latest_commit(spark, f"{scratch}/out")["version"]
    again = table.drop("batch_id", "range_version", "scored_at")
    write = SC.alert_writer(f"{scratch}/out", KEYS, writer=f"scorer {scratch}/ckpt")
    for k in range(2):
        write(again, k)
    write(again.withColumn("out_of_range", F.lit(0)), 9)
    assert rows(SK.read_table(spark, f"{scratch}/out")) == was and SK.latest_commit(spark, f"{scratch}/out")["version"] == version
    assert os.path.isdir(f"{scratch}/ckpt")


def test_stream_reads_the_ranges_of_the_moment(spark, scratch):
    src, out, at = f"{scratch}/src", f"{scratch}/out", f"{scratch}/ranges"
    stream = stream_source(spark, src, range(3), lambda d, q: q)            # 7 a day
    SC.start_scorer(spark, stream, at, out, f"{scratch}/ckpt").awaitTermination(120)
    assert SK.read_table(spark, out) is None               # no ranges yet, so nothing is out of range
    SK.upsert_to_path(spark, spark.createDataFrame([(1, 1, 5.0, 10.0, T1)], RANGE), at, KEYS, "updated_at")
    stream_source(spark, src, range(3, 6), lambda d, q: q)
    SC.start_scorer(spark, stream, at, out, f"{scratch}/ckpt").awaitTermination(120)
    assert SK.read_table(spark, out) is None
    SK.upsert_to_path(spark, spark.createDataFrame([(1, 1, 8.0, 10.0, T2)], RANGE), at, KEYS, "updated_at")
    stream_source(spark, src, range(6, 10), lambda d, q: q)
    SC.start_scorer(spark, stream, at, out, f"{scratch}/ckpt").awaitTermination(120)
    got = SK.read_table(spark, out).collect()
    assert {r.range_version for r in got} == {1} and min(r.date_ for r in got) >= dt.date(2024, 1, 4)
    assert len(got) >= 2 and all(r.range_min == 8.0 for r in got)
