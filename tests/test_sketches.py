"""Day sketches against exact counts and quantiles."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from salesguard.operators import sales as S
from salesguard.operators import segments as G
from salesguard.operators import sketches as K
from salesguard.sources.tables import Catalog


def test_distinct_counts_within_the_bound_and_merged_by_day(spark):
    rows = spark.range(200_000).select((F.col("id") % 3).alias("k"), F.date_add(F.lit("2024-01-01"), (F.col("id") % 10).cast("int")).alias("ts"),
                                       (F.col("id") % 60_000).alias("item"))
    rows = rows.unionByName(rows.limit(50).withColumns({"k": F.lit(9).cast("long"), "item": F.lit(None).cast("long")}))
    days = K.day_counts(rows, ["k"], "ts", "item")
    assert days.count() == 30 + days.where("k = 9").count()
    exact = {r.k: r.n for r in rows.groupBy("k").agg(F.countDistinct("item").alias("n")).collect()}
    for r in K.distinct_count(days, ["k"]).collect():
        assert abs(r.n - exact[r.k]) <= 0.05 * exact[r.k]
    # a new day is only appended
    old, new = days.where("day < '2024-01-10'"), K.day_counts(rows.where("to_date(ts) = '2024-01-10'"), ["k"], "ts", "item")
    assert sorted(K.distinct_count(old.unionByName(new), ["k"]).collect()) == sorted(K.distinct_count(days, ["k"]).collect())


def test_sparse_keys_from_sketches(spark):
    lines = S.sales_lines(Catalog(spark, SF001), "2001-08-01", 2405)
    for level in ("store", "city", "country"):
        for least in (3, 9):
            a, b = (sorted(S.sparse_keys(lines, level, least, approximate=x).collect(), key=str) for x in (False, True))
            assert a == b
    assert K.sparse_from(K.day_counts(lines.limit(0), ["item_id"], "order_date", "cart_id"), ["item_id"]).collect() == []


def test_quantile_ranks_within_the_bound(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, 30_000), rng.exponential(5, 30_000)])
    rows = spark.createDataFrame([(k % 7, float(v)) for k, v in enumerate(x)] + [(0, None)], "d int, v double").select(
        F.lit("a").alias("k"), F.date_add(F.lit("2024-01-01"), F.col("d")).alias("date_"), "v")
    at = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = K.quantiles(K.day_values(rows, ["k"], "date_", "v"), ["k"], at).first().q
    for a, v in zip(at, got, strict=True):
        assert abs((x <= v).mean() - a) < 0.02


def test_imputation_from_sketches(spark):
    rng = np.random.default_rng(5)
    rows = [(k, f"2024-01-{1 + i % 28:02d}", float(v)) for k in range(3) for i, v in enumerate(rng.normal(50, 5, 3000))]
    rows += [(0, "2024-01-01", 900.0), (1, "2024-01-02", -900.0), (2, None, 51.0), (2, "2024-01-03", None)]
    df = spark.createDataFrame(rows, "k int, date_ string, v double")
    exact, near = (G.median_impute(df, ["k"], "v", out="w", approximate_by=by).collect() for by in (None, "date_"))
    a, b = ({(r.k, r.date_, r.v): r.w for r in x} for x in (exact, near))
    assert set(a) == set(b) and sum((a[k] == k[2]) != (b[k] == k[2]) for k in a) < 0.01 * len(a)
    assert abs(b[0, "2024-01-01", 900.0] - 50) < 1 and abs(b[1, "2024-01-02", -900.0] - 50) < 1
