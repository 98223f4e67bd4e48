"""Decomposition and rolling spikes on literal series."""

import datetime as dt

from salesguard.operators import seasonality as SE


def series(spark, values, start=dt.date(2024, 1, 1), key="A"):
    return spark.createDataFrame([(key, start + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)],
                                 "k string, date date, qty double")


def test_weekly_pattern_recovered(spark):
    pattern = [0, 1, 2, 3, 4, 5, 6]
    df = series(spark, [10 + pattern[i % 7] for i in range(70)])
    d = SE.seasonal_decompose(df, ["k"], "date", "qty", 7)
    phase = {r["phase"]: r["seasonal"] for r in d.select("phase", "seasonal").distinct().collect()}
    assert abs(sum(phase.values())) < 1e-6
    assert [round(phase[p], 6) for p in range(7)] == [p - 3.0 for p in pattern]


def test_short_series_dropped(spark):
    assert SE.seasonal_decompose(series(spark, range(59)), ["k"], "date", "qty", 7).count() == 0
    assert SE.seasonal_decompose(series(spark, range(60)), ["k"], "date", "qty", 7).count() == 60


def test_even_period_trend_is_centred(spark):
    df = series(spark, range(100))
    d = {r["date"]: r["trend"] for r in SE.seasonal_decompose(df, ["k"], "date", "qty", 30).collect()}
    start = dt.date(2024, 1, 1)
    assert d[start + dt.timedelta(days=14)] is None
    assert abs(d[start + dt.timedelta(days=15)] - 15.0) < 1e-9     # linear series: trend = value


def test_spike_needs_21_previous_rows(spark):
    vals = [10.0, 11.0, 12.0] * 7 + [100.0]
    df = series(spark, vals).withColumnRenamed("qty", "adjusted")
    got = [r["spike"] for r in SE.rolling_iqr_spike(df, ["k"], "date").orderBy("date").collect()]
    assert got[:21] == [0] * 21 and got[21] == 1
    df20 = series(spark, vals[1:]).withColumnRenamed("qty", "adjusted")
    assert all(r["spike"] == 0 for r in SE.rolling_iqr_spike(df20, ["k"], "date").collect())


def test_zero_iqr_gives_no_robust_z(spark):
    df = series(spark, [5.0] * 21 + [6.0]).withColumnRenamed("qty", "adjusted")
    assert all(r["spike"] == 0 for r in SE.robust_z(df, ["k"], "date").collect())


def test_a_whole_frame_is_decomposed_like_one_key(spark):
    import random
    rng = random.Random(3)
    for period, n in ((7, 300), (30, 301), (2, 64)):
        values = [rng.uniform(5, 20) if i % 41 else None for i in range(n)]
        rows = [("A", dt.date(2024, 1, 1) + dt.timedelta(days=2 * i), v) for i, v in enumerate(values)]
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k string, date date, qty double").repartition(4)
        keyed = {r.date: r for r in SE.seasonal_decompose(df, ["k"], "date", "qty", period).collect()}
        for block in (16, 1 << 16):
            whole = SE._decompose_whole(df, "date", "qty", period, 60, "seasonal", block)
            assert "Window [" not in whole._jdf.queryExecution().optimizedPlan().toString()      # written before
            got = whole.collect()
            assert len(got) == n
            for r in got:
                k = keyed[r.date]
                assert (r.phase, r.qty) == (k.phase, k.qty) and (r.trend is None) == (k.trend is None)
                assert r.trend is None or abs(r.trend - k.trend) < 1e-9
                assert abs(r.seasonal - k.seasonal) < 2e-9
    assert SE.seasonal_decompose(series(spark, range(59)), [], "date", "qty", 7).collect() == []
    assert SE.seasonal_decompose(series(spark, range(60)), [], "date", "qty", 7).count() == 60


def test_places_over_many_chunks(spark):
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = SE.numbered(spark.range(1000).selectExpr("id * 7 % 1000 AS v"), ["v"], "at").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted((r.v, r["at"]) for r in got) == [(k, k) for k in range(1000)]
