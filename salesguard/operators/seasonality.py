"""Seasonal decomposition and rolling spike detectors (M16-M22), as window plans.

Every window is partitioned by the series key (category or product) and
ordered by date; a series has one row per date, so a partition is bounded by
the number of days, never by the data volume. A frame that is one series of any
length is numbered by chunks and cut into blocks whose edges are lent to their
neighbours, so no window holds all of it.

M16 follows the public definition of the additive two-sided
``seasonal_decompose``: trend = centred moving average (NULL where the frame
is incomplete), detrended = x - trend, phase = row position mod period,
seasonal(phase) = mean detrended value of the phase minus the mean of the
phase means. Phase is by row position, so gaps in dates shift it (as in the
reference). Seasonal factors are rounded to 1e-9 so that they do not depend
on the summation order of a particular partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesguard.functions.scalar import flag, safe_div
from salesguard.plans.materialize import materialize


def r9(c):
    return F.round(c * 1e9, 0) / 1e9


def centred_trend(x: str, w, period: int):
    """Centred moving average of an odd or even period; NULL at the edges."""
    h = period // 2
    xc = F.col(x)
    if period % 2:
        frame = w.rowsBetween(-h, h)
        return F.when(F.count(xc).over(frame) == period, F.avg(xc).over(frame))
    inner = w.rowsBetween(-(h - 1), h - 1)
    lag, lead = F.lag(xc, h).over(w), F.lead(xc, h).over(w)
    full = F.count(xc).over(inner) == period - 1
    return F.when(full & lag.isNotNull() & lead.isNotNull(),
                  (F.sum(xc).over(inner) + 0.5 * (lag + lead)) / period)


def seasonal_decompose(series: DataFrame, keys: list[str], date: str, x: str, period: int,
                       min_rows: int = 60, out: str = "seasonal") -> DataFrame:
    """Add ``trend``, ``phase`` and the seasonal component ``out`` to series
    that have at least ``min_rows`` rows (shorter series are dropped). Without
    ``keys`` the whole frame is one series."""
    if not keys:
        return _decompose_whole(series, date, x, period, min_rows, out)
    w = Window.partitionBy(*keys).orderBy(date)
    d = (series.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
               .filter(F.col("_n") >= min_rows)
               .withColumn("_rn", F.row_number().over(w) - 1)
               .withColumn("trend", centred_trend(x, w, period))
               .withColumn("phase", F.col("_rn") % period))
    ph = (d.groupBy(*keys, "phase").agg(F.avg(F.col(x) - F.col("trend")).alias("_pavg")))
    ph = (ph.withColumn("_m", F.avg("_pavg").over(Window.partitionBy(*keys)))
            .select(*keys, "phase", r9(F.col("_pavg") - F.col("_m")).alias(out)))
    return d.join(ph, keys + ["phase"], "left").drop("_n", "_rn")


#: Rows of a block of an unkeyed series.
BLOCK = 1 << 16


def numbered(df: DataFrame, order: list[str], out: str) -> DataFrame:
    """W7 for a whole frame: the row's place (from 0) by ``order``, rows that tie as they are met.

    The frame is range-partitioned, sorted and written; a row's place is its place in
    its chunk and the sizes of the chunks before, one number for each."""
    chunk, place = F.spark_partition_id().alias("_chunk"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_at")
    laid = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", chunk, place))
    sizes = sorted(laid.groupBy("_chunk").agg(F.count("*")).collect())
    before, total = [], 0
    for c, n in sizes:
        before.append((c, total))
        total += n
    starts = df.sparkSession.createDataFrame(before, "_chunk int, _before long")
    return laid.join(F.broadcast(starts), "_chunk").withColumn(out, F.col("_before") + F.col("_at")).drop("_chunk", "_at", "_before")


def _decompose_whole(series: DataFrame, date: str, x: str, period: int, min_rows: int, out: str, block: int | None = None) -> DataFrame:
    block, halo = block or BLOCK, period // 2
    d = numbered(series, [date], "_rn")
    home = F.floor(F.col("_rn") / block)
    lent = F.array_distinct(F.array(F.floor((F.col("_rn") - halo) / block), home, F.floor((F.col("_rn") + halo) / block)))
    w = Window.partitionBy("_block").orderBy("_rn")
    d = (d.withColumns({"_home": home, "_block": F.explode(lent)}).withColumn("trend", centred_trend(x, w, period))
          .where("_block = _home").drop("_block", "_home").withColumn("phase", (F.col("_rn") % period).cast("int")))
    d = materialize(d.drop("_rn"))
    if d.count() < min_rows:
        return d.limit(0).withColumn(out, F.lit(None).cast("double"))
    ph = d.groupBy("phase").agg(F.avg(F.col(x) - F.col("trend")).alias("_pavg"))
    mean = ph.agg(F.avg("_pavg")).first()[0]                       # over ``period`` numbers
    factors = ph.select("phase", r9(F.col("_pavg") - F.lit(mean).cast("double")).alias(out))
    return d.join(factors, "phase", "left").select(*series.columns, "trend", "phase", out)


def seasonal_index(series: DataFrame, keys: list[str], date: str, x: str, period: int, by: str,
                   out: str, min_rows: int = 60) -> DataFrame:
    """Mean seasonal component per (key, calendar bucket ``by``).

    The components carry 9 decimals; they are summed as exact integer nanos and
    divided once, so the mean is the same for any partitioning or engine.
    """
    dec = seasonal_decompose(series, keys, date, x, period, min_rows, "_s")
    nanos = F.round(F.col("_s") * 1e9, 0).cast("long")
    return dec.groupBy(*keys, by).agg((F.round(F.sum(nanos) / F.count("_s"), 0) / 1e9).alias(out))


def deseasonalise(demand: DataFrame, monthly: DataFrame, weekly: DataFrame, x: str = "qty",
                  key: str = "l2_category", mode: str = "divide") -> DataFrame:
    """X / (monthly(dom) * weekly(dow)), missing factors count as 1.

    Factor tables have (categories x 31) rows at most; AQE turns these joins
    into broadcasts at run time from their measured size, so no hint is given.
    ``mode="subtract"`` removes additive factors instead of dividing (Q10).
    """
    j = (demand.join(monthly, [key, "dom"], "left")
               .join(weekly, [key, "dow"], "left"))
    m, wk = F.coalesce("monthly_seasonal", F.lit(1.0)), F.coalesce("weekly_seasonal", F.lit(1.0))
    if mode == "divide":
        adj = safe_div(F.col(x) * 1.00, m * wk)
    else:
        adj = F.col(x) - F.coalesce("monthly_seasonal", F.lit(0.0)) - F.coalesce("weekly_seasonal", F.lit(0.0))
    return j.withColumn("adjusted", adj)


def rolling_quantiles(df: DataFrame, keys: list[str], date: str, x: str, window: int = 21) -> DataFrame:
    """Median and quartiles of the ``window`` rows before each row
    (NULL until ``window`` earlier non-null values exist)."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(-window, -1)
    full = F.count(F.col(x)).over(w) == window
    q = F.percentile(F.col(x), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).over(w)
    return (df.withColumn("_q", F.when(full, q))
              .withColumns({"rolling_median": F.col("_q")[1], "rolling_75": F.col("_q")[2], "rolling_25": F.col("_q")[0]})
              .drop("_q").withColumn("IQR", F.col("rolling_75") - F.col("rolling_25")))


def rolling_iqr_spike(df: DataFrame, keys: list[str], date: str, x: str = "adjusted", factor: float = 1.5,
                      window: int = 21) -> DataFrame:
    """Spike when x is outside [q25 - k*IQR, q75 + k*IQR] of the previous rows."""
    d = rolling_quantiles(df, keys, date, x, window)
    hi = (factor * F.col("IQR")) + F.col("rolling_75")
    lo = F.col("rolling_25") - (factor * F.col("IQR"))
    return d.withColumn("spike", flag((F.col(x) > hi) | (F.col(x) < lo)))


def robust_z(df: DataFrame, keys: list[str], date: str, x: str = "adjusted", threshold: float = 3.0,
             window: int = 21) -> DataFrame:
    """(x - rolling median) / IQR >= threshold (IQR = 0 gives no flag)."""
    d = rolling_quantiles(df, keys, date, x, window)
    z = safe_div(F.col(x) - F.col("rolling_median"), F.col("IQR"))
    return d.withColumn("zscore", z).withColumn("spike", flag(z >= threshold))


def mean_ratio(df: DataFrame, keys: list[str], date: str, x: str = "adjusted", low: float = 0.85,
               high: float = 1.15, window: int = 21) -> DataFrame:
    """X / mean of the previous rows outside [low, high] (no ratio: no flag)."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(-window, -1)
    mean = F.when(F.count(F.col(x)).over(w) == window, F.avg(F.col(x)).over(w))
    r = safe_div(F.col(x), mean)
    return (df.withColumn("rolling_mean", mean).withColumn("ratio", r)
              .withColumn("spike", flag(r.isNotNull() & ((F.abs(r) < low) | (F.abs(r) > high)))))


def zscore(df: DataFrame, keys: list[str], x: str, threshold: float = 3.0) -> DataFrame:
    """z = (x - key mean) / key population std, missing x filled with the mean."""
    w = Window.partitionBy(*keys)
    mean = F.avg(F.col(x)).over(w)
    xf = F.coalesce(F.col(x).cast("double"), mean)
    z = safe_div(xf - mean, F.stddev_pop(F.col(x)).over(w))
    return df.withColumn("zscore", z).withColumn("z_flag", flag(F.abs(z) >= threshold))


def r6_col(name: str):
    """Round a named column to 6 digits (output form used for comparison)."""
    from salesguard.functions.scalar import r6
    return r6(F.col(name)).alias(name)


def rolling_mean_std(df: DataFrame, keys: list[str], date: str, x: str, window: int = 21) -> DataFrame:
    """Mean and sample standard deviation of the ``window`` rows before each
    row (NULL until ``window`` earlier values exist)."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(-window, -1)
    full = F.count(F.col(x)).over(w) == window
    return (df.withColumn("rolling_mean", F.when(full, F.avg(F.col(x)).over(w)))
              .withColumn("rolling_std", F.when(full, F.stddev_samp(F.col(x)).over(w))))


def rolling_ewm(df: DataFrame, keys: list[str], date: str, x: str, span: int = 21) -> DataFrame:
    """Exponentially weighted mean of the ``span`` rows before each row, with
    weights (1 - 2 / (span + 1)) ** age (NULL until ``span`` earlier values exist)."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(-span, -1)
    decay = 1.0 - 2.0 / (span + 1)
    weights = [decay ** age for age in range(span - 1, -1, -1)]
    total = F.aggregate(F.zip_with(F.col("_xs"), F.lit(weights), lambda v, k: v * k), F.lit(0.0), lambda a, v: a + v)
    return (df.withColumn("_xs", F.when(F.count(F.col(x)).over(w) == span,
                                        F.collect_list(F.col(x).cast("double")).over(w)))
              .withColumn("rolling_ewm", total / sum(weights)).drop("_xs"))
