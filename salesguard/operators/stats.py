"""Profiling statistics and simple detectors.

All are grouped aggregates or key-partitioned windows; per-key windows are
bounded by the number of days of the key's series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesguard.functions.scalar import flag, r6, safe_div, sample_kurtosis, sample_skewness


def profile_stats(df: DataFrame, keys: list[str], x: str) -> DataFrame:
    """Count, nulls, min, max, mean, sample std, bias-adjusted skewness and
    kurtosis, quartiles (linear interpolation) and IQR per key."""
    c = F.col(x).cast("double")
    n = F.count(c)
    agg = (df.groupBy(*keys)
             .agg(n.alias("n"), F.sum(F.col(x).isNull().cast("long")).alias("nulls"),
                  F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"),
                  F.stddev_samp(c).alias("std"), sample_skewness(c, n).alias("skew"),
                  sample_kurtosis(c, n).alias("kurt"),
                  F.percentile(c, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("_q")))
    return agg.select(*keys, "n", "nulls", "min", "max", *[r6(k).alias(k) for k in ("mean", "std", "skew", "kurt")],
                      r6(F.col("_q")[0]).alias("q25"), r6(F.col("_q")[1]).alias("median"),
                      r6(F.col("_q")[2]).alias("q75"), r6(F.col("_q")[2] - F.col("_q")[0]).alias("iqr"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of NULLs of every column (one scan, partial sums)."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A17."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def count_where(df: DataFrame, keys: list[str], cond: F.Column, out: str = "n") -> DataFrame:
    """Filtered count per key (``count_if``)."""
    return df.groupBy(*keys).agg(F.count_if(cond).alias(out))


def standardise(df: DataFrame, keys: list[str], cols: list[str], suffix: str = "_std") -> DataFrame:
    """M4: (x - key mean) / key population std (NULL for a constant key)."""
    w = Window.partitionBy(*keys)
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, safe_div(F.col(c) - F.avg(c).over(w), F.stddev_pop(c).over(w)))
    return out


def dbscan_1d(df: DataFrame, keys: list[str], x: str, eps: int = 2, min_samples: int = 3) -> DataFrame:
    """DBSCAN on one feature per key, with RANGE frames instead of a distance matrix.

    Works on each key's distinct values (weight = number of rows), so the
    window order is total and ties cannot change the result:
    core: at least ``min_samples`` rows within +-eps (itself included);
    clusters: runs of core values with gaps <= eps (gaps-and-islands);
    border: non-core value within eps of a core value joins the nearest core's
    cluster (ties: lower); noise: -1. Cluster ids are 0-based in value order.
    ``eps`` is an integer (Spark RANGE frame offsets).
    """
    h = df.groupBy(*keys, x).agg(F.count(F.lit(1)).alias("_w"))
    order = Window.partitionBy(*keys).orderBy(F.col(x))
    rng = order.rangeBetween(-eps, eps)
    d = h.withColumn("_core", F.sum("_w").over(rng) >= min_samples)
    core_x = F.when(F.col("_core"), F.col(x))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("_prev_core", F.last(core_x, ignorenulls=True).over(before))
    d = d.withColumn("_start", F.when(F.col("_core") & (F.col("_prev_core").isNull()
                                                        | (F.col(x) - F.col("_prev_core") > eps)), 1).otherwise(0))
    d = d.withColumn("_cid", F.when(F.col("_core"),
                                    F.sum("_start").over(order.rowsBetween(Window.unboundedPreceding, 0)) - 1))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    d = (d.withColumn("_lo_x", F.last(core_x, ignorenulls=True).over(upto))
          .withColumn("_lo_c", F.last(F.col("_cid"), ignorenulls=True).over(upto))
          .withColumn("_hi_x", F.first(core_x, ignorenulls=True).over(after))
          .withColumn("_hi_c", F.first(F.col("_cid"), ignorenulls=True).over(after)))
    dlo, dhi = F.col(x) - F.col("_lo_x"), F.col("_hi_x") - F.col(x)
    lo_ok = F.col("_lo_x").isNotNull() & (dlo <= eps)
    hi_ok = F.col("_hi_x").isNotNull() & (dhi <= eps)
    label = (F.when(F.col("_core"), F.col("_cid"))
              .when(lo_ok & (~hi_ok | (dlo <= dhi)), F.col("_lo_c"))
              .when(hi_ok, F.col("_hi_c"))
              .otherwise(F.lit(-1)))
    labels = d.select(*keys, x, label.cast("int").alias("dbscan_label"),
                      F.col("_core").cast("int").alias("dbscan_core"))
    return df.join(labels, keys + [x], "left")


def vote(df: DataFrame, flags: list[str], quorum: int, out: str = "vote_flag") -> DataFrame:
    """Consensus flag when at least ``quorum`` detector flags are 1 (NULL = 0)."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in flags), F.lit(0))
    return df.withColumn("votes", total).withColumn(out, flag(total >= quorum))


def evaluate(df: DataFrame, pred: str, truth: str, keys: list[str] | None = None) -> DataFrame:
    """tp/fp/fn/tn, precision, recall and F1 of a 0/1 prediction (one pass)."""
    p, t = F.col(pred) == 1, F.col(truth) == 1
    g = df.groupBy(*(keys or [])).agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"),
                                      F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"))
    prec = safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double"))
    rec = safe_div(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double"))
    f1 = safe_div(2 * prec * rec, prec + rec)
    return g.select(*(keys or []), "tp", "fp", "fn", "tn", r6(prec).alias("precision"), r6(rec).alias("recall"),
                    r6(f1).alias("f1"))


def within_range(daily: DataFrame, ranges: DataFrame, keys: list[str], x: str = "sales_quantity") -> DataFrame:
    """Score daily values against the range table (1 = outside [min, max])."""
    r = ranges.select(*keys, F.col("min").alias("range_min"), F.col("max").alias("range_max"))
    j = daily.join(r, keys, "left")
    v = F.col(x).cast("double")
    return j.withColumn("out_of_range", flag((v < F.col("range_min")) | (v > F.col("range_max"))))


def distinct_orders(lines: DataFrame, keys: list[str], min_orders: int) -> DataFrame:
    """Distinct carts per key, kept when above ``min_orders`` (Spark splits
    the distinct count by cart first, so a hot key is spread before the final count)."""
    return (lines.groupBy(*keys).agg(F.countDistinct("cart_id").alias("orders"))
                 .filter(F.col("orders") > min_orders))
