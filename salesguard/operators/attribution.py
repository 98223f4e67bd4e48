"""Attribution rules T1-T13: why was a store-day an outlier.

Each rule adds one 0/1 column to the store-level report frame (one row per
date x city x facility x item). Group statistics are grouped aggregates joined
back on their keys (J7): aggregation is partial before the shuffle, NULL keys
never match (as pandas drops them), and AQE can turn the small side into a
broadcast or split a skewed key at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesguard.functions.scalar import flag, r6, safe_div
from salesguard.operators import sales as S
from salesguard.sources.tables import Catalog

STORE = ["city_name", "facility_id", "item_id"]
STORE_TYPE_DAY = ["date_", "city_name", "facility_id", "p_type"]
HFS_DAYS = [1, 2, 3, 4, 5, 6, 7]       # fixed: start-of-month days
EVENT_LIFT = 1.5


def _q():
    return F.col("sales_quantity").cast("double")


def _is_hfs_day():
    return F.dayofmonth("date_").isin(*HFS_DAYS)


def with_p_type(report: DataFrame, cat: Catalog) -> DataFrame:
    """One product type per item (left join; missing -> NULL)."""
    return report.join(cat.item_types, "item_id", "left")


def event_flag(report: DataFrame, calendar: DataFrame, require_event: bool = False,
               base: DataFrame | None = None, out: str = "event_flag") -> DataFrame:
    """Quantity >= 1.5 x the store's mean daily quantity of the item's type.

    ``require_event`` (T2) keeps only dates present in the calendar (inner
    join, one row per date); T1 (default) does not need an event (SURVEY Q4).
    ``base`` is the frame the type-day sums come from (default: the report).
    """
    base = base if base is not None else report
    type_day = base.groupBy(*STORE_TYPE_DAY).agg(F.sum("sales_quantity").alias("_type_q"))
    cpd = type_day.groupBy("city_name", "facility_id", "p_type").agg(F.avg("_type_q").alias("_cpd"))
    t = type_day.join(cpd, ["city_name", "facility_id", "p_type"], "left")
    if require_event:
        days = calendar.select(F.col("event_date").alias("date_")).distinct()
        t = t.join(days, "date_", "left_semi")
    t = t.select(*STORE_TYPE_DAY, (EVENT_LIFT * F.col("_cpd")).alias("_cpd15"))
    r = report.join(t, STORE_TYPE_DAY, "left")
    return r.withColumn(out, flag((_q() >= F.col("_cpd15")) & (F.col("outlier_flag") == 1))).drop("_cpd15")


def seasonality_flag(report: DataFrame, store_searches: DataFrame, city_searches: DataFrame) -> DataFrame:
    """Searches above 0.3*q + 0.7*searches at both store and city, on outlier days."""
    r = (report.join(store_searches, ["facility_id", "item_id"], "left")
               .join(city_searches, ["city_name", "item_id"], "left"))
    sc = 0.3 * _q() + 0.7 * F.col("store_searches")
    cc = 0.3 * _q() + 0.7 * F.col("city_searches")
    r = (r.withColumn("store_seasonality_flag", flag(F.col("store_searches") > sc))
          .withColumn("city_seasonality_flag", flag(F.col("city_searches") > cc)))
    return r.withColumn("seasonality_flag", flag((F.col("store_seasonality_flag") == 1)
                                                 & (F.col("city_seasonality_flag") == 1)
                                                 & (F.col("outlier_flag") == 1)))


def hfs_flag(report: DataFrame) -> DataFrame:
    """T4: start-of-month day with quantity >= lift x non-start mean, per store key.

    Both means come from one pass (conditional averages); keys missing either
    side get no bump value and therefore 0.
    """
    m = report.groupBy(*STORE).agg(F.avg(F.when(~_is_hfs_day(), _q())).alias("_non"),
                                   F.avg(F.when(_is_hfs_day(), _q())).alias("_hfs"))
    m = m.filter(F.col("_non").isNotNull() & F.col("_hfs").isNotNull())
    bump = (F.col("_hfs") / F.col("_non")) * F.col("_non")
    r = report.join(m.select(*STORE, bump.alias("hfs_bump_value")), STORE, "left")
    return r.withColumn("hfs_flag", flag(_is_hfs_day() & (_q() >= F.col("hfs_bump_value"))
                                         & (F.col("outlier_flag") == 1)))


def hfs_flag_top_cluster(seg: DataFrame) -> DataFrame:
    """T5: as T4 with means over all of the key's days and the top cluster instead
    of the outlier flag (the store notebook's variant), per store key."""
    m = seg.groupBy(*STORE).agg(F.avg(F.when(~_is_hfs_day(), _q())).alias("_non"),
                                F.avg(F.when(_is_hfs_day(), _q())).alias("_hfs"))
    bump = (F.col("_hfs") / F.col("_non")) * F.col("_non")
    r = seg.join(m.select(*STORE, bump.alias("hfs_bump_value")), STORE, "left")
    return r.withColumn("hfs_flag", flag(_is_hfs_day() & (_q() >= F.col("hfs_bump_value"))
                                         & (F.col("cluster") == 3)))


def bulk_flag(report: DataFrame, days: list[int] | None = HFS_DAYS) -> DataFrame:
    """Quantity >= lift x non-outlier mean (T7: x outlier mean) on outlier days.

    The reference restricts it to days 1..7 (SURVEY Q5); ``days=None`` lifts it.
    Keys without non-outlier days get no bump value.
    """
    m = report.groupBy(*STORE).agg(F.avg(F.when(F.col("outlier_flag") == 0, _q())).alias("_non"),
                                   F.avg(F.when(F.col("outlier_flag") == 1, _q())).alias("_out"))
    m = m.filter(F.col("_non").isNotNull())
    lift = F.col("_out") / F.col("_non")
    m = m.select(*STORE, (lift * F.col("_non")).alias("outlier_bump_value"),
                 (lift * F.col("_out")).alias("outlier_bump_value_new"))
    r = report.join(m, STORE, "left")
    day_ok = F.dayofmonth("date_").isin(*days) if days else F.lit(True)
    out = F.col("outlier_flag") == 1
    return (r.withColumn("bulk_buying_flag", flag(day_ok & (_q() >= F.col("outlier_bump_value")) & out))
             .withColumn("bulk_buying_flag_new", flag(day_ok & (_q() >= F.col("outlier_bump_value_new")) & out)))


def bulk_flag_ipc(seg: DataFrame) -> DataFrame:
    """Items per cart >= (top-cluster mean q / middle mean q) x middle mean ipc,
    on top-cluster days, per store key."""
    m = seg.groupBy(*STORE).agg(F.avg(F.when(F.col("cluster") == 2, _q())).alias("_mid_q"),
                                F.avg(F.when(F.col("cluster") == 3, _q())).alias("_top_q"),
                                F.avg(F.when(F.col("cluster") == 2, F.col("ipc"))).alias("_mid_ipc"))
    val = safe_div(F.col("_top_q"), F.col("_mid_q")) * F.col("_mid_ipc")
    r = seg.join(m.select(*STORE, val.alias("bulk_buying_value")), STORE, "left")
    return r.withColumn("bulk_flag", flag((F.col("ipc") >= F.col("bulk_buying_value")) & (F.col("cluster") == 3)))


def surge_lines(cat: Catalog, as_of: str | None = None, days: int | None = 7, active_only: bool = False) -> DataFrame:
    """Order lines of store outlets with a surge marker, filtered as sales lines.
    ``active_only`` keeps lines of active outlets."""
    f = cat.fact_items.filter(S.valid_line_filter(as_of, days))
    so = S.store_outlets(cat)
    if active_only:
        so = so.filter(F.col("active") == 1)
    return f.join(so, "outlet_id").select(
        F.to_date("checkout_ts").alias("date_"), "facility_id", "cart_id",
        F.when(F.col("slot_charge") > 0, 1).otherwise(0).alias("surge_charges"))


def surge_penetration(cat: Catalog, as_of: str | None = None, days: int | None = 7) -> DataFrame:
    """D17 + T9: share of order lines with a slot charge per day x facility, and
    the flag "above the facility's unweighted mean share" (dates, SURVEY Q3)."""
    s = (surge_lines(cat, as_of, days).groupBy("date_", "facility_id")
         .agg((F.sum("surge_charges") * 1.00 / F.count("cart_id")).alias("surge_share")))
    overall = F.avg("surge_share").over(Window.partitionBy("facility_id"))
    return (s.withColumn("_overall", overall)
             .select("date_", "facility_id", r6("surge_share").alias("surge_share"),
                     flag(F.col("surge_share") > F.col("_overall")).alias("surge_flag")))


def surge_flag(report: DataFrame, pen: DataFrame) -> DataFrame:
    """T9 on the report: surge day of the facility and outlier."""
    r = report.join(pen.select("date_", "facility_id", F.col("surge_flag").alias("_sf")),
                    ["date_", "facility_id"], "left")
    return r.withColumn("surge_flag", flag((F.col("_sf") == 1) & (F.col("outlier_flag") == 1))).drop("_sf")


def surge_days(cat: Catalog, as_of: str | None = None, days: int | None = 90) -> DataFrame:
    """Distinct (date, facility) with any slot charge at an active outlet."""
    return (surge_lines(cat, as_of, days, active_only=True).filter(F.col("surge_charges") == 1)
            .select("date_", "facility_id").distinct())


def surge_flag_days(seg: DataFrame, sdays: DataFrame) -> DataFrame:
    """Surge day and not in the middle cluster (unclustered rows: 0)."""
    r = seg.join(sdays.withColumn("_surge", F.lit(1)), ["date_", "facility_id"], "left")
    return r.withColumn("surge_flag", flag(F.col("cluster").isin(1, 3) & (F.col("_surge") == 1))).drop("_surge")


def cannibalization_flag(report: DataFrame) -> DataFrame:
    """V = (P + P*G) - G with P = q / type-day total, G = (q - key mean)/q;
    flag when V is above the store-day-type mean of V, on outlier days."""
    tot = report.groupBy(*STORE_TYPE_DAY).agg(F.sum("sales_quantity").alias("total_sales_ptype"))
    avg3 = report.groupBy(*STORE).agg(F.avg(_q()).alias("avg_3m_sales"))
    r = report.join(tot, STORE_TYPE_DAY, "left").join(avg3, STORE, "left")
    p = safe_div(_q(), F.col("total_sales_ptype").cast("double"))
    g = safe_div(_q() - F.col("avg_3m_sales"), _q())
    r = r.withColumn("cannibalization_value", (p + p * g) - g)
    av = r.groupBy(*STORE_TYPE_DAY).agg(F.avg("cannibalization_value").alias("average_cannibalization_value"))
    r = r.join(av, STORE_TYPE_DAY, "left")
    return r.withColumn("cannibalization_flag",
                        flag((F.col("cannibalization_value") > F.col("average_cannibalization_value"))
                             & (F.col("outlier_flag") == 1)))


def ptype_store_day(seg: DataFrame) -> DataFrame:
    """Mean quantity and mean items-per-cart per store x day x product type."""
    return (seg.groupBy(*STORE_TYPE_DAY)
               .agg(r6(F.avg(_q())).alias("ptype_mean_quantity"), r6(F.avg("ipc")).alias("ptype_mean_ipc"),
                    F.count(F.lit(1)).cast("long").alias("items")))


REPORT_COLS = ["date_", "city_name", "facility_id", "p_type", "item_id", "item_name", "sales_quantity",
               "outlier_flag", "event_flag", "seasonality_flag", "hfs_flag", "bulk_buying_flag", "surge_flag",
               "cannibalization_flag"]


def fused_report(report: DataFrame, calendar: DataFrame, store_searches: DataFrame, city_searches: DataFrame,
                 pen: DataFrame, require_event: bool = False, bulk_days: list[int] | None = HFS_DAYS) -> DataFrame:
    """T1, T3, T4, T6, T9, T11 in one plan with fewer passes over the report.

    Same rules as the single-flag functions above, but every per-store-key
    statistic (start-of-month means, outlier means, overall mean) comes from
    one aggregate and the store-day-type totals from another, so the large
    report frame is joined with 5-6 small statistic tables instead of a dozen.
    """
    q, hfs, out = _q(), _is_hfs_day(), F.col("outlier_flag")
    st = report.groupBy(*STORE).agg(
        F.avg(F.when(~hfs, q)).alias("_non_hfs"), F.avg(F.when(hfs, q)).alias("_hfs"),
        F.avg(F.when(out == 0, q)).alias("_non_out"), F.avg(F.when(out == 1, q)).alias("_out"),
        F.avg(q).alias("avg_3m_sales"))
    tday = report.groupBy(*STORE_TYPE_DAY).agg(F.sum("sales_quantity").alias("total_sales_ptype"))
    cpd = (tday.groupBy("city_name", "facility_id", "p_type")
               .agg(F.avg("total_sales_ptype").alias("_cpd")))
    tday = tday.join(cpd, ["city_name", "facility_id", "p_type"], "left")
    if require_event:
        days = calendar.select(F.col("event_date").alias("date_")).distinct().withColumn("_ev", F.lit(True))
        tday = tday.join(days, "date_", "left").withColumn(
            "_cpd", F.when(F.col("_ev"), F.col("_cpd"))).drop("_ev")
    r = (report.join(st, STORE, "left")
               .join(tday, STORE_TYPE_DAY, "left")
               .join(store_searches, ["facility_id", "item_id"], "left")
               .join(city_searches, ["city_name", "item_id"], "left")
               .join(pen.select("date_", "facility_id", F.col("surge_flag").alias("_sf")),
                     ["date_", "facility_id"], "left"))
    is_out = out == 1
    hfs_bump = F.when(F.col("_non_hfs").isNotNull() & F.col("_hfs").isNotNull(),
                      (F.col("_hfs") / F.col("_non_hfs")) * F.col("_non_hfs"))
    bulk_bump = F.when(F.col("_non_out").isNotNull(), (F.col("_out") / F.col("_non_out")) * F.col("_non_out"))
    day_ok = F.dayofmonth("date_").isin(*bulk_days) if bulk_days else F.lit(True)
    p = safe_div(q, F.col("total_sales_ptype").cast("double"))
    g = safe_div(q - F.col("avg_3m_sales"), q)
    r = (r.withColumn("event_flag", flag((q >= EVENT_LIFT * F.col("_cpd")) & is_out))
          .withColumn("seasonality_flag", flag(
              (F.col("store_searches") > 0.3 * q + 0.7 * F.col("store_searches"))
              & (F.col("city_searches") > 0.3 * q + 0.7 * F.col("city_searches")) & is_out))
          .withColumn("hfs_flag", flag(hfs & (q >= hfs_bump) & is_out))
          .withColumn("bulk_buying_flag", flag(day_ok & (q >= bulk_bump) & is_out))
          .withColumn("surge_flag", flag((F.col("_sf") == 1) & is_out))
          .withColumn("cannibalization_value", (p + p * g) - g))
    av = r.groupBy(*STORE_TYPE_DAY).agg(F.avg("cannibalization_value").alias("_avg_v"))
    r = r.join(av, STORE_TYPE_DAY, "left")
    return r.withColumn("cannibalization_flag",
                        flag((F.col("cannibalization_value") > F.col("_avg_v")) & is_out))
