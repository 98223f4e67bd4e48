"""End-to-end plans: range production, level flags and hierarchy.

Nothing is collected. A flow that reads a frame several times first writes it
to the shared folder (``materialize``), which runs a job while the plan is
built; the frames returned are lazy. The callers decide whether to write
(``salesguard.sources.sinks``) or to compare, and may ``session.release`` the
intermediate tables once they have.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesguard.functions.scalar import flag, r6
from salesguard.operators import sales as S
from salesguard.operators import segments as G
from salesguard.plans.materialize import materialize
from salesguard.sources.tables import Catalog

RANGE_KEYS = ["facility_id", "item_id"]
FLAG_KEYS = {"store": ["city_name", "facility_id", "item_id"], "city": ["city_name", "item_id"],
             "country": ["item_id"]}
FLAG_COL = {"store": "outlier_store_item", "city": "outlier_city_item", "country": "outlier_pan_item"}
PRODUCTION_COLS = ["date_", "city_name", "facility_id", "item_id", "item_name", "sales_quantity",
                   "sales_value", "sales_value_mrp", "ipc"]


def range_input(cat: Catalog, as_of: str | None, days: int | None, min_carts: int = 3,
                where=None) -> tuple[DataFrame, DataFrame]:
    """Store-level daily rows of the production script and its sparse keys, from one scan of the fact.

    ``where`` (a condition on city, facility or item) is applied to the lines, before
    they are written and summed; other lines stay only if they share a cart
    with one that is kept, for its total."""
    lines = S.sales_lines(cat, as_of, days).select(
        "order_date", "city_name", "facility_id", "item_id", "cart_id", "sales_quantity", "sales_value", "sales_value_mrp")
    if where is not None:
        lines = lines.join(lines.where(where).select("cart_id").distinct(), "cart_id", "left_semi")
    lines = materialize(lines)
    daily = S.daily_sales(cat, "store", lines=lines).select(*PRODUCTION_COLS).dropna("any")
    if where is not None:
        lines, daily = lines.where(where), daily.where(where)
    return daily, S.sparse_keys(lines, "store", min_carts)


def range_rows(daily: DataFrame, transform: str = "boxcox", impute: bool = False, midpoint: bool = False,
               updated_at: str | None = None) -> DataFrame:
    """The range table of daily rows."""
    seg = materialize(G.segment(daily, RANGE_KEYS, transform, impute))
    return G.range_table(seg, RANGE_KEYS, midpoint=midpoint, updated_at=updated_at)


def range_pipeline(cat: Catalog, as_of: str | None = None, days: int | None = 90, drop_sparse: bool = False,
                   transform: str = "boxcox", impute: bool = False, midpoint: bool = False,
                   updated_at: str | None = None, min_carts: int = 3,
                   exclude_cities=(), only: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Range table and error table of the production range script.

    ``drop_sparse=False`` reproduces the reference as it runs (its sparse filter
    is overwritten, SURVEY Q1): sparse keys still get a range and also an
    error row. ``True`` applies the filter the reference intended.
    The error table names the sparse keys either way. ``exclude_cities`` leaves
    cities out (P15), ``only`` keeps the rows with the given values of key
    columns (P17), e.g. ``{"facility_id": 3}``; both filter the lines.
    """
    kept = [~F.col("city_name").isin(*exclude_cities)] if exclude_cities else []
    kept += [F.col(key) == F.lit(value) for key, value in (only or {}).items()]
    where = reduce(lambda x, y: x & y, kept) if kept else None
    daily, sparse = range_input(cat, as_of, days, min_carts, where)
    daily = materialize(daily)
    sparse = sparse.select(*RANGE_KEYS)
    src = daily.join(sparse, RANGE_KEYS, "left_anti") if drop_sparse else daily
    seg = materialize(G.segment(src, RANGE_KEYS, transform, impute))
    ranges = G.range_table(seg, RANGE_KEYS, midpoint=midpoint, updated_at=updated_at)
    errors = G.range_errors(seg, RANGE_KEYS, sparse.join(daily.select(*RANGE_KEYS).distinct(), RANGE_KEYS, "left_semi"))
    return ranges, errors


def level_flags(cat: Catalog, level: str, as_of: str | None = None, days: int | None = 90,
                transform: str = "boxcox", impute: bool | None = None, daily: DataFrame | None = None,
                cut: bool = True, weekday: bool = True) -> DataFrame:
    """M10 per level: daily rows with transformed sales, cluster and 0/1 flag.

    Clusters are on (Sales, WeekDay), as in the level notebooks; ``weekday=False``
    takes Sales alone, as the range script does. The store notebook clusters
    raw sales (``transform="none"``); Box-Cox is the default at every level.
    Default imputation follows the reference: only the country level imputes
    medians before clustering (SURVEY Q20). ``cut=False`` writes no
    intermediate table, for a caller that consumes the result once.
    """
    impute = (level == "country") if impute is None else impute
    keys = FLAG_KEYS[level]
    daily = daily if daily is not None else materialize(S.daily_sales(cat, level, as_of, days))
    seg = materialize(G.segment(daily, keys, transform, impute, weekday=weekday), enabled=cut)
    flagged = G.cluster_flag(seg, FLAG_COL[level])
    return flagged.select("date_", *keys, "p_type", "item_name", "sales_quantity", "ipc", r6("Sales").alias("Sales"),
                          "cluster", FLAG_COL[level])


def hierarchical_outliers(store: DataFrame, city: DataFrame, country: DataFrame) -> DataFrame:
    """Store-level outlier that is not an outlier in its city nor in the country.

    Left joins on date and item (and city); a missing parent counts as "not 0",
    so the row is not flagged (NULL never equals 0).
    """
    c = city.select("date_", "city_name", "item_id", "item_name",
                    F.col("sales_quantity").alias("sales_quantity_city"), FLAG_COL["city"])
    p = country.select("date_", "item_id", "item_name",
                       F.col("sales_quantity").alias("sales_quantity_pan"), FLAG_COL["country"])
    j = (store.select("date_", "city_name", "facility_id", "item_id", "item_name", "sales_quantity",
                      FLAG_COL["store"])
              .join(c, ["date_", "city_name", "item_id", "item_name"], "left")
              .join(p, ["date_", "item_id", "item_name"], "left"))
    cond = ((F.col(FLAG_COL["store"]) == 1) & (F.col(FLAG_COL["city"]) == 0)
            & (F.col(FLAG_COL["country"]) == 0))
    return j.withColumn("outlier_flag", flag(cond))


def hierarchy(cat: Catalog, as_of: str | None = None, days: int | None = 90, cut: bool = False,
              store_transform: str = "boxcox") -> DataFrame:
    """M15 end to end: the three grains come from one grouping-sets pass.

    ``store_transform="none"`` flags stores on raw sales, as the store notebook is written.
    """
    levels = materialize(S.daily_sales_levels(cat, as_of, days))
    lv = {lvl: level_flags(cat, lvl, as_of, days, daily=S.level_rows(levels, lvl), cut=cut,
                           transform=store_transform if lvl == "store" else "boxcox")
          for lvl in ("store", "city", "country")}
    return hierarchical_outliers(lv["store"], lv["city"], lv["country"])


# ------------------------------------------------------------ attribution
def report_base(cat: Catalog, as_of: str | None = None, days: int | None = 90,
                store_transform: str = "boxcox") -> DataFrame:
    """Hierarchy rows with the item's product type (input of every T rule)."""
    from salesguard.operators.attribution import with_p_type
    h = hierarchy(cat, as_of, days, cut=False, store_transform=store_transform)
    return materialize(with_p_type(h.select("date_", "city_name", "facility_id", "item_id", "item_name",
                                            "sales_quantity", "outlier_flag"), cat))


def search_levels(cat: Catalog, min_total: int = 100, min_pair: int = 10, share_cat: float = 0.1,
                  share_kw: float = 10, start: str | None = None, end: str | None = None, excluded_users=()):
    from salesguard.operators import search as SR
    atc = SR.keyword_atc(cat, start, end, excluded_users)
    kwmap = SR.keyword_category_map(atc, min_total, min_pair, share_cat, share_kw)
    cs = SR.category_searches(cat, SR.searches(cat, start, end, excluded_users), kwmap)
    return SR.avg_searches(cat, materialize(cs))


def attribution_report(cat: Catalog, as_of: str | None = None, days: int | None = 90,
                       surge_days: int | None = 7, kw: dict | None = None,
                       require_event: bool = False, store_transform: str = "boxcox") -> DataFrame:
    """The final report, one row per store-day-item with the six cause flags."""
    from salesguard.operators import attribution as A
    rep = report_base(cat, as_of, days, store_transform)
    st, ct = search_levels(cat, **(kw or {}))
    pen = A.surge_penetration(cat, as_of, surge_days)
    return A.fused_report(rep, cat.calendar, st, ct, pen, require_event).select(*A.REPORT_COLS)
