"""Query registry: name -> Spark plan builder and name -> oracle SQL.

Every entry reads the given tables (or data Spark derives from them) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesguard.operators import sales as S
from salesguard.plans import oracle as O
from salesguard.plans import params as P
from salesguard.plans.materialize import materialize
from salesguard.sources.tables import Catalog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _cat(spark, sf_dir) -> Catalog:
    return Catalog(spark, sf_dir)


# ---------------------------------------------------------------- sales
@register("item_mapping", O.with_ctes(O.base_ctes(), "SELECT * FROM item_mapping"))
def q_item_mapping(spark, sf_dir):
    return S.item_mapping(_cat(spark, sf_dir))


for _lvl in ("store", "city", "country"):
    def _mk(lvl):
        def q(spark, sf_dir):
            return S.daily_sales(_cat(spark, sf_dir), lvl, P.AS_OF, P.DAYS)
        return q
    register(f"daily_sales_{_lvl}", O.with_ctes(O.base_ctes(), f"SELECT * FROM daily_{_lvl}"))(_mk(_lvl))


@register("sparse_keys", O.with_ctes(
    {**O.base_ctes(), "sparse": O.sparse_cte("facility_id", P.SPARSE_MIN_CARTS)}, "SELECT *, 1 AS remove_flag FROM sparse"))
def q_sparse_keys(spark, sf_dir):
    return S.sparse_keys(S.sales_lines(_cat(spark, sf_dir), P.AS_OF, P.DAYS), "store", P.SPARSE_MIN_CARTS)


@register("sparse_keys_city", O.with_ctes(
    {**O.base_ctes(), "sparse": O.sparse_cte("city_name", P.SPARSE_MIN_CARTS)}, "SELECT *, 1 AS remove_flag FROM sparse"))
def q_sparse_keys_city(spark, sf_dir):
    return S.sparse_keys(S.sales_lines(_cat(spark, sf_dir), P.AS_OF, P.DAYS), "city", P.SPARSE_MIN_CARTS)


@register("cart_share", O.with_ctes(O.base_ctes(), """
SELECT cart_id, item_id, SUM(sales_quantity)::BIGINT AS item_quantity, any_value(cart_quantity)::BIGINT AS order_quantity,
       round(AVG(share), 6) AS ipc FROM shares GROUP BY cart_id, item_id"""))
def q_cart_share(spark, sf_dir):
    return S.cart_share(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


# ---------------------------------------------------------------- ranges
from salesguard.operators import boxcox as B  # noqa: E402
from salesguard.plans import flows as PL  # noqa: E402

UPDATED_AT = "2001-08-01 05:30:00"   # as_of + 5.5 h, fixed so results are comparable


@register("boxcox_lambda", O.with_ctes({**O.base_ctes(), **O.boxcox_ctes("bx", "daily_country", ["item_id"])},
                                       "SELECT item_id, round(lam, 6) + 0.0 AS lam, round(llf, 6) AS llf FROM bx_lam"))
def q_boxcox_lambda(spark, sf_dir):
    d = S.daily_sales(_cat(spark, sf_dir), "country", P.AS_OF, P.DAYS)
    return B.boxcox_lambda(d, ["item_id"]).select("item_id", F.round("lam", 6).alias("lam"), F.round("llf", 6).alias("llf"))


@register("boxcox_lambda_store", O.with_ctes(
    {**O.base_ctes(), **O.boxcox_ctes("bx", "daily_store", ["city_name", "facility_id", "item_id"])},
    "SELECT city_name, facility_id, item_id, round(lam, 6) + 0.0 AS lam, round(llf, 6) AS llf FROM bx_lam"))
def q_boxcox_lambda_store(spark, sf_dir):
    d = S.daily_sales(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS)
    return B.boxcox_lambda(d, ["city_name", "facility_id", "item_id"]).select(
        "city_name", "facility_id", "item_id", F.round("lam", 6).alias("lam"), F.round("llf", 6).alias("llf"))


@register("boxcox_frame", O.with_ctes(
    {**O.base_ctes(), "bf_src": "SELECT 1 AS one, sales_quantity FROM daily_city", **O.boxcox_ctes("bf", "bf_src", ["one"])},
    "SELECT round(lam, 6) + 0.0 AS lam, round(llf, 4) AS llf FROM bf_lam"))
def q_boxcox_frame(spark, sf_dir):
    """One lambda for a whole level, as the level notebooks transform it."""
    d = S.daily_sales(_cat(spark, sf_dir), "city", P.AS_OF, P.DAYS)
    return B.boxcox_lambda(d, []).select(F.round("lam", 6).alias("lam"), F.round("llf", 4).alias("llf"))


_RANGE_SELECT = """
SELECT CAST(facility_id AS INTEGER) AS facility_id, CAST(item_id AS INTEGER) AS item_id,
       round_even(AVG(CASE WHEN cluster = 1 THEN CAST(sales_quantity AS DOUBLE) END), 2) AS "min",
       round_even(AVG(CASE WHEN cluster = 3 THEN CAST(sales_quantity AS DOUBLE) END), 2) AS "max",
       TIMESTAMP '{ts}' AS updated_at
FROM rg_seg WHERE cluster IS NOT NULL GROUP BY ALL""".format(ts=UPDATED_AT)


@register("range_table", O.with_ctes(O.range_ctes(False), _RANGE_SELECT))
def q_range_table(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, updated_at=UPDATED_AT)[0]


@register("range_table_intended", O.with_ctes(O.range_ctes(True), _RANGE_SELECT))
def q_range_table_intended(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, drop_sparse=True, updated_at=UPDATED_AT)[0]


_ERRORS = """
SELECT CAST(facility_id AS INTEGER) AS facility_id, CAST(item_id AS INTEGER) AS item_id,
       CAST(1.0 AS DOUBLE) AS "min", CAST(1.0 AS DOUBLE) AS "max", 'Less Than 2 carts per month' AS error_reason
FROM sparse_store WHERE (facility_id, item_id) IN (SELECT (facility_id, item_id) FROM prod_daily)
UNION ALL
SELECT CAST(facility_id AS INTEGER), CAST(item_id AS INTEGER), low, high, unnest(list_filter(
         [CASE WHEN NOT fits THEN 'Breaking at Boxcox Transformation' END, CASE WHEN groups = 0 THEN 'Breaking at K Means ' END],
         lambda x: x IS NOT NULL))
FROM (SELECT facility_id, item_id, bool_or(bc_ok) AS fits, COUNT(cluster) AS groups,
             round_even(MIN(sales_quantity)::DOUBLE, 2) AS low, round_even(MAX(sales_quantity)::DOUBLE, 2) AS high
      FROM rg_seg GROUP BY facility_id, item_id)"""


@register("range_errors", O.with_ctes(O.range_ctes(False), _ERRORS))
def q_range_errors(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, updated_at=UPDATED_AT)[1]


@register("range_errors_intended", O.with_ctes(O.range_ctes(True), _ERRORS))
def q_range_errors_intended(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, drop_sparse=True, updated_at=UPDATED_AT)[1]


@register("range_table_some", O.with_ctes(
    {n: q if n != "prod_daily" else q + " AND city_name <> 'ASIA' AND item_id = 23" for n, q in O.range_ctes(False).items()}, _RANGE_SELECT))
def q_range_table_some(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, updated_at=UPDATED_AT, exclude_cities=["ASIA"],
                             only={"item_id": 23})[0]


for _lvl in ("store", "city", "country"):
    def _mkf(lvl):
        def q(spark, sf_dir):
            return PL.level_flags(_cat(spark, sf_dir), lvl, P.AS_OF, P.DAYS)
        return q
    register(f"{_lvl}_flags", O.with_ctes({**O.base_ctes(), **O.flag_ctes(_lvl)},
                                          f"SELECT * FROM flags_{_lvl}"))(_mkf(_lvl))


@register("store_flags_raw", O.with_ctes({**O.base_ctes(), **O.flag_ctes("store", "none")}, "SELECT * FROM flags_store"))
def q_store_flags_raw(spark, sf_dir):
    """The store notebook's form: (raw sales, WeekDay)."""
    return PL.level_flags(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS, transform="none")


@register("city_flags_sales_only", O.with_ctes({**O.base_ctes(), **O.flag_ctes("city", weekday=False)}, "SELECT * FROM flags_city"))
def q_city_flags_sales_only(spark, sf_dir):
    """The option without WeekDay."""
    return PL.level_flags(_cat(spark, sf_dir), "city", P.AS_OF, P.DAYS, weekday=False)


@register("hierarchical_outliers_raw", O.with_ctes(O.hierarchy_ctes("none"), "SELECT * FROM hier"))
def q_hierarchical_outliers_raw(spark, sf_dir):
    """The hierarchy on the store notebook's form."""
    return PL.hierarchy(_cat(spark, sf_dir), P.AS_OF, P.DAYS, store_transform="none")


def hierarchy(spark, sf_dir):
    return PL.hierarchy(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


register("hierarchical_outliers", O.with_ctes(O.hierarchy_ctes(), "SELECT * FROM hier"))(hierarchy)


# ---------------------------------------------------------------- attribution
from salesguard.functions.scalar import r6  # noqa: E402
from salesguard.operators import attribution as A  # noqa: E402
from salesguard.operators import search as SR  # noqa: E402

REP = ["date_", "city_name", "facility_id", "p_type", "item_id", "item_name", "sales_quantity", "outlier_flag"]
REP_SQL = ", ".join(REP)
KW = dict(excluded_users=P.EXCLUDED_USERS, min_total=P.KW_MIN_TOTAL, min_pair=P.KW_MIN_PAIR, share_cat=P.KW_MIN_SHARE_OF_CATEGORY,
          share_kw=P.KW_MIN_SHARE_OF_KEYWORD)


def _att(body: str, require_event: bool = False) -> str:
    return O.with_ctes(O.attribution_ctes(require_event), body)


def _rep(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return cat, PL.report_base(cat, P.AS_OF, P.DAYS)


@register("event_flag", _att(f"SELECT {REP_SQL}, event_flag FROM r_ev"))
def q_event_flag(spark, sf_dir):
    cat, rep = _rep(spark, sf_dir)
    return A.event_flag(rep, cat.calendar).select(*REP, "event_flag")


@register("event_flag_strict", _att(f"SELECT {REP_SQL}, event_flag FROM r_ev", require_event=True))
def q_event_flag_strict(spark, sf_dir):
    cat, rep = _rep(spark, sf_dir)
    return A.event_flag(rep, cat.calendar, require_event=True).select(*REP, "event_flag")


@register("keyword_atc", _att("SELECT * FROM kw_atc"))
def q_keyword_atc(spark, sf_dir):
    return SR.keyword_atc(_cat(spark, sf_dir), excluded_users=P.EXCLUDED_USERS)


@register("searches", _att("SELECT * FROM srch"))
def q_searches(spark, sf_dir):
    return SR.searches(_cat(spark, sf_dir), excluded_users=P.EXCLUDED_USERS)


@register("keyword_category_map", _att(f"""
SELECT l2_category_id, keyword, CAST(keyword_atc AS BIGINT) AS keyword_atc, CAST(category_atc AS BIGINT) AS category_atc,
       CAST(pair_atc AS BIGINT) AS pair_atc, round(keyword_pct, 6) AS keyword_pct, round(category_pct, 6) AS category_pct
FROM kw_stat WHERE category_pct >= {P.KW_MIN_SHARE_OF_CATEGORY} AND keyword_pct >= {P.KW_MIN_SHARE_OF_KEYWORD}"""))
def q_keyword_category_map(spark, sf_dir):
    atc = SR.keyword_atc(_cat(spark, sf_dir), excluded_users=P.EXCLUDED_USERS)
    return SR.keyword_category_map(atc, P.KW_MIN_TOTAL, P.KW_MIN_PAIR, P.KW_MIN_SHARE_OF_CATEGORY,
                                   P.KW_MIN_SHARE_OF_KEYWORD, with_stats=True)


@register("keyword_top_k", _att("""
SELECT l2_category_id, keyword, CAST(pair_atc AS BIGINT) AS pair_atc, keyword_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY l2_category_id ORDER BY pair_atc DESC, keyword) AS INTEGER)
         AS keyword_rank
  FROM kw_stat) WHERE keyword_rank <= 3"""))
def q_keyword_top_k(spark, sf_dir):
    atc = SR.keyword_atc(_cat(spark, sf_dir), excluded_users=P.EXCLUDED_USERS)
    return SR.top_keywords(atc, 3, P.KW_MIN_TOTAL, P.KW_MIN_PAIR)


def _cat_searches(cat):
    atc = SR.keyword_atc(cat, excluded_users=P.EXCLUDED_USERS)
    kwmap = SR.keyword_category_map(atc, P.KW_MIN_TOTAL, P.KW_MIN_PAIR, P.KW_MIN_SHARE_OF_CATEGORY,
                                    P.KW_MIN_SHARE_OF_KEYWORD)
    return SR.category_searches(cat, SR.searches(cat, excluded_users=P.EXCLUDED_USERS), kwmap)


@register("category_searches", _att("SELECT * FROM cat_srch"))
def q_category_searches(spark, sf_dir):
    return _cat_searches(_cat(spark, sf_dir))


@register("avg_searches_store", _att(
    "SELECT facility_id, item_id, round(store_searches, 6) AS store_searches FROM store_srch"))
def q_avg_searches_store(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    st, _ = SR.avg_searches(cat, _cat_searches(cat))
    return st.select("facility_id", "item_id", r6("store_searches").alias("store_searches"))


@register("avg_searches_city", _att(
    "SELECT city_name, item_id, round(city_searches, 6) AS city_searches FROM city_srch"))
def q_avg_searches_city(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    _, ct = SR.avg_searches(cat, _cat_searches(cat))
    return ct.select("city_name", "item_id", r6("city_searches").alias("city_searches"))


@register("search_seasonality", _att(f"""
SELECT {REP_SQL}, round(store_searches, 6) AS store_searches, round(city_searches, 6) AS city_searches,
       store_seasonality_flag, city_seasonality_flag, seasonality_flag FROM r_seas2"""))
def q_search_seasonality(spark, sf_dir):
    cat, rep = _rep(spark, sf_dir)
    st, ct = PL.search_levels(cat, **KW)
    return (A.seasonality_flag(rep, st, ct)
            .select(*REP, r6("store_searches").alias("store_searches"), r6("city_searches").alias("city_searches"),
                    "store_seasonality_flag", "city_seasonality_flag", "seasonality_flag"))


@register("hfs_flag", _att(f"SELECT {REP_SQL}, round(hfs_bump_value, 6) AS hfs_bump_value, hfs_flag FROM r_hfs"))
def q_hfs_flag(spark, sf_dir):
    _, rep = _rep(spark, sf_dir)
    return A.hfs_flag(rep).select(*REP, r6("hfs_bump_value").alias("hfs_bump_value"), "hfs_flag")


@register("bulk_flag", _att(f"""
SELECT {REP_SQL}, round(outlier_bump_value, 6) AS outlier_bump_value,
       round(outlier_bump_value_new, 6) AS outlier_bump_value_new, bulk_buying_flag, bulk_buying_flag_new
FROM r_bulk"""))
def q_bulk_flag(spark, sf_dir):
    _, rep = _rep(spark, sf_dir)
    return A.bulk_flag(rep).select(*REP, r6("outlier_bump_value").alias("outlier_bump_value"),
                                   r6("outlier_bump_value_new").alias("outlier_bump_value_new"),
                                   "bulk_buying_flag", "bulk_buying_flag_new")


@register("surge_penetration", _att("SELECT * FROM surge_f"))
def q_surge_penetration(spark, sf_dir):
    return A.surge_penetration(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


@register("surge_days", _att("SELECT * FROM surge_d"))
def q_surge_days(spark, sf_dir):
    return A.surge_days(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


@register("surge_flag", _att(f"SELECT {REP_SQL}, surge_flag FROM r_surge"))
def q_surge_flag(spark, sf_dir):
    cat, rep = _rep(spark, sf_dir)
    return A.surge_flag(rep, A.surge_penetration(cat, P.AS_OF, P.DAYS)).select(*REP, "surge_flag")


@register("cannibalization", _att(f"""
SELECT {REP_SQL}, round(cannibalization_value, 6) AS cannibalization_value,
       round(average_cannibalization_value, 6) AS average_cannibalization_value, cannibalization_flag
FROM r_final"""))
def q_cannibalization(spark, sf_dir):
    _, rep = _rep(spark, sf_dir)
    return A.cannibalization_flag(rep).select(
        *REP, r6("cannibalization_value").alias("cannibalization_value"),
        r6("average_cannibalization_value").alias("average_cannibalization_value"), "cannibalization_flag")


@register("attribution_report", _att("""
SELECT date_, city_name, facility_id, p_type, item_id, item_name, sales_quantity, outlier_flag, event_flag,
       seasonality_flag, hfs_flag, bulk_buying_flag, surge_flag, cannibalization_flag FROM r_final"""))
def q_attribution_report(spark, sf_dir):
    return PL.attribution_report(_cat(spark, sf_dir), P.AS_OF, P.DAYS, surge_days=P.DAYS, kw=KW)


# store-notebook variants on the store-level clusters
def _store_seg(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return cat, PL.level_flags(cat, "store", P.AS_OF, P.DAYS)


SEG = ["date_", "city_name", "facility_id", "item_id", "sales_quantity", "cluster"]
SEG_SQL = ", ".join(SEG)


@register("hfs_flag_top_cluster", _att(f"""
SELECT s.date_, s.city_name, s.facility_id, s.item_id, s.sales_quantity, s.cluster,
       round((m.hfs / m.non) * m.non, 6) AS hfs_bump_value,
       CASE WHEN day(s.date_) IN {O.HFS} AND CAST(s.sales_quantity AS DOUBLE) >= (m.hfs / m.non) * m.non
                 AND s.cluster = 3 THEN 1 ELSE 0 END AS hfs_flag
FROM flags_store s LEFT JOIN (
  SELECT city_name, facility_id, item_id,
         AVG(CASE WHEN day(date_) NOT IN {O.HFS} THEN CAST(sales_quantity AS DOUBLE) END) AS non,
         AVG(CASE WHEN day(date_) IN {O.HFS} THEN CAST(sales_quantity AS DOUBLE) END) AS hfs
  FROM flags_store GROUP BY ALL) m
ON m.city_name = s.city_name AND m.facility_id = s.facility_id AND m.item_id = s.item_id"""))
def q_hfs_flag_top_cluster(spark, sf_dir):
    _, seg = _store_seg(spark, sf_dir)
    return A.hfs_flag_top_cluster(seg).select(*SEG, r6("hfs_bump_value").alias("hfs_bump_value"), "hfs_flag")


@register("bulk_flag_ipc", _att("""
SELECT s.date_, s.city_name, s.facility_id, s.item_id, s.sales_quantity, s.cluster, s.ipc,
       round((m.top_q / NULLIF(m.mid_q, 0)) * m.mid_ipc, 6) AS bulk_buying_value,
       CASE WHEN s.ipc >= (m.top_q / NULLIF(m.mid_q, 0)) * m.mid_ipc AND s.cluster = 3 THEN 1 ELSE 0 END AS bulk_flag
FROM flags_store s LEFT JOIN (
  SELECT city_name, facility_id, item_id,
         AVG(CASE WHEN cluster = 2 THEN CAST(sales_quantity AS DOUBLE) END) AS mid_q,
         AVG(CASE WHEN cluster = 3 THEN CAST(sales_quantity AS DOUBLE) END) AS top_q,
         AVG(CASE WHEN cluster = 2 THEN ipc END) AS mid_ipc
  FROM flags_store GROUP BY ALL) m
ON m.city_name = s.city_name AND m.facility_id = s.facility_id AND m.item_id = s.item_id"""))
def q_bulk_flag_ipc(spark, sf_dir):
    _, seg = _store_seg(spark, sf_dir)
    return A.bulk_flag_ipc(seg).select(*SEG, "ipc", r6("bulk_buying_value").alias("bulk_buying_value"), "bulk_flag")


@register("surge_flag_days", _att(f"""
SELECT {', '.join('s.' + c for c in SEG)},
       CASE WHEN s.cluster IN (1, 3) AND d.facility_id IS NOT NULL THEN 1 ELSE 0 END AS surge_flag
FROM flags_store s LEFT JOIN surge_d d ON d.date_ = s.date_ AND d.facility_id = s.facility_id"""))
def q_surge_flag_days(spark, sf_dir):
    cat, seg = _store_seg(spark, sf_dir)
    return A.surge_flag_days(seg, A.surge_days(cat, P.AS_OF, P.DAYS)).select(*SEG, "surge_flag")


@register("ptype_store_day", _att("""
SELECT date_, city_name, facility_id, p_type, round(AVG(CAST(sales_quantity AS DOUBLE)), 6) AS ptype_mean_quantity,
       round(AVG(ipc), 6) AS ptype_mean_ipc, CAST(COUNT(*) AS BIGINT) AS items
FROM flags_store GROUP BY ALL"""))
def q_ptype_store_day(spark, sf_dir):
    _, seg = _store_seg(spark, sf_dir)
    return A.ptype_store_day(seg)


# ---------------------------------------------------------------- seasonality
from salesguard.operators import demand as D  # noqa: E402
from salesguard.operators import seasonality as SE  # noqa: E402


def _seas(body: str) -> str:
    return O.with_ctes(O.season_ctes(), body)


@register("net_invoice_sales", O.with_ctes({**O.base_ctes(), **{
    "signed": f"""
SELECT cart_id, outlet_id, item_id, CAST(checkout_ts AS DATE) AS date_, return_flag IS DISTINCT FROM 'R' AS sold,
       procured AS q, procured * unit_price AS v, procured * unit_mrp AS m
FROM item_mapping JOIN fact_items f USING (product_id)
WHERE order_status = 'DELIVERED' AND NOT contains(lower(order_type), 'internal') AND {O.window_sql('f.checkout_ts', P.AS_OF, P.DAYS)}""",
    "netted": """
SELECT date_, outlet_id, item_id, sold_q, sold_v, sold_m, SUM(back_q) OVER w AS back_q, SUM(back_v) OVER w AS back_v, SUM(back_m) OVER w AS back_m
FROM (SELECT date_, cart_id, outlet_id, item_id,
        SUM(q) FILTER (sold) AS sold_q, SUM(v) FILTER (sold) AS sold_v, SUM(m) FILTER (sold) AS sold_m,
        SUM(q) FILTER (NOT sold) AS back_q, SUM(v) FILTER (NOT sold) AS back_v, SUM(m) FILTER (NOT sold) AS back_m
      FROM signed GROUP BY date_, cart_id, outlet_id, item_id)
WINDOW w AS (PARTITION BY cart_id, item_id)"""}}, """
SELECT date_, city_name, outlet_id, item_id, item_name, l2 AS category, SUM(sold_q - COALESCE(back_q, 0))::BIGINT AS sales_quantity,
       round_even(SUM(sold_v - COALESCE(back_v, 0)), 2) AS sales_value, round_even(SUM(sold_m - COALESCE(back_m, 0)), 2) AS sales_mrp
FROM netted JOIN store_outlets USING (outlet_id) JOIN item_names USING (item_id) JOIN item_categories USING (item_id)
WHERE sold_q IS NOT NULL GROUP BY ALL"""))
def q_net_invoice_sales(spark, sf_dir):
    return D.net_invoice_sales(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


@register("category_demand", _seas("SELECT * FROM cat_dem"))
def q_category_demand(spark, sf_dir):
    return D.category_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


@register("product_demand", _seas("SELECT * FROM prod_dem"))
def q_product_demand(spark, sf_dir):
    return D.product_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)


def _factors(cat):
    cd = D.category_demand(cat, P.AS_OF, P.DAYS)
    weekly = SE.seasonal_index(cd, ["l2_category"], "date", "qty", 7, "dow", "weekly_seasonal")
    monthly = SE.seasonal_index(cd, ["l2_category"], "date", "qty", 30, "dom", "monthly_seasonal")
    return weekly, monthly


@register("seasonal_decompose_weekly", _seas(
    "SELECT date, l2_category, qty, round(trend, 6) AS trend, phase, seasonal FROM dw_d"))
def q_seasonal_decompose_weekly(spark, sf_dir):
    cd = D.category_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)
    d = SE.seasonal_decompose(cd, ["l2_category"], "date", "qty", 7)
    return d.select("date", "l2_category", "qty", SE.r6_col("trend"), "phase", "seasonal")


@register("seasonal_decompose_whole", O.with_ctes({
    **O.season_ctes(), "whole_q": "SELECT date, SUM(qty) AS qty FROM cat_dem GROUP BY date",
    "whole_t": "SELECT date, qty, CAST((row_number() OVER (ORDER BY date) - 1) % 7 AS INTEGER) AS phase, "
               "CASE WHEN COUNT(qty) OVER w = 7 THEN AVG(qty) OVER w END AS trend FROM whole_q "
               "WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)",
    "whole_p": "SELECT phase, AVG(qty - trend) AS m FROM whole_t GROUP BY phase"}, """
SELECT date, qty, round(trend, 6) AS trend, phase, round(m - (SELECT AVG(m) FROM whole_p), 6) + 0.0 AS seasonal
FROM whole_t JOIN whole_p USING (phase)"""))
def q_seasonal_decompose_whole(spark, sf_dir):
    """All categories' demand as one series, as the notebook decomposes its frame."""
    cd = D.category_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)
    d = SE.seasonal_decompose(cd.groupBy("date").agg(F.sum("qty").alias("qty")), [], "date", "qty", 7)
    return d.select("date", "qty", SE.r6_col("trend"), "phase", SE.r6_col("seasonal"))


@register("sparse_keys_sketched", O.with_ctes(
    {**O.base_ctes(), "sparse": O.sparse_cte("city_name", P.SPARSE_MIN_CARTS)}, "SELECT *, 1 AS remove_flag FROM sparse"))
def q_sparse_keys_sketched(spark, sf_dir):
    """From day sketches, which are exact for counts as small as these."""
    return S.sparse_keys(S.sales_lines(_cat(spark, sf_dir), P.AS_OF, P.DAYS), "city", P.SPARSE_MIN_CARTS, approximate=True)


@register("seasonal_weekly", _seas("SELECT * FROM sw"))
def q_seasonal_weekly(spark, sf_dir):
    return _factors(_cat(spark, sf_dir))[0]


@register("seasonal_monthly", _seas("SELECT * FROM sm"))
def q_seasonal_monthly(spark, sf_dir):
    return _factors(_cat(spark, sf_dir))[1]


def _deseasonalised(spark, sf_dir, mode="divide"):
    cat = _cat(spark, sf_dir)
    weekly, monthly = _factors(cat)
    pdm = D.product_demand(cat, P.AS_OF, P.DAYS)
    return SE.deseasonalise(pdm, monthly, weekly, mode=mode)


DES_COLS = "date, wom, dom, dow, l2_category, product_id, qty"


@register("deseasonalised", _seas(f"SELECT {DES_COLS}, round(adjusted, 6) AS adjusted FROM des"))
def q_deseasonalised(spark, sf_dir):
    d = _deseasonalised(spark, sf_dir)
    return d.select(*DES_COLS.split(", "), SE.r6_col("adjusted"))


@register("rolling_spikes", _seas(f"""
SELECT {DES_COLS}, round(adjusted, 6) AS adjusted, round(rolling_median, 6) AS rolling_median,
       round(rolling_75, 6) AS rolling_75, round(rolling_25, 6) AS rolling_25, round(IQR, 6) AS IQR,
       CASE WHEN adjusted > (1.5 * IQR) + rolling_75 OR adjusted < rolling_25 - (1.5 * IQR) THEN 1 ELSE 0 END AS spike
FROM rq2"""))
def q_rolling_spikes(spark, sf_dir):
    d = SE.rolling_iqr_spike(_deseasonalised(spark, sf_dir), ["product_id"], "date")
    return d.select(*DES_COLS.split(", "), *[SE.r6_col(c) for c in
                    ("adjusted", "rolling_median", "rolling_75", "rolling_25", "IQR")], "spike")


@register("robust_z", _seas(f"""
SELECT {DES_COLS}, round(adjusted, 6) AS adjusted,
       round((adjusted - rolling_median) / NULLIF(IQR, 0), 6) AS zscore,
       CASE WHEN (adjusted - rolling_median) / NULLIF(IQR, 0) >= 3 THEN 1 ELSE 0 END AS spike
FROM rq2"""))
def q_robust_z(spark, sf_dir):
    d = SE.robust_z(_deseasonalised(spark, sf_dir), ["product_id"], "date")
    return d.select(*DES_COLS.split(", "), SE.r6_col("adjusted"), SE.r6_col("zscore"), "spike")


@register("mean_ratio", _seas(f"""
SELECT {DES_COLS}, round(adjusted, 6) AS adjusted, round(rolling_mean, 6) AS rolling_mean,
       round(adjusted / NULLIF(rolling_mean, 0), 6) AS ratio,
       CASE WHEN adjusted / NULLIF(rolling_mean, 0) IS NOT NULL
                 AND (abs(adjusted / NULLIF(rolling_mean, 0)) < 0.85
                      OR abs(adjusted / NULLIF(rolling_mean, 0)) > 1.15) THEN 1 ELSE 0 END AS spike
FROM rq2"""))
def q_mean_ratio(spark, sf_dir):
    d = SE.mean_ratio(_deseasonalised(spark, sf_dir), ["product_id"], "date")
    return d.select(*DES_COLS.split(", "), SE.r6_col("adjusted"), SE.r6_col("rolling_mean"), SE.r6_col("ratio"),
                    "spike")


@register("zscore", O.with_ctes(O.base_ctes(), """
SELECT date_, city_name, facility_id, item_id, sales_quantity,
       round((sales_quantity - AVG(sales_quantity) OVER w) / NULLIF(STDDEV_POP(sales_quantity) OVER w, 0), 6) AS zscore,
       CASE WHEN abs((sales_quantity - AVG(sales_quantity) OVER w) / NULLIF(STDDEV_POP(sales_quantity) OVER w, 0)) >= 3
            THEN 1 ELSE 0 END AS z_flag
FROM daily_store WINDOW w AS (PARTITION BY city_name, facility_id, item_id)"""))
def q_zscore(spark, sf_dir):
    d = S.daily_sales(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS)
    z = SE.zscore(d, ["city_name", "facility_id", "item_id"], "sales_quantity")
    return z.select("date_", "city_name", "facility_id", "item_id", "sales_quantity", SE.r6_col("zscore"), "z_flag")


# ---------------------------------------------------------------- stats and small detectors
from salesguard.operators import stats as ST  # noqa: E402
from salesguard.sources import sinks as SK  # noqa: E402

UPDATED_AT_NEW = "2001-08-02 05:30:00"
_Q = "CAST(sales_quantity AS DOUBLE)"


def _country(spark, sf_dir):
    return S.daily_sales(_cat(spark, sf_dir), "country", P.AS_OF, P.DAYS)


@register("profile_stats", O.with_ctes(O.base_ctes(), f"""
SELECT item_id, COUNT({_Q}) AS n, CAST(SUM(CASE WHEN sales_quantity IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls,
       MIN({_Q}) AS "min", MAX({_Q}) AS "max", round(AVG({_Q}), 6) AS mean, round(STDDEV_SAMP({_Q}), 6) AS std,
       round(CASE WHEN VAR_POP({_Q}) > 0 THEN skewness({_Q}) END, 6) AS skew,
       round(CASE WHEN VAR_POP({_Q}) > 0 THEN kurtosis({_Q}) END, 6) AS kurt,
       round(quantile_cont({_Q}, 0.25), 6) AS q25, round(quantile_cont({_Q}, 0.5), 6) AS median,
       round(quantile_cont({_Q}, 0.75), 6) AS q75,
       round(quantile_cont({_Q}, 0.75) - quantile_cont({_Q}, 0.25), 6) AS iqr
FROM daily_country GROUP BY item_id"""))
def q_profile_stats(spark, sf_dir):
    return ST.profile_stats(_country(spark, sf_dir), ["item_id"], "sales_quantity")


_DS_COLS = ["date_", "city_name", "facility_id", "p_type", "item_id", "item_name", "sales_quantity", "sales_value",
            "sales_value_mrp", "ipc"]


@register("null_counts", O.with_ctes(O.base_ctes(), "SELECT " + ", ".join(
    f"CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}" for c in _DS_COLS) + " FROM daily_store"))
def q_null_counts(spark, sf_dir):
    return ST.null_counts(S.daily_sales(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS).select(*_DS_COLS))


@register("cluster_counts", O.with_ctes({**O.base_ctes(), **O.flag_ctes("country")},
                                        "SELECT cluster, COUNT(*) AS count FROM flags_country GROUP BY cluster"))
def q_cluster_counts(spark, sf_dir):
    return ST.value_counts(PL.level_flags(_cat(spark, sf_dir), "country", P.AS_OF, P.DAYS), "cluster")


@register("median_impute", O.with_ctes(O.base_ctes(), f"""
SELECT d.date_, d.item_id, d.sales_quantity,
       CASE WHEN {_Q} > q.qq[3] + 1.5 * (q.qq[3] - q.qq[1]) OR {_Q} < q.qq[1] - 1.5 * (q.qq[3] - q.qq[1])
            THEN round(q.qq[2], 6) ELSE {_Q} END AS sales_imputed
FROM daily_country d LEFT JOIN (
  SELECT item_id, quantile_cont({_Q}, [0.25, 0.5, 0.75]) AS qq FROM daily_country GROUP BY item_id) q
ON q.item_id = d.item_id"""))
def q_median_impute(spark, sf_dir):
    d = _country(spark, sf_dir).withColumn("_x", F.col("sales_quantity").cast("double"))
    from salesguard.operators.segments import median_impute
    m = median_impute(d, ["item_id"], "_x", out="sales_imputed")
    return m.select("date_", "item_id", "sales_quantity", r6("sales_imputed").alias("sales_imputed"))


@register("standardise", O.with_ctes(O.base_ctes(), f"""
SELECT date_, item_id, sales_quantity, ipc,
       round(({_Q} - AVG({_Q}) OVER w) / NULLIF(STDDEV_POP({_Q}) OVER w, 0), 6) AS sales_quantity_std,
       round((ipc - AVG(ipc) OVER w) / NULLIF(STDDEV_POP(ipc) OVER w, 0), 6) AS ipc_std
FROM daily_country WINDOW w AS (PARTITION BY item_id)"""))
def q_standardise(spark, sf_dir):
    d = _country(spark, sf_dir).withColumn("sales_q", F.col("sales_quantity").cast("double"))
    z = ST.standardise(d, ["item_id"], ["sales_q", "ipc"])
    return z.select("date_", "item_id", "sales_quantity", "ipc", r6("sales_q_std").alias("sales_quantity_std"),
                    r6("ipc_std").alias("ipc_std"))


DB_EPS, DB_MIN = 2, 3


def _dbscan_sql(src: str, key: str, x: str) -> dict[str, str]:
    o = f"PARTITION BY {key} ORDER BY {x}"
    cx = f"CASE WHEN core THEN {x} END"
    return {
        "dbh": f"SELECT {key}, {x}, COUNT(*) AS w FROM {src} GROUP BY ALL",
        "db0": f"SELECT *, SUM(w) OVER ({o} RANGE BETWEEN {DB_EPS} PRECEDING AND {DB_EPS} FOLLOWING) >= {DB_MIN} "
               f"AS core FROM dbh",
        "db1": f"SELECT *, last_value({cx} IGNORE NULLS) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
               f"AS prev_core FROM db0",
        "db2": f"SELECT *, CASE WHEN core AND (prev_core IS NULL OR {x} - prev_core > {DB_EPS}) THEN 1 ELSE 0 END "
               f"AS st FROM db1",
        "db3": f"SELECT *, CASE WHEN core THEN SUM(st) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 "
               f"END AS cid FROM db2",
        "db4": f"""SELECT *,
  last_value({cx} IGNORE NULLS) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo_x,
  last_value(cid IGNORE NULLS) OVER ({o} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lo_c,
  first_value({cx} IGNORE NULLS) OVER ({o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi_x,
  first_value(cid IGNORE NULLS) OVER ({o} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS hi_c FROM db3""",
        "dbl": f"""SELECT {key}, {x}, CAST(CASE WHEN core THEN cid
  WHEN lo_x IS NOT NULL AND {x} - lo_x <= {DB_EPS}
       AND (NOT (hi_x IS NOT NULL AND hi_x - {x} <= {DB_EPS}) OR {x} - lo_x <= hi_x - {x}) THEN lo_c
  WHEN hi_x IS NOT NULL AND hi_x - {x} <= {DB_EPS} THEN hi_c ELSE -1 END AS INTEGER) AS dbscan_label,
  CAST(core AS INTEGER) AS dbscan_core FROM db4""",
        "db5": f"SELECT s.*, l.dbscan_label, l.dbscan_core FROM {src} s LEFT JOIN dbl l "
               f"ON l.{key} = s.{key} AND l.{x} = s.{x}",
    }


@register("dbscan_1d", O.with_ctes({**O.base_ctes(), **_dbscan_sql("daily_country", "item_id", "sales_quantity")},
                                   "SELECT date_, item_id, sales_quantity, dbscan_label, dbscan_core FROM db5"))
def q_dbscan_1d(spark, sf_dir):
    d = ST.dbscan_1d(_country(spark, sf_dir), ["item_id"], "sales_quantity", DB_EPS, DB_MIN)
    return d.select("date_", "item_id", "sales_quantity", "dbscan_label", "dbscan_core")


Z_VOTE = 2.0


def _detectors(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    fl = PL.level_flags(cat, "country", P.AS_OF, P.DAYS)
    z = SE.zscore(fl, ["item_id"], "sales_quantity", Z_VOTE)
    db = ST.dbscan_1d(z, ["item_id"], "sales_quantity", DB_EPS, DB_MIN)
    db = db.withColumn("dbscan_flag", F.when(F.col("dbscan_label") == -1, 1).otherwise(0))
    return ST.vote(db, ["outlier_pan_item", "z_flag", "dbscan_flag"], 2)


def _detectors_sql() -> dict[str, str]:
    c = {**O.base_ctes(), **O.flag_ctes("country")}
    c["zc"] = f"""SELECT *, CASE WHEN abs(({_Q} - AVG({_Q}) OVER w) / NULLIF(STDDEV_POP({_Q}) OVER w, 0)) >= {Z_VOTE}
  THEN 1 ELSE 0 END AS z_flag FROM flags_country WINDOW w AS (PARTITION BY item_id)"""
    c.update(_dbscan_sql("zc", "item_id", "sales_quantity"))
    c["vt"] = """SELECT *, CASE WHEN dbscan_label = -1 THEN 1 ELSE 0 END AS dbscan_flag,
  outlier_pan_item + z_flag + CASE WHEN dbscan_label = -1 THEN 1 ELSE 0 END AS votes FROM db5"""
    c["vt2"] = "SELECT *, CASE WHEN votes >= 2 THEN 1 ELSE 0 END AS vote_flag FROM vt"
    return c


@register("vote", O.with_ctes(_detectors_sql(), """
SELECT date_, item_id, sales_quantity, outlier_pan_item, z_flag, dbscan_flag, votes, vote_flag FROM vt2"""))
def q_vote(spark, sf_dir):
    return _detectors(spark, sf_dir).select("date_", "item_id", "sales_quantity", "outlier_pan_item", "z_flag",
                                            "dbscan_flag", "votes", "vote_flag")


def _eval_sql(col: str) -> str:
    tp, fp = (f"CAST(COUNT_IF({col} = 1 AND vote_flag = 1) AS BIGINT)",
              f"CAST(COUNT_IF({col} = 1 AND vote_flag <> 1) AS BIGINT)")
    fn, tn = (f"CAST(COUNT_IF({col} <> 1 AND vote_flag = 1) AS BIGINT)",
              f"CAST(COUNT_IF({col} <> 1 AND vote_flag <> 1) AS BIGINT)")
    prec = f"CAST({tp} AS DOUBLE) / NULLIF(CAST({tp} + {fp} AS DOUBLE), 0)"
    rec = f"CAST({tp} AS DOUBLE) / NULLIF(CAST({tp} + {fn} AS DOUBLE), 0)"
    return (f"SELECT '{col}' AS detector, {tp} AS tp, {fp} AS fp, {fn} AS fn, {tn} AS tn, round({prec}, 6) AS precision, "
            f"round({rec}, 6) AS recall, round(2 * ({prec}) * ({rec}) / NULLIF(({prec}) + ({rec}), 0), 6) AS f1 FROM vt2")


@register("evaluate", O.with_ctes(_detectors_sql(), " UNION ALL ".join(
    _eval_sql(c) for c in ("outlier_pan_item", "z_flag", "dbscan_flag"))))
def q_evaluate(spark, sf_dir):
    d = _detectors(spark, sf_dir)
    parts = [ST.evaluate(d, c, "vote_flag").select(F.lit(c).alias("detector"), "*")
             for c in ("outlier_pan_item", "z_flag", "dbscan_flag")]
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@register("within_range", O.with_ctes({**O.range_ctes(False), "rt": O.range_select("rg", UPDATED_AT)}, """
SELECT d.date_, d.facility_id, d.item_id, d.sales_quantity, r."min" AS range_min, r."max" AS range_max,
       CASE WHEN CAST(d.sales_quantity AS DOUBLE) < r."min" OR CAST(d.sales_quantity AS DOUBLE) > r."max"
            THEN 1 ELSE 0 END AS out_of_range
FROM prod_daily d LEFT JOIN rt r ON r.facility_id = d.facility_id AND r.item_id = d.item_id"""))
def q_within_range(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    daily, _ = PL.range_input(cat, P.AS_OF, P.DAYS)
    daily = materialize(daily)
    ranges = PL.range_rows(daily, updated_at=UPDATED_AT)
    return (ST.within_range(daily, ranges, ["facility_id", "item_id"])
            .select("date_", "facility_id", "item_id", "sales_quantity", "range_min", "range_max", "out_of_range"))


@register("upsert_latest", O.with_ctes({**O.range_ctes(False), **O.range_ctes(True, p="rk"),
                                        "old_r": O.range_select("rg", UPDATED_AT),
                                        "new_r": O.range_select("rk", UPDATED_AT_NEW)}, """
SELECT facility_id, item_id, "min", "max", updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY facility_id, item_id ORDER BY updated_at DESC, src DESC) AS rn
  FROM (SELECT *, 0 AS src FROM old_r UNION ALL SELECT *, 1 AS src FROM new_r)) WHERE rn = 1"""))
def q_upsert_latest(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    daily, sparse = PL.range_input(cat, P.AS_OF, P.DAYS)
    # A key's range hangs on its own rows alone, so the ranges without the sparse keys are those of the others.
    old = PL.range_rows(materialize(daily), updated_at=UPDATED_AT)
    new = (old.join(sparse.select(*PL.RANGE_KEYS), PL.RANGE_KEYS, "left_anti")
              .withColumn("updated_at", F.lit(UPDATED_AT_NEW).cast("timestamp_ntz")))
    return SK.upsert_latest(old, new, ["facility_id", "item_id"], "updated_at")


# ---------------------------------------------------------------- model detectors
from salesguard.functions.scalar import is_workday  # noqa: E402
from salesguard.operators import envelope as EN  # noqa: E402
from salesguard.operators import forest as FO  # noqa: E402
from salesguard.operators import mixture as MX  # noqa: E402
from salesguard.operators import models as M  # noqa: E402
from salesguard.operators import oneclass as OC  # noqa: E402
from salesguard.plans import oracle_models as OM  # noqa: E402


def _country_features(spark, sf_dir):
    fl = PL.level_flags(_cat(spark, sf_dir), "country", P.AS_OF, P.DAYS)
    return fl.withColumn("workday", is_workday("date_").cast("double"))


def _store_features(spark, sf_dir):
    d = S.daily_sales(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS)
    return d.select("date_", "city_name", "facility_id", "item_id", F.col("sales_quantity").cast("double")
                    .alias("sales_quantity"), "ipc").dropna()


STORE_KEYS = ["date_", "city_name", "facility_id", "item_id"]


def _kmeans_ctes():
    c = {**O.base_ctes(), **O.flag_ctes("country"),
         "km_pts": "SELECT item_id, Sales AS x, CASE WHEN dayofweek(date_) IN (0, 6) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS y, "
                   "COUNT(*)::DOUBLE AS w FROM flags_country GROUP BY ALL",
         "km_rows": "SELECT *, Sales AS v FROM flags_country"}
    cuts = {n.replace("kc_", "km_"): q.replace("kc_", "km_")
            for n, q in O.segment_ctes("kc", "km_rows", ["item_id"], "none", value="Sales").items() if n != "kc_seg"}
    return {**c, **{n: q.replace("s.*, TRUE AS bc_ok, CAST(s.Sales AS DOUBLE) AS Sales", "s.*") for n, q in cuts.items()},
            **O.lloyd_ctes("km", ["item_id"])}


@register("kmeans_2d", O.with_ctes(_kmeans_ctes(), """
SELECT f.date_, f.item_id, f.sales_quantity, l.cluster, CASE WHEN l.cluster IN (1, 3) THEN 1 ELSE 0 END AS kmeans_flag
FROM flags_country f LEFT JOIN km_lab l ON l.item_id = f.item_id AND l.x = f.Sales
 AND l.y = CASE WHEN dayofweek(f.date_) IN (0, 6) THEN 0 ELSE 1 END"""))
def q_kmeans_2d(spark, sf_dir):
    d = _country_features(spark, sf_dir).select("date_", "item_id", "sales_quantity", "Sales", "workday")
    return M.kmeans_2d(d, ["item_id"], ["Sales", "workday"]).select(
        "date_", "item_id", "sales_quantity", "cluster", "kmeans_flag")


def _lloyd_sql(ks, body):
    c = {**O.base_ctes(), **O.flag_ctes("country"),
         "lp": "SELECT Sales AS x, CASE WHEN dayofweek(date_) IN (0, 6) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS y, "
               "COUNT(*)::DOUBLE AS w FROM flags_country WHERE Sales IS NOT NULL GROUP BY ALL"}
    for k in ks:
        c.update(O.lloyd_k_ctes(f"l{k}", "lp", k))
    return O.with_ctes(c, body)


@register("elbow", _lloyd_sql(range(1, 6), " UNION ALL ".join(
    f"SELECT {k}::INT AS k, round(-SUM(d * w), 3) AS score FROM l{k}_near" for k in range(1, 6))))
def q_elbow(spark, sf_dir):
    d = M.kmeans_elbow(_country_features(spark, sf_dir), ["Sales", "workday"])
    return d.select("k", F.round("score", 3).alias("score"))


@register("silhouette", _lloyd_sql([3], OM.SILHOUETTE))
def q_silhouette(spark, sf_dir):
    d = M.silhouette(_country_features(spark, sf_dir), ["Sales", "workday"], 3)
    return d.select("k", r6("silhouette").alias("silhouette"))


def _gmm_sql():
    c = {**O.base_ctes(), **O.flag_ctes("country"),
         "lp": "SELECT Sales AS x, CASE WHEN dayofweek(date_) IN (0, 6) THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS y, "
               "COUNT(*)::DOUBLE AS w FROM flags_country WHERE Sales IS NOT NULL GROUP BY ALL",
         **O.lloyd_k_ctes("l2", "lp", 2), **OM.mixture_ctes()}
    return O.with_ctes(c, """
SELECT f.date_, f.item_id, CASE WHEN r0 >= r1 THEN 0 ELSE 1 END AS prediction, round(r0, 6) AS p0, round(r1, 6) AS p1
FROM flags_country f LEFT JOIN gm ON gm.x = f.Sales AND gm.y = CASE WHEN dayofweek(f.date_) IN (0, 6) THEN 0 ELSE 1 END""")


@register("gmm", _gmm_sql())
def q_gmm(spark, sf_dir):
    d = _country_features(spark, sf_dir).select("date_", "item_id", "Sales", "workday")
    return MX.gmm(d, ["Sales", "workday"]).select("date_", "item_id", "prediction", r6(F.col("probability")[0]).alias("p0"),
                                                  r6(F.col("probability")[1]).alias("p1"))


@register("isolation_forest", O.with_ctes({**O.base_ctes(), **OM.store_rows(), **OM.forest_ctes()}, f"""
SELECT {', '.join(STORE_KEYS)}, round(score * 1e6) / 1e6 AS iforest_score, flag AS iforest_flag FROM if_scored"""))
def q_isolation_forest(spark, sf_dir):
    d = FO.isolation_forest(_store_features(spark, sf_dir), STORE_KEYS, ["sales_quantity", "ipc"],
                            n_trees=100, max_samples=256, contamination=0.01)
    return d.select(*STORE_KEYS, r6("iforest_score").alias("iforest_score"), "iforest_flag")


@register("elliptic_envelope", O.with_ctes({**O.base_ctes(), **OM.store_rows(), **OM.envelope_ctes()}, f"""
SELECT {', '.join(STORE_KEYS)}, round(d * 1e4) / 1e4 AS robust_distance, flag AS envelope_flag FROM ee"""))
def q_elliptic_envelope(spark, sf_dir):
    d = EN.elliptic_envelope(_store_features(spark, sf_dir), STORE_KEYS, ["sales_quantity", "ipc"], 0.01)
    return d.select(*STORE_KEYS, (F.round(F.col("robust_distance") * 1e4, 0) / 1e4).alias("robust_distance"), "envelope_flag")


@register("one_class_svm", O.with_ctes({**O.base_ctes(), **OM.store_rows(), **OM.one_class_ctes()}, f"""
SELECT {', '.join(STORE_KEYS)}, round(score * 1e6) / 1e6 + 0.0 AS oc_score, flag AS oc_flag FROM oc"""))
def q_one_class_svm(spark, sf_dir):
    d = OC.one_class(_store_features(spark, sf_dir), ["sales_quantity", "ipc"], nu=0.01)
    return d.select(*STORE_KEYS, r6("oc_score").alias("oc_score"), "oc_flag")


# ---------------------------------------------------------------- commented-out reference variants
MIN_ORDERS = 5


@register("distinct_orders", O.with_ctes(O.base_ctes(), f"""
SELECT product_id, city_name, COUNT(DISTINCT cart_id) AS orders FROM sales GROUP BY ALL
HAVING COUNT(DISTINCT cart_id) > {MIN_ORDERS}"""))
def q_distinct_orders(spark, sf_dir):
    lines = S.sales_lines(_cat(spark, sf_dir), P.AS_OF, P.DAYS)
    return ST.distinct_orders(lines, ["product_id", "city_name"], MIN_ORDERS)


@register("boxcox_standardised", O.with_ctes(
    {**O.base_ctes(), **O.segment_ctes("bs", "daily_country", ["item_id"], "boxcox", False)}, """
SELECT date_, item_id, sales_quantity, round(Sales, 6) AS Sales,
       round((Sales - AVG(Sales) OVER w) / NULLIF(STDDEV_POP(Sales) OVER w, 0), 6) AS sales_std
FROM bs_t WINDOW w AS (PARTITION BY item_id)"""))
def q_boxcox_standardised(spark, sf_dir):
    from salesguard.operators.segments import transformed
    d = transformed(_country(spark, sf_dir), ["item_id"], "boxcox")
    z = ST.standardise(d, ["item_id"], ["Sales"])
    return z.select("date_", "item_id", "sales_quantity", r6("Sales").alias("Sales"), r6("Sales_std").alias("sales_std"))


@register("rolling_mean_std", _seas("""
SELECT date, product_id, qty,
       CASE WHEN COUNT(qty) OVER w = 21 THEN round(AVG(qty) OVER w, 6) END AS rolling_mean,
       CASE WHEN COUNT(qty) OVER w = 21 THEN round(STDDEV_SAMP(qty) OVER w, 6) END AS rolling_std
FROM prod_dem WINDOW w AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING)"""))
def q_rolling_mean_std(spark, sf_dir):
    pdm = D.product_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)
    d = SE.rolling_mean_std(pdm, ["product_id"], "date", "qty")
    return d.select("date", "product_id", "qty", SE.r6_col("rolling_mean"), SE.r6_col("rolling_std"))


@register("rolling_ewm", _seas(f"""
SELECT date, product_id, qty, CASE WHEN n = 21 THEN round(list_sum(list_transform(xs, lambda v, i: v * power(20.0 / 22.0, 21 - i)))
       / {sum((20.0 / 22.0) ** k for k in range(21))!r}, 6) END AS rolling_ewm
FROM (SELECT date, product_id, qty, COUNT(qty) OVER w AS n, list(qty::DOUBLE) OVER w AS xs FROM prod_dem
      WINDOW w AS (PARTITION BY product_id ORDER BY date ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING))"""))
def q_rolling_ewm(spark, sf_dir):
    pdm = D.product_demand(_cat(spark, sf_dir), P.AS_OF, P.DAYS)
    d = SE.rolling_ewm(pdm, ["product_id"], "date", "qty")
    return d.select("date", "product_id", "qty", SE.r6_col("rolling_ewm"))


@register("deseasonalised_subtract", _seas(f"""
SELECT {DES_COLS}, round(qty - COALESCE(monthly_seasonal, 0) - COALESCE(weekly_seasonal, 0), 6) AS adjusted FROM des"""))
def q_deseasonalised_subtract(spark, sf_dir):
    d = _deseasonalised(spark, sf_dir, "subtract")
    return d.select(*DES_COLS.split(", "), SE.r6_col("adjusted"))


@register("range_midpoint", O.with_ctes(O.range_ctes(False), f"""
SELECT CAST(facility_id AS INTEGER) AS facility_id, CAST(item_id AS INTEGER) AS item_id,
       round_even((lo + mid) / 2, 2) AS "min", round_even((hi + mid) / 2, 2) AS "max",
       CAST(TIMESTAMP '{UPDATED_AT}' AS TIMESTAMP) AS updated_at
FROM (SELECT facility_id, item_id, AVG(CASE WHEN cluster = 1 THEN CAST(sales_quantity AS DOUBLE) END) AS lo,
             AVG(CASE WHEN cluster = 2 THEN CAST(sales_quantity AS DOUBLE) END) AS mid,
             AVG(CASE WHEN cluster = 3 THEN CAST(sales_quantity AS DOUBLE) END) AS hi
      FROM rg_seg WHERE cluster IS NOT NULL GROUP BY ALL)"""))
def q_range_midpoint(spark, sf_dir):
    return PL.range_pipeline(_cat(spark, sf_dir), P.AS_OF, P.DAYS, midpoint=True, updated_at=UPDATED_AT)[0]


for _fn, _sql in (("log", "ln(CAST(sales_quantity AS DOUBLE))"), ("sqrt", "sqrt(CAST(sales_quantity AS DOUBLE))")):
    def _mkt(fn):
        def q(spark, sf_dir):
            from salesguard.operators.segments import transformed
            d = transformed(_country(spark, sf_dir), ["item_id"], fn)
            return d.select("date_", "item_id", "sales_quantity", r6("Sales").alias("Sales"))
        return q
    register(f"{_fn}_sales", O.with_ctes(O.base_ctes(), f"""
SELECT date_, item_id, sales_quantity, round({_sql}, 6) AS Sales FROM daily_country"""))(_mkt(_fn))


@register("boxcox_skew", O.with_ctes(
    {**O.base_ctes(), **O.segment_ctes("bk", "daily_country", ["item_id"], "boxcox", False)}, """
SELECT item_id, COUNT(*) AS n, round(CASE WHEN var_pop(sales_quantity) > 0 THEN skewness(sales_quantity) END, 6) AS skew_before,
       round(CASE WHEN var_pop(Sales) > 0 THEN skewness(Sales) END, 6) AS skew_after
FROM bk_t GROUP BY ALL HAVING COUNT(*) >= 3"""))
def q_boxcox_skew(spark, sf_dir):
    """Bias-adjusted skewness of each item's sales before and after the transform."""
    from salesguard.functions.scalar import sample_skewness
    from salesguard.operators.segments import transformed
    d = transformed(_country(spark, sf_dir), ["item_id"], "boxcox")
    n = F.count(F.lit(1))
    skew = lambda c: F.round(F.when(F.var_pop(c) > 0, sample_skewness(c, n)), 6)
    return (d.groupBy("item_id").agg(n.alias("n"), skew("sales_quantity").alias("skew_before"), skew("Sales").alias("skew_after"))
            .filter("n >= 3"))


# ---------------------------------------------------------------- dimensions seen in sales
@register("item_category_seen", O.with_ctes(O.base_ctes(), """
SELECT * FROM item_categories WHERE item_id IN (SELECT item_id FROM daily_store)"""))
def q_item_category_seen(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return S.item_category(cat, S.daily_sales(cat, "store", P.AS_OF, P.DAYS))


@register("item_type_dim", O.with_ctes(O.base_ctes(), "SELECT DISTINCT p_type, item_id, item_name FROM daily_store"))
def q_item_type_dim(spark, sf_dir):
    return S.item_type_dim(S.daily_sales(_cat(spark, sf_dir), "store", P.AS_OF, P.DAYS))
