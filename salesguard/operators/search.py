"""Search-demand datasets.

App events are filtered, mapped to facilities through the merchant dimension
and aggregated. The keyword -> category map keeps pairs that are frequent and
specific enough; searches for mapped keywords are counted per category, and an
item's search level is the mean over its category's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesguard.functions.scalar import r6
from salesguard.sources.tables import Catalog

# Fixed values of the event filters (as in the reference queries).
BAD_RAW_KEYWORDS = ["-NA-", "#-NA", ""]
BAD_KEYWORDS = ["", " ", "#-na"]
SEARCH_PARENTS = ["type-to-search", "type_to_search"]


def _keyword() -> F.Column:
    return F.trim(F.lower(F.col("search_keyword")))


def _event_filter(name: str, start: str | None, end: str | None, excluded_users):
    c = ((F.col("name") == name)
         & F.col("search_keyword").isNotNull()
         & ~F.col("search_keyword").isin(*BAD_RAW_KEYWORDS)
         & F.col("search_keyword_parent").isin(*SEARCH_PARENTS)
         & F.col("user_id").isNotNull()
         & ~F.col("user_id").isin(-1, 0, *excluded_users)
         & F.col("city_id").isNotNull()
         & F.col("merchant_id").isNotNull()
         & F.col("merchant_name").isNotNull()
         & ~_keyword().isin(*BAD_KEYWORDS)
         & (F.length(_keyword()) > 2))
    if start is not None:
        c = c & (F.col("at_date") >= F.to_date(F.lit(start)))
    if end is not None:
        c = c & (F.col("at_date") <= F.to_date(F.lit(end)))
    return c


def _express_merchants(cat: Catalog) -> DataFrame:
    m = cat.merchants
    return m.filter(F.col("is_express_store") & F.col("is_current")).select("merchant_id", "facility_id")


def keyword_atc(cat: Catalog, start: str | None = None, end: str | None = None, excluded_users=()) -> DataFrame:
    """Add-to-cart events per keyword x product x facility x category x day."""
    ev = cat.mobile_events.filter(_event_filter("Product Added", start, end, excluded_users))
    prod = (cat.products.filter(F.col("is_current") & F.col("is_product_enabled"))
            .select("product_id", "l2_category_id"))
    j = ev.join(prod, "product_id").join(_express_merchants(cat), "merchant_id")
    return (j.groupBy(_keyword().alias("keyword"), "product_id", "facility_id", "l2_category_id",
                      F.col("at_date").alias("date_"))
             .agg(F.count("device_uuid").alias("key_prod_atc")))


def searches(cat: Catalog, start: str | None = None, end: str | None = None, excluded_users=()) -> DataFrame:
    """Distinct (day, facility, merchant, device, keyword) of search events."""
    ev = cat.mobile_events.filter(_event_filter("Product Searched", start, end, excluded_users))
    j = ev.join(_express_merchants(cat), "merchant_id")
    return (j.select(F.col("at_date").alias("date_"), "facility_id", "merchant_id",
                     F.lower("device_uuid").alias("device_uuid"), _keyword().alias("keyword"))
             .distinct())


def keyword_stats(atc: DataFrame, min_total: int = 100, min_pair: int = 10) -> DataFrame:
    """D14 before the share filter: keyword-category pairs with totals and shares.

    The events are added up once, to (keyword, category); both totals are
    window sums over those few rows, so no keyword or category is joined on.
    """
    pair = atc.groupBy("keyword", "l2_category_id").agg(F.sum("key_prod_atc").alias("pair_atc"))
    totals = pair.withColumns({
        "keyword_atc": F.sum("pair_atc").over(Window.partitionBy("keyword")),
        "category_atc": F.sum("pair_atc").over(Window.partitionBy("l2_category_id"))})
    return (totals.filter((F.col("keyword_atc") >= min_total) & (F.col("pair_atc") > min_pair))
                  .withColumn("keyword_pct", F.col("pair_atc") * 100.0 / F.col("keyword_atc"))
                  .withColumn("category_pct", F.col("pair_atc") * 100.0 / F.col("category_atc")))


def keyword_category_map(atc: DataFrame, min_total: int = 100, min_pair: int = 10,
                         min_share_of_category: float = 0.1, min_share_of_keyword: float = 10,
                         with_stats: bool = False) -> DataFrame:
    """Keep (category, keyword) when the keyword is frequent, the pair is
    frequent, the pair is >= 0.1 % of the category and >= 10 % of the keyword."""
    st = keyword_stats(atc, min_total, min_pair)
    kept = st.filter((F.col("category_pct") >= min_share_of_category) & (F.col("keyword_pct") >= min_share_of_keyword))
    if with_stats:
        return kept.select("l2_category_id", "keyword",
                           *[F.col(c).cast("long").alias(c) for c in ("keyword_atc", "category_atc", "pair_atc")],
                           r6("keyword_pct").alias("keyword_pct"), r6("category_pct").alias("category_pct"))
    return kept.select("l2_category_id", "keyword")


def top_keywords(atc: DataFrame, k: int, min_total: int = 100, min_pair: int = 10) -> DataFrame:
    """The k most added-to-cart keywords per category (ties by keyword).

    ``rank <= k`` lets Spark apply a per-partition group limit before the
    shuffle, so a large category never sorts all its keywords in one task.
    """
    st = keyword_stats(atc, min_total, min_pair)
    w = Window.partitionBy("l2_category_id").orderBy(F.desc("pair_atc"), F.asc("keyword"))
    return (st.withColumn("keyword_rank", F.row_number().over(w))
              .filter(F.col("keyword_rank") <= k)
              .select("l2_category_id", "keyword", F.col("pair_atc").cast("long").alias("pair_atc"),
                      "keyword_rank"))


def facility_city(cat: Catalog) -> DataFrame:
    """Distinct facility -> city (SURVEY Q22: no fan-out over a facility's outlets)."""
    o, loc = cat.outlets, cat.locations
    return o.join(loc, o.location_id == loc.id).select("facility_id", loc.name.alias("city_name")).distinct()


def category_searches(cat: Catalog, srch: DataFrame, kwmap: DataFrame) -> DataFrame:
    """Searches of mapped keywords per day x city x facility x category x merchant.

    Searches are counted per keyword first, so that a popular keyword meets the
    map as a few counts and not as all its devices.
    """
    counted = (srch.groupBy("date_", "facility_id", "merchant_id", "keyword")
               .agg(F.count("device_uuid").alias("_n")))
    j = counted.join(kwmap, "keyword").join(facility_city(cat), "facility_id")
    return (j.groupBy("date_", "city_name", "facility_id", "l2_category_id", "merchant_id")
             .agg(F.sum("_n").alias("searches")))


def avg_searches(cat: Catalog, cs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Mean searches per (facility, item) and per (city, item).

    The reference expands category rows to items and averages. The same mean
    is computed without the expansion: sums and counts per (level, category)
    are joined to the item list and combined, so the row count never grows with
    the number of items per category.
    """
    items = cat.item_categories.select("item_id", F.col("l2_id").alias("l2_category_id"))

    def per(level_cols, out):
        s = cs.groupBy(*level_cols, "l2_category_id").agg(F.sum("searches").alias("_s"),
                                                        F.count("searches").alias("_n"))
        return (s.join(items, "l2_category_id")
                 .groupBy(*level_cols, "item_id")
                 .agg((F.sum("_s") / F.sum("_n")).alias(out)))
    return per(["facility_id"], "store_searches"), per(["city_name"], "city_searches")
