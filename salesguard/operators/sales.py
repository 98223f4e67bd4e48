"""Sales datasets.

Every function takes lazy DataFrames and returns one; the whole chain is a
single Catalyst plan. Shuffles: cart totals (by cart), daily aggregation (by
daily key), sparse-key counting (by month key); all have map-side partial
aggregation, so a hot store or item is pre-aggregated before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from salesguard.operators import sketches
from salesguard.functions.scalar import money, r6, safe_div
from salesguard.sources.tables import DELIVERED, STORE_BUSINESS_TYPE, Catalog

LEVEL_KEYS = {
    "store": ["city_name", "facility_id"],
    "city": ["city_name"],
    "country": [],
}


def level_keys(level: str) -> list[str]:
    if level not in LEVEL_KEYS:
        raise ValueError(f"level must be one of {sorted(LEVEL_KEYS)}")
    return LEVEL_KEYS[level]


def item_names(cat: Catalog) -> DataFrame:
    """Item name = name || ' ' || variant (NULL-propagating)."""
    i = cat.items
    return i.select("item_id", F.concat(F.col("name"), F.lit(" "), F.col("variant_description")).alias("item_name"))


def item_mapping(cat: Catalog) -> DataFrame:
    """Product -> (item, pack multiplier).

    The product's own item wins and takes the multiplier of the matching offer;
    without an own item the offer's item and multiplier are used; default 1.
    """
    products = cat.item_product_map.alias("made")
    own = cat.offers.alias("own")
    any_offer = cat.offers.alias("any_offer")
    j = (products.join(own, (F.col("own.product_id") == F.col("made.product_id"))
                  & (F.col("made.item_id") == F.col("own.item_id")), "left")
            .join(any_offer, F.col("any_offer.product_id") == F.col("made.product_id"), "left"))
    has_own = F.col("made.item_id").isNotNull()
    return (j.select(
                F.col("made.product_id").alias("product_id"),
                F.when(has_own, F.col("made.item_id")).otherwise(F.col("any_offer.item_id")).alias("item_id"),
                F.when(has_own, F.coalesce(F.col("own.multiplier"), F.lit(1)))
                 .otherwise(F.coalesce(F.col("any_offer.multiplier"), F.lit(1))).alias("multiplier"))
            .distinct())


def store_outlets(cat: Catalog) -> DataFrame:
    """Outlets of the store business type with their city (J2: filter, then join)."""
    o = cat.outlets.filter(F.col("business_type_id").isin(STORE_BUSINESS_TYPE))
    loc = cat.locations
    return o.join(loc, o.location_id == loc.id).select(
        o.id.alias("outlet_id"), "facility_id", loc.name.alias("city_name"), "active")


def time_window(ts_col: str, as_of: str | None, days: int | None):
    """Half-open window [as_of - days, as_of + 1 day) on a timestamp column.

    Without ``as_of`` the window ends today. ``days=None`` asks for the whole
    history (up to ``as_of``, if given).
    """
    if as_of is None and days is None:
        return F.lit(True)
    day = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    until = F.col(ts_col) < F.date_add(day, 1).cast("timestamp_ntz")
    return until if days is None else until & (F.col(ts_col) >= F.date_sub(day, int(days)).cast("timestamp_ntz"))


def valid_line_filter(as_of: str | None = None, days: int | None = None):
    """Delivered, non-internal lines with procured quantity (D3 WHERE clause)."""
    return (time_window("checkout_ts", as_of, days)
            & ~F.col("is_internal")
            & (~F.col("order_type").ilike("%internal%") | F.col("order_type").isNull())
            & (F.col("procured") > 0)
            & (F.col("order_status") == DELIVERED))


def sales_lines(cat: Catalog, as_of: str | None = None, days: int | None = None) -> DataFrame:
    """D3: order lines in item units, net of doorstep returns."""
    f = cat.fact_items.filter(valid_line_filter(as_of, days))
    im = item_mapping(cat)
    so = store_outlets(cat)
    j = f.join(im, "product_id").join(so, "outlet_id")
    q = (F.col("procured") - F.col("returned")) * F.col("multiplier")
    price = F.col("unit_price") * 1.00 / F.col("multiplier")
    mrp = F.col("unit_mrp") * 1.00 / F.col("multiplier")
    return j.select(
        F.col("checkout_ts").alias("order_date"), "city_name", "facility_id", "product_id", "item_id",
        "cart_id", "customer_key", price.alias("item_selling_price"), mrp.alias("item_selling_mrp"),
        "multiplier", F.col("returned").alias("total_doorstep_return_quantity"),
        q.alias("sales_quantity"), (q * price).alias("sales_value"), (q * mrp).alias("sales_value_mrp"))


def sparse_keys(lines: DataFrame, level: str = "store", min_carts: int = 3, approximate: bool = False) -> DataFrame:
    """Keys with a calendar month (number; years merge) of fewer than
    ``min_carts`` distinct carts. Months without carts produce no row.
    ``approximate`` counts by merged day sketches (see ``sketches``)."""
    keys = (["facility_id"] if level == "store" else level_keys(level)) + ["item_id"]
    if approximate:
        return sketches.sparse_from(sketches.day_counts(lines, keys, "order_date", "cart_id"), keys, min_carts)
    per_month = (lines.groupBy(F.month("order_date").alias("month"), *keys)
                 .agg(F.countDistinct("cart_id").alias("total_carts")))
    return (per_month.filter(F.col("total_carts") < min_carts)
            .select(*keys).distinct().withColumn("remove_flag", F.lit(1)))


def cart_totals(lines: DataFrame) -> DataFrame:
    """Total item quantity per cart (all lines of the cart)."""
    return lines.groupBy("cart_id").agg(F.sum("sales_quantity").alias("order_quantity"))


def with_cart_totals(lines: DataFrame) -> DataFrame:
    """Lines with ``order_quantity``, the cart total (D6), from one exchange by
    cart instead of a second pass over the fact; a cart is small."""
    return lines.withColumn("order_quantity", F.sum("sales_quantity").over(W.partitionBy("cart_id")))


def daily_sales(cat: Catalog, level: str = "store", as_of: str | None = None, days: int | None = None,
                lines: DataFrame | None = None) -> DataFrame:
    """Net daily sales per level key and item, with items-per-cart share.

    Grain: date x (city x facility | city | -) x item. Only lines with positive
    net quantity enter the sums; the cart total counts every line.
    """
    lines = lines if lines is not None else sales_lines(cat, as_of, days)
    names = item_names(cat)
    types = cat.item_types
    keys = level_keys(level)
    j = (with_cart_totals(lines).filter(F.col("sales_quantity") > 0)
              .join(names, "item_id")
              .join(types, "item_id", "left"))
    share = safe_div(F.col("sales_quantity").cast("double"), F.col("order_quantity").cast("double"))
    return (j.groupBy(F.to_date("order_date").alias("date_"), *keys, "p_type", "item_id", "item_name")
             .agg(F.sum("sales_quantity").cast("int").alias("sales_quantity"),
                  money(F.sum("sales_value")).alias("sales_value"),
                  money(F.sum("sales_value_mrp")).alias("sales_value_mrp"),
                  r6(F.avg(share)).alias("ipc")))


def daily_sales_levels(cat: Catalog, as_of: str | None = None, days: int | None = None,
                       lines: DataFrame | None = None) -> DataFrame:
    """D7 + D8 in one pass: GROUPING SETS over the sales lines for the store,
    city and country grains (one scan and one shuffle instead of three).
    ``level`` tells the grain of each row; coarser grains have NULL keys."""
    lines = lines if lines is not None else sales_lines(cat, as_of, days)
    j = (with_cart_totals(lines).filter(F.col("sales_quantity") > 0)
              .join(item_names(cat), "item_id")
              .join(cat.item_types, "item_id", "left")
              .withColumn("date_", F.to_date("order_date")))
    share = safe_div(F.col("sales_quantity").cast("double"), F.col("order_quantity").cast("double"))
    dims = ["date_", "p_type", "item_id", "item_name"]
    sets = [dims + ["city_name", "facility_id"], dims + ["city_name"], dims]
    g = (j.groupingSets(sets, *dims, "city_name", "facility_id")
          .agg(F.sum("sales_quantity").cast("int").alias("sales_quantity"),
               money(F.sum("sales_value")).alias("sales_value"),
               money(F.sum("sales_value_mrp")).alias("sales_value_mrp"),
               r6(F.avg(share)).alias("ipc"),
               F.grouping("city_name").alias("_g_city"), F.grouping("facility_id").alias("_g_fac")))
    level = (F.when(F.col("_g_city") == 1, F.lit("country")).when(F.col("_g_fac") == 1, F.lit("city"))
              .otherwise(F.lit("store")))
    return g.withColumn("level", level).drop("_g_city", "_g_fac")


def level_rows(levels: DataFrame, level: str) -> DataFrame:
    """The rows of one grain from ``daily_sales_levels``, in ``daily_sales`` column order."""
    keys = level_keys(level)
    return (levels.filter(F.col("level") == level)
                  .select("date_", *keys, "p_type", "item_id", "item_name", "sales_quantity", "sales_value",
                          "sales_value_mrp", "ipc"))


def cart_share(cat: Catalog, as_of: str | None = None, days: int | None = None) -> DataFrame:
    """A5 on its own: per cart and item, the line's share of the cart quantity."""
    lines = sales_lines(cat, as_of, days)
    return (with_cart_totals(lines).filter(F.col("sales_quantity") > 0)
            .groupBy("cart_id", "item_id")
            .agg(F.sum("sales_quantity").cast("long").alias("item_quantity"),
                 F.first("order_quantity").cast("long").alias("order_quantity"),
                 r6(F.avg(safe_div(F.col("sales_quantity").cast("double"),
                                   F.col("order_quantity").cast("double")))).alias("ipc")))


def item_type_dim(daily: DataFrame) -> DataFrame:
    """Distinct (p_type, item_id, item_name) seen in daily sales."""
    return daily.select("p_type", "item_id", "item_name").distinct()


def item_category(cat: Catalog, items: DataFrame | None = None) -> DataFrame:
    """Item -> l2 category, optionally restricted to items seen (semi join, J8)."""
    c = cat.item_categories
    return c.join(items.select("item_id").distinct(), "item_id", "left_semi") if items is not None else c
