"""Demand datasets for the seasonality chain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesguard.functions.scalar import dow_sunday0, money, week_of_month
from salesguard.operators import sales as S
from salesguard.sources.tables import DELIVERED, Catalog

EXCLUDED_CATEGORY = "Freebie"   # fixed value of the reference filter


def _demand_lines(cat: Catalog, as_of: str | None, days: int | None) -> DataFrame:
    f = cat.fact_items.filter((F.col("order_status") == DELIVERED) & ~F.col("is_internal")
                              & S.time_window("checkout_ts", as_of, days))
    p = cat.products.filter(F.col("l2_category") != EXCLUDED_CATEGORY).select("product_key", "l2_category")
    return (f.join(p, f.product_id == p.product_key)
             .select(F.to_date("checkout_ts").alias("date"), "l2_category", "product_id", "procured"))


def _calendar_cols(d: str = "date"):
    return [week_of_month(d).alias("wom"), F.dayofmonth(d).alias("dom"), dow_sunday0(d).alias("dow")]


def category_demand(cat: Catalog, as_of: str | None = None, days: int | None = 180) -> DataFrame:
    """Delivered quantity per date x category with week-of-month, day and weekday."""
    lines = _demand_lines(cat, as_of, days)
    return (lines.groupBy("date", *_calendar_cols(), "l2_category")
                 .agg(F.sum("procured").cast("double").alias("qty")))


def product_demand(cat: Catalog, as_of: str | None = None, days: int | None = 180) -> DataFrame:
    """As D10 at product grain."""
    lines = _demand_lines(cat, as_of, days)
    return (lines.groupBy("date", *_calendar_cols(), "l2_category", "product_id")
                 .agg(F.sum("procured").cast("double").alias("qty")))


def invoice_lines(cat: Catalog, as_of: str | None = None, days: int | None = 30) -> DataFrame:
    """POS invoice lines: sales (type 1) and returns (type 2) of delivered orders."""
    f = cat.fact_items.filter((F.col("order_status") == DELIVERED)
                              & ~F.col("order_type").ilike("%internal%")
                              & S.time_window("checkout_ts", as_of, days))
    im = S.item_mapping(cat)
    return (f.join(im, "product_id")
             .select(F.to_date("checkout_ts").alias("order_date"),
                     F.when(F.col("return_flag") == "R", 2).otherwise(1).alias("invoice_type_id"),
                     "cart_id", F.col("cart_id").alias("order_id"), "outlet_id", "item_id",
                     F.col("procured").alias("quantity"), F.col("unit_price").alias("selling_price"),
                     F.col("unit_mrp").alias("variant_mrp")))


def net_invoice_sales(cat: Catalog, as_of: str | None = None, days: int | None = 30) -> DataFrame:
    """Invoiced sales minus the order-item's returns, per date x city x outlet x item.

    Returns are summed per (order, item) and subtracted from every sale row of
    that order-item (left join: returns without a sale are ignored).
    """
    inv = invoice_lines(cat, as_of, days)
    q = F.col("quantity")
    ret = (inv.filter(F.col("invoice_type_id").isin(2, 8)).groupBy("order_id", "item_id")
              .agg(F.sum(q).alias("back_q"), F.sum(q * F.col("selling_price")).alias("back_value"),
                   F.sum(q * F.col("variant_mrp")).alias("back_mrp")))
    sal = (inv.filter(F.col("invoice_type_id").isin(1, 7))
              .groupBy(F.col("order_date").alias("date_"), "order_id", "outlet_id", "item_id")
              .agg(F.sum(q).alias("sales_quantity"), F.sum(q * F.col("selling_price")).alias("sold_value"),
                   F.sum(q * F.col("variant_mrp")).alias("sold_mrp"))
              .join(ret, ["order_id", "item_id"], "left")
              .fillna(0, ["back_q"]).fillna(0.0, ["back_value", "back_mrp"]))
    cats = cat.item_categories.select("item_id", F.col("l2").alias("category"))
    so = S.store_outlets(cat).select("outlet_id", "city_name")
    j = sal.join(cats, "item_id").join(S.item_names(cat), "item_id").join(so, "outlet_id")
    return (j.groupBy("date_", "city_name", "outlet_id", "item_id", "item_name", "category")
             .agg(F.sum(F.col("sales_quantity") - F.col("back_q")).cast("long").alias("sales_quantity"),
                  money(F.sum(F.col("sold_value") - F.col("back_value"))).alias("sales_value"),
                  money(F.sum(F.col("sold_mrp") - F.col("back_mrp"))).alias("sales_mrp")))
