"""Plan checks: pruning and pushdown at the scan, no cartesian products, no
Python in native operators, one exchange per segmentation level."""

import __spark_entry__ as E
from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_products(spark):
    for name in ("daily_sales_store", "range_table", "surge_penetration", "rolling_spikes", "keyword_category_map"):
        p = plan(E.queries()[name](spark, SF001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_native_operators_have_no_python(spark):
    for name in ("daily_sales_store", "surge_penetration", "net_invoice_sales", "rolling_spikes", "dbscan_1d"):
        p = plan(E.queries()[name](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "FlatMapGroupsInPandas" not in p, name


def test_scan_pruning_and_pushdown(spark):
    from salesguard.operators import sales as S
    from salesguard.sources.tables import Catalog
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        df = S.sales_lines(Catalog(spark, SF001), "2001-08-01", 90).select("cart_id", "sales_quantity")
        scans = [ln for ln in plan(df).split("\n") if "FileScan parquet" in ln]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    orders = next(ln for ln in scans if "orders.parquet" in ln)
    pushed = orders.split("PushedFilters: ")[1]
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    line = next(ln for ln in scans if "lineitem.parquet" in ln)
    schema = line.split("ReadSchema: ")[1]
    assert "l_shipdate" not in schema and "l_discount" not in schema and "l_orderkey" in schema


def test_segmentation_single_exchange(spark):
    from salesguard.operators import segments as G
    from salesguard.plans.materialize import materialize
    from salesguard.operators import sales as S
    from salesguard.sources.tables import Catalog
    daily = materialize(S.daily_sales(Catalog(spark, SF001), "country", "2001-08-01", 2405))
    p = G.segment(daily, ["item_id"])._jdf.queryExecution().executedPlan().toString()
    assert p.count("ENSURE_REQUIREMENTS") == 0
