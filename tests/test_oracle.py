"""Spark plans vs the independent DuckDB oracle on sf0.001 (a fast subset;
tools/check.py runs every query at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001

FAST = ["item_mapping", "daily_sales_store", "daily_sales_country", "sparse_keys", "cart_share", "range_table",
        "range_errors", "keyword_category_map", "category_searches", "surge_penetration", "category_demand",
        "seasonal_weekly", "rolling_spikes", "dbscan_1d", "profile_stats", "net_invoice_sales", "city_flags",
        "store_flags_raw", "city_flags_sales_only", "kmeans_2d", "hierarchical_outliers", "hierarchical_outliers_raw",
        "attribution_report", "within_range", "upsert_latest", "surge_days", "keyword_top_k", "range_midpoint", "log_sales",
        "sqrt_sales", "boxcox_skew", "deseasonalised_subtract", "rolling_ewm", "keyword_atc", "boxcox_lambda",
        "boxcox_frame", "range_errors_intended", "range_table_some", "gmm", "isolation_forest", "elliptic_envelope",
        "one_class_svm", "silhouette"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    s = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = {c: i for i, c in enumerate(ocols)}
    o = sorted((tuple(_norm(r[idx[c]]) for c in cols) for r in cur.fetchall()), key=repr)
    assert s == o


def test_every_query_has_an_oracle():
    from salesguard.plans.registry import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["facility_id", "item_id", "min", "max", "updated_at"]
