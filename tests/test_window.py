"""The look-back window of the sales lines, and the shared folder of lineage cuts."""

import os
import subprocess
import sys

import pytest
from conftest import SF001

from salesguard import session
from salesguard.operators import sales as S
from salesguard.sources.tables import Catalog

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_days_hold_without_a_date(spark):
    cat = Catalog(spark, SF001)
    assert S.sales_lines(cat, None, 7).count() == 0        # the test tables end in 2001
    whole = S.sales_lines(cat, None, None).count()
    assert whole == S.sales_lines(cat, "2001-08-01", None).count() == S.sales_lines(cat, "2001-08-01", 2405).count()
    assert 0 < S.sales_lines(cat, "2001-08-01", 90).count() < whole
    assert S.sales_lines(cat, "1998-01-01", None).count() < whole


def test_default_window_is_pushed_to_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = S.sales_lines(Catalog(spark, SF001), None, 90)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(x for x in plan.split("\n") if "FileScan parquet" in x and "orders.parquet" in x)
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan


def test_one_scan_of_the_fact(spark):
    import __spark_entry__ as E
    for name in ("daily_sales_store", "daily_sales_city", "daily_sales_country", "cart_share"):
        plan = E.queries()[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        scans = [x for x in plan.split("\n") if "FileScan parquet" in x]
        assert sum("lineitem.parquet" in x for x in scans) == 1 == sum("orders.parquet" in x for x in scans), name


def test_range_flow_reads_the_fact_once(spark):
    from salesguard.plans import flows
    ranges, errors = flows.range_pipeline(Catalog(spark, SF001), "2001-08-01", 2405)
    for df in (ranges, errors):
        assert not [f for f in df.inputFiles() if "lineitem" in f or "orders" in f]


def test_cut_writes_to_the_operators_folder_and_can_be_released(spark):
    df = session.cut(spark.range(5), "test")
    files = df.inputFiles()
    folder = session.shared_folder(spark)
    assert files and all(folder.removeprefix("file:") in f for f in files) and df.count() == 5
    session.release(df)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def test_a_folder_that_was_set_wins_and_none_is_an_error(scratch):
    code = f"""
import sys; sys.path.insert(0, {REPO!r})
from salesguard import session
class Context:
    def __init__(self, path): self.path = path
    def getCheckpointDir(self): return self.path
class Conf:
    def __init__(self, path): self.path = path
    def get(self, key, default=None): return self.path or default
class Session:
    def __init__(self, a, b): self.sparkContext, self.conf = Context(a), Conf(b)
assert session.shared_folder(Session("/set", "/conf")) == "/set"
assert session.shared_folder(Session(None, "/conf")) == "/conf"
try:
    session.shared_folder(Session(None, None))
except RuntimeError as e:
    assert "spark.checkpoint.dir" in str(e)
else:
    raise AssertionError
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


@pytest.mark.parametrize("days", [0, 1])
def test_window_bounds(spark, days):
    df = spark.sql("SELECT explode(sequence(timestamp_ntz'2020-01-01 00:00:00', timestamp_ntz'2020-01-05 00:00:00', interval 12 hours)) t")
    got = [str(r.t) for r in df.filter(S.time_window("t", "2020-01-03", days)).collect()]
    assert got[0] == f"2020-01-0{3 - days} 00:00:00" and got[-1] == "2020-01-03 12:00:00"
