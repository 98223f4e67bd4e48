"""Readers, views and parameterised SQL."""

from pyspark.sql import functions as F

from conftest import SF001
from salesguard.sources import io
from salesguard.sources.tables import Catalog


def test_views_and_parameterised_sql(spark):
    cat = Catalog(spark, SF001)
    names = io.register_views(cat, prefix="t_")
    assert "t_fact_items" in names
    n = io.read_sql(spark, "SELECT COUNT(*) AS n FROM t_outlets WHERE business_type_id = :bt", {"bt": 7}).first()["n"]
    assert n == cat.outlets.filter("business_type_id = 7").count()


def test_csv_with_declared_schema(spark, scratch):
    spark.createDataFrame([("AMERICA",), ("ASIA",)], "city_name string").write.option("header", True).csv(scratch + "/c")
    df = io.read_csv(spark, scratch + "/c", "city_name string")
    assert sorted(r[0] for r in df.collect()) == ["AMERICA", "ASIA"]


def test_restrict_to_empty_and_single(spark):
    cat = Catalog(spark, SF001)
    items = cat.items
    empty = spark.createDataFrame([], "item_id int")
    one = spark.createDataFrame([(13,)], "item_id int")
    assert io.restrict_to(items, empty, ["item_id"]).count() == 0
    assert io.restrict_to(items, one, ["item_id"]).select(F.max("item_id")).first()[0] == 13


def test_calendar_one_row_per_event(spark):
    cal = Catalog(spark, SF001).calendar
    per_date = cal.groupBy("event_date").count()
    assert per_date.filter("count > 1").count() > 0          # 25 Dec carries two events
