"""Scalar helpers."""

import datetime as dt

from pyspark.sql import functions as F

from salesguard.functions import scalar as X


def test_calendar_helpers(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),), (dt.date(2024, 1, 29),)], "d date")
    r = df.select("d", X.week_of_month("d").alias("wom"), X.dow_sunday0("d").alias("dow"),
                  *X.calendar_features("d")).orderBy("d").collect()
    assert (r[0]["wom"], r[0]["dow"], r[0]["DayOfTheWeek"], r[0]["WeekDay"], r[0]["hours"]) == (1, 0, 6, 0, 0)
    assert (r[1]["wom"], r[1]["dow"], r[1]["week"], r[1]["WeekDay"]) == (5, 1, 5, 1)


def test_ist_and_after_date(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 20, 0),)], "ts timestamp_ntz")
    r = df.select(X.ist("ts").alias("t"), X.after_date(F.to_date("ts"), "31/12/2023", "dd/MM/yyyy").alias("a")).first()
    assert r["t"] == dt.datetime(2024, 1, 2, 1, 30) and r["a"] is True
