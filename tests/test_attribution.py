"""Attribution rules on literal report rows (ties on >=, NULL handling)."""

import datetime as dt

from salesguard.operators import attribution as A

SCHEMA = "date_ date, city_name string, facility_id int, item_id int, p_type string, sales_quantity int, outlier_flag int"


def rows(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def test_hfs_tie_and_missing_side(spark):
    d1, d10, d11 = dt.date(2024, 1, 1), dt.date(2024, 1, 10), dt.date(2024, 1, 11)
    df = rows(spark, [
        (d1, "C", 1, 1, "T0", 20, 1), (d10, "C", 1, 1, "T0", 10, 0), (d11, "C", 1, 1, "T0", 10, 0),
        (d1, "C", 1, 2, "T0", 50, 1),                                   # no non-start-of-month day -> 0
    ])
    got = {(r["item_id"], r["date_"]): r["hfs_flag"] for r in A.hfs_flag(df).collect()}
    assert got[(1, d1)] == 1          # 20 >= (20/10)*10: equality counts
    assert got[(2, d1)] == 0


def test_event_flag_threshold_and_null_type(spark):
    d = [dt.date(2024, 1, k) for k in (1, 2, 3, 4)]
    df = rows(spark, [(d[0], "C", 1, 1, "T0", 15, 1), (d[1], "C", 1, 1, "T0", 5, 0),
                      (d[2], "C", 1, 1, "T0", 10, 0), (d[3], "C", 1, 1, None, 99, 1)])
    cal = spark.createDataFrame([(d[1], "X"), (d[1], "Y")], "event_date date, event_name string")
    got = {r["date_"]: r["event_flag"] for r in A.event_flag(df, cal).collect()}
    assert got[d[0]] == 1             # 15 >= 1.5 * mean(15, 5, 10) = 15
    assert got[d[3]] == 0             # NULL type: no type-day mean
    strict = {r["date_"]: r["event_flag"] for r in A.event_flag(df, cal, require_event=True).collect()}
    assert strict[d[0]] == 0          # not an event date


def test_cannibalization_needs_outlier(spark):
    d = dt.date(2024, 1, 1)
    df = rows(spark, [(d, "C", 1, 1, "T0", 30, 0), (d, "C", 1, 2, "T0", 10, 1),
                      (dt.date(2024, 1, 2), "C", 1, 2, "T0", 2, 0)])
    got = {(r["item_id"], r["date_"]): r["cannibalization_flag"] for r in A.cannibalization_flag(df).collect()}
    assert got[(1, d)] == 0


def test_report_flags_imply_outlier(spark):
    import __spark_entry__ as E
    from conftest import SF001
    rep = E.queries()["attribution_report"](spark, SF001)
    cols = ["event_flag", "seasonality_flag", "hfs_flag", "bulk_buying_flag", "surge_flag", "cannibalization_flag"]
    bad = rep.filter("outlier_flag = 0 AND (" + " OR ".join(f"{c} = 1" for c in cols) + ")").count()
    assert bad == 0
