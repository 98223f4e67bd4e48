"""Profiling statistics and small detectors."""

import datetime as dt

import pandas as pd

from salesguard.operators import stats as ST


def test_skew_kurt_match_pandas(spark):
    vals = [1.0, 2.0, 9.0, 4.0, 4.0, 7.0]
    df = spark.createDataFrame([(1, v) for v in vals], "k int, x double")
    r = ST.profile_stats(df, ["k"], "x").collect()[0]
    s = pd.Series(vals)
    assert abs(r["skew"] - s.skew()) < 1e-6 and abs(r["kurt"] - s.kurt()) < 1e-6
    assert abs(r["std"] - s.std()) < 1e-6 and r["median"] == s.median()


def test_dbscan_1d(spark):
    vals = [1, 2, 3, 10, 11, 12, 13, 30, 5]
    df = spark.createDataFrame([(1, v) for v in vals], "k int, x int")
    got = {r["x"]: r["dbscan_label"] for r in ST.dbscan_1d(df, ["k"], "x", eps=2, min_samples=3).collect()}
    assert got[1] == got[2] == got[3] == 0
    assert got[10] == got[13] == 1
    assert got[30] == -1 and got[5] == 0         # 5 is a border point of the first cluster (3 is core)


def test_evaluate_planted(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)], "p int, t int")
    r = ST.evaluate(df, "p", "t").collect()[0]
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (2, 1, 1, 1)
    assert r["precision"] == round(2 / 3, 6) and r["f1"] == round(2 / 3, 6)


def test_vote(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, None, 0), (1, 1, 1)], "a int, b int, c int")
    assert [r["vote_flag"] for r in ST.vote(df, ["a", "b", "c"], 2).collect()] == [1, 0, 1]
