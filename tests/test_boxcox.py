"""Maximum-likelihood Box-Cox (M1)."""

import math

import numpy as np
import pytest

from salesguard.operators import boxcox as B


def llf(x, lam):
    """The textbook formula, on values scaled by their geometric mean (which leaves the optimum)."""
    x = x / np.exp(np.log(x).mean())
    y = np.log(x) if lam == 0 else (x ** lam - 1) / lam
    return (lam - 1) * np.log(x).sum() - len(x) / 2 * math.log(y.var())


def rows(groups):
    return [(k, float(v)) for k, x in groups.items() for v in x]


def made():
    rng = np.random.default_rng(1)
    out = {k: np.round(rng.lognormal(2.0, 0.5, 50 + k)) + 1 for k in range(8)}
    out |= {20 + k: rng.integers(1, 40, 3 + k).astype(float) for k in range(8)}
    out[40] = (rng.normal(1.0, 0.05, 400) * 1e9) ** (1 / 9)          # x ** 9 is nearly symmetric
    out[41] = np.exp(rng.normal(0, 1, 300))                          # optimum near 0
    out[42] = rng.normal(1e6, 1.0, 200)                              # far from 0 against its spread
    return out


def test_lambda_is_the_optimum_of_every_key(spark):
    groups = made()
    df = spark.createDataFrame(rows(groups), "k int, v double").repartition(5)
    got = {r.k: r for r in B.boxcox_lambda(df, ["k"], "v").collect()}
    for k, x in groups.items():
        if k not in got:
            assert abs(B.optima(x, np.zeros(1, int))[0][0]) > 100 or np.isnan(B.optima(x, np.zeros(1, int))[0][0])
            continue
        lam = got[k].lam
        best = llf(x, lam)
        for step in (1e-6, 1e-4, 0.01, 0.3):
            assert best >= llf(x, lam - step) - 1e-9 * len(x) and best >= llf(x, lam + step) - 1e-9 * len(x)
        fine = max(llf(x, g) for g in np.linspace(lam - 2, lam + 2, 4001))
        assert best >= fine - 1e-6
        if k < 40:
            direct = (lam - 1) * np.log(x).sum() - len(x) / 2 * math.log(((x ** lam - 1) / lam).var())
            assert got[k].llf == pytest.approx(direct, abs=1e-6)
    assert abs(got[40].lam) > 5.6 and abs(got[41].lam) < 0.2


def test_whole_frame(spark):
    groups = made()
    x = np.concatenate([groups[k] for k in (0, 1, 2, 21, 22)])
    df = spark.createDataFrame(rows({1: x}) + [(1, None)], "k int, v double").repartition(4)
    whole, keyed = B.boxcox_lambda(df, [], "v").collect(), B.boxcox_lambda(df, ["k"], "v").first()
    assert len(whole) == 1 and whole[0].lam == pytest.approx(keyed.lam, abs=1e-9) and whole[0].llf == pytest.approx(keyed.llf, abs=1e-6)
    out = B.apply_boxcox(df, [], "v").collect()
    assert len(out) == len(x) + 1 and all(r.Sales == pytest.approx((r.v ** r.lam - 1) / r.lam, rel=1e-9) for r in out if r.v)
    for bad in ([], [(1, 3.0)], [(1, 3.0), (1, 3.0)], [(1, 0.0), (1, 2.0)], [(1, None)]):
        none = spark.createDataFrame(bad, "k int, v double")
        assert B.boxcox_lambda(none, [], "v").collect() == []
        assert all(r.Sales is None for r in B.apply_boxcox(none, [], "v").collect())


def test_constant_and_nonpositive_groups_have_no_lambda(spark):
    df = spark.createDataFrame([(1, 3.0), (1, 3.0), (2, 0.0), (2, 4.0), (3, 1.0), (3, 2.0), (3, None), (4, None), (None, 5.0), (None, 7.0),
                                (None, 8.5)], "k int, v double")
    got = {r["k"]: r.lam for r in B.boxcox_lambda(df, ["k"], "v").collect()}
    assert set(got) == {3, None}
    same = {(r.k, r.v): r.Sales for r in B.apply_boxcox(df, ["k"], "v").collect()}
    assert same[3, None] is None and same[1, 3.0] is None and same[None, 5.0] is not None


def test_transform_is_monotone(spark):
    df = spark.createDataFrame([(1, float(v)) for v in (1, 2, 3, 5, 8, 13, 21)], "k int, v double")
    t = sorted((r["v"], r["Sales"]) for r in B.apply_boxcox(df, ["k"], "v").collect())
    ys = [y for _, y in t]
    assert ys == sorted(ys)


def test_an_open_end_is_not_clamped(spark):
    df = spark.createDataFrame([(2, math.e)] * 1000 + [(2, 1.0)], "k int, v double")
    assert B.boxcox_lambda(df, ["k"], "v").collect() == [] == B.boxcox_lambda(df, [], "v").collect()


def test_keys_over_many_batches(spark):
    """A key whose rows span Arrow batches is still one."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        groups = made()
        df = spark.createDataFrame(rows(groups), "k int, v double").repartition(3)
        got = {r.k: r.lam for r in B.boxcox_lambda(df, ["k"], "v").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, x in groups.items():
        lam = B.optima(np.sort(x), np.zeros(1, int))[0][0]
        assert np.isnan(lam) and k not in got or got[k] == pytest.approx(lam, abs=1e-9)
