"""Robust covariance by FAST-MCD, and the elliptic envelope over it.

Rousseeuw and Van Driessen (1999): many small starts, two concentration steps
each, the ten best carried on, the one with the least determinant to the end.
Starts are p + 1 rows with the smallest draws (``draws``) among a sample of
bounded size, where also their two steps run, in tasks; the ten best then take
two steps over all rows, and the best of these goes on until it stays. A step
over all rows is one aggregation for the h-th smallest distance of every
candidate and one for their moments; only means and covariances come back.

The estimate is made consistent with normal data by its median distance, and
estimated again from the rows within the 97.5 % ellipsoid. Distances are compared
rounded to 9 digits, so rows at the edge are in or out in any engine.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.functions.scalar import flag
from salesguard.operators.draws import PRIME, draw, key_text, pair
from salesguard.plans.materialize import materialize

STARTS, SAMPLE, KEPT, FIRST_STEPS, MOST_STEPS = 200, 1500, 10, 2, 100
#: Share of the overall variances that is added to a covariance before it is inverted.
RIDGE = 1e-6
WITHIN = 0.975
#: Rank error of the quantiles over all rows; smaller tables are exact.
ACCURACY = 50_000


def chi2_quantile(q: float, p: int) -> float:
    """Quantile of the chi-square distribution, by bisection of its series."""
    def cdf(x: float) -> float:
        a, half = p / 2, x / 2
        if half <= 0:
            return 0.0
        term = total = 1 / a
        n = 0
        while term > 1e-17 * total:
            n += 1
            term *= half / (a + n)
            total += term
        return total * math.exp(a * math.log(half) - half - math.lgamma(a))

    lo, hi = 0.0, 1.0
    while cdf(hi) < q:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if cdf(mid) < q else (lo, mid)
    return (lo + hi) / 2


def half_of(n: int, p: int) -> int:
    return min(n, (n + p + 1) // 2)


def inverse(cov: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Inverse of a covariance with a little of the overall variances ``scale`` added."""
    return np.linalg.inv(cov + np.diag(RIDGE * np.where(scale > 0, scale, 1.0)))


def distances(x: np.ndarray, mean: np.ndarray, inv: np.ndarray) -> np.ndarray:
    d = x - mean
    return np.round(np.einsum("ij,jk,ik->i", d, inv, d), 9)


def concentrate(x: np.ndarray, mean: np.ndarray, cov: np.ndarray, scale: np.ndarray, h: int) -> tuple[np.ndarray, np.ndarray]:
    """One step: moments of the rows no further than the h-th."""
    d = distances(x, mean, inverse(cov, scale))
    inside = x[d <= np.partition(d, h - 1)[h - 1]]
    return inside.mean(0), np.cov(inside.T, bias=True).reshape(x.shape[1], -1)


def candidates(x: np.ndarray, a: np.ndarray, b: np.ndarray, starts: np.ndarray, scale: np.ndarray) -> list[tuple]:
    """(determinant, start, mean, covariance) after the first steps on the sample."""
    n, p = x.shape
    out = []
    for s in starts:
        u = (a + (int(s) + 1) * b) % PRIME
        rows = np.lexsort((np.arange(n), u))[:p + 1]
        mean, cov = x[rows].mean(0), np.cov(x[rows].T, bias=True).reshape(p, -1)
        for _ in range(FIRST_STEPS):
            mean, cov = concentrate(x, mean, cov, scale, half_of(n, p))
        out.append((round(float(np.linalg.det(cov)), 9), int(s), mean, cov))
    return out


def _distance(feats: list[str], mean: np.ndarray, inv: np.ndarray) -> Column:
    d = [F.col(f"`{c}`").cast("double") - float(m) for c, m in zip(feats, mean, strict=True)]
    total = F.lit(0.0)
    for i, x in enumerate(d):
        for j, y in enumerate(d):
            total = total + x * float(inv[i, j]) * y
    return total


def _moments(df: DataFrame, feats: list[str], wheres: list[Column | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and covariance of the rows where each condition holds, by one aggregation;
    to 12 digits, so that the order of summation does not show."""
    p, aggs = len(feats), []
    for k, w in enumerate(wheres):
        at = (lambda c: c) if w is None else (lambda c, w=w: F.when(w, c))
        aggs += [F.avg(at(F.col(f"`{c}`"))).alias(f"m{k}_{i}") for i, c in enumerate(feats)]
        aggs += [F.covar_pop(at(F.col(f"`{feats[i]}`")), at(F.col(f"`{feats[j]}`"))).alias(f"c{k}_{i}_{j}")
                 for i in range(p) for j in range(i, p)]
    r = df.agg(*aggs).first()
    out = []
    for k in range(len(wheres)):
        cov = np.array([[float(f"{r[f'c{k}_{min(i, j)}_{max(i, j)}']:.12g}") for j in range(p)] for i in range(p)])
        out.append((np.array([float(f"{r[f'm{k}_{i}']:.12g}") for i in range(p)]), cov))
    return out


def _steps(df: DataFrame, feats: list[str], kept: list[tuple[np.ndarray, np.ndarray]], scale: np.ndarray, share: float):
    """One concentration step of every candidate over all rows."""
    d = [F.round(_distance(feats, mean, inverse(cov, scale)), 9) for mean, cov in kept]
    cut = df.agg(*[F.percentile_approx(x, share, ACCURACY).alias(f"q{k}") for k, x in enumerate(d)]).first()
    return _moments(df, feats, [x <= F.lit(cut[k]) for k, x in enumerate(d)])


def robust_moments(df: DataFrame, keys: list[str], feats: list[str], n: int, starts: int = STARTS, sample: int = SAMPLE,
                   seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and covariance of the MCD over all ``n`` rows, and the overall variances.
    Raises if the last candidate doesn't settle."""
    p = len(feats)
    (_, whole), = _moments(df, feats, [None])
    scale = np.diag(whole)
    a, b = pair(F.concat(key_text(keys), F.lit(f"|{seed}")))
    few = (df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(feats)], key_text(keys).alias("_k"),
                     a.alias("_a"), b.alias("_b")).orderBy("_a", "_k", *[f"x{i}" for i in range(p)]).limit(sample).toPandas())
    few = few.sort_values(["_k", *[f"x{i}" for i in range(p)]])
    x, ka, kb = few[[f"x{i}" for i in range(p)]].to_numpy(float), few["_a"].to_numpy(np.int64), few["_b"].to_numpy(np.int64)

    def run(batches):
        for pdf in batches:
            rows = [(d, s, m.tolist(), c.ravel().tolist()) for d, s, m, c in candidates(x, ka, kb, pdf["id"].to_numpy(), scale)]
            yield pd.DataFrame(rows, columns=["det", "start", "mean", "cov"])

    spark = df.sparkSession
    best = (spark.range(starts).mapInPandas(run, "det double, start int, mean array<double>, cov array<double>")
            .orderBy("det", "start").limit(KEPT).collect())
    kept = [(np.array(r["mean"]), np.array(r["cov"]).reshape(p, p)) for r in best]
    share = (half_of(n, p) - 0.5) / n                      # the h-th smallest, whatever the division rounds to
    for _ in range(FIRST_STEPS):
        kept = _steps(df, feats, kept, scale, share)
    mean, cov = min(kept, key=lambda c: round(float(np.linalg.det(c[1])), 9))
    for _ in range(MOST_STEPS):
        (new_mean, new_cov), = _steps(df, feats, [(mean, cov)], scale, share)
        stays = np.allclose(new_mean, mean, rtol=1e-9, atol=1e-12) and np.allclose(new_cov, cov, rtol=1e-9, atol=1e-12)
        mean, cov = new_mean, new_cov
        if stays:
            return mean, cov, scale
    raise RuntimeError(f"the robust covariance did not settle in {MOST_STEPS} steps")


def elliptic_envelope(df: DataFrame, keys: list[str], feats: list[str], contamination: float = 0.01, starts: int = STARTS,
                      sample: int = SAMPLE, seed: int = 42) -> DataFrame:
    """Adds ``robust_distance`` (squared) and ``envelope_flag`` for the ``contamination``
    share of rows furthest out.

    ``keys`` name a row for the draws; of rows that repeat a key those with the
    smaller features come first. Rows with a null feature have no distance. The
    table is written once and read for each step. An empty input gives an empty result."""
    df = materialize(df)
    whole = df.dropna(subset=feats)
    n = whole.count()
    if n == 0:
        return df.withColumn("robust_distance", F.lit(None).cast("double")).withColumn("envelope_flag", F.lit(0))
    p = len(feats)
    mean, cov, scale = robust_moments(whole, keys, feats, n, starts, sample, seed)
    d = F.round(_distance(feats, mean, inverse(cov, scale)), 9)
    middle = whole.agg(F.percentile_approx(d, 0.5, ACCURACY)).first()[0]
    ratio = middle / chi2_quantile(0.5, p) or 1.0
    (mean, cov), = _moments(whole, feats, [d / F.lit(ratio) < F.lit(chi2_quantile(WITHIN, p))])
    scored = df.withColumn("robust_distance", F.round(_distance(feats, mean, inverse(cov, scale)), 9))
    cut = scored.agg(F.percentile_approx("robust_distance", 1 - contamination, ACCURACY)).first()[0]
    return scored.withColumn("envelope_flag", flag(F.col("robust_distance") > F.lit(cut)))
