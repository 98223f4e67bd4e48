"""Gaussian mixture by expectation-maximisation in aggregates.

Rows are reduced to distinct points and their counts, written once. The start is
the settled k-means partition (``models``), so there is nothing random; each step
is one aggregation over the points, with the responsibilities as columns
(log-sum-exp), and only weights, means and covariances come back, rounded to 9
digits. It stops when the mean log-likelihood gains less than ``tol``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.operators.models import distinct_points, lloyd_frame, nearest

#: Added to the variances, as usual for mixtures.
FLOOR = 1e-6
Component = tuple[float, np.ndarray, np.ndarray]


def _log_density(feats: list[str], c: Component) -> Column:
    """ln(weight * density) at the point."""
    weight, mean, cov = c
    inv = np.linalg.inv(cov)
    d = [F.col(f"`{f}`") - float(m) for f, m in zip(feats, mean, strict=True)]
    q = F.lit(0.0)
    for i, x in enumerate(d):
        for j, y in enumerate(d):
            q = q + x * float(inv[i, j]) * y
    return F.lit(math.log(weight) - 0.5 * (len(feats) * math.log(2 * math.pi) + math.log(np.linalg.det(cov)))) - 0.5 * q


def _responsibilities(points: DataFrame, feats: list[str], parts: list[Component]) -> DataFrame:
    """Adds ``r0, r1, ..`` and ``ll``, the point's log-likelihood."""
    k = range(len(parts))
    df = points.withColumns({f"l{j}": _log_density(feats, parts[j]) for j in k})
    top = F.greatest(*[F.col(f"l{j}") for j in k]) if len(parts) > 1 else F.col("l0")
    df = df.withColumn("top", top)
    df = df.withColumn("ll", F.col("top") + F.ln(sum((F.exp(F.col(f"l{j}") - F.col("top")) for j in k), F.lit(0.0))))
    return df.withColumns({f"r{j}": F.exp(F.col(f"l{j}") - F.col("ll")) for j in k}).drop("top", *[f"l{j}" for j in k])


def _maximise(df: DataFrame, feats: list[str], k: int, before: list[Component] | None) -> tuple[list[Component], float]:
    """The components of points with responsibilities ``r*``, and the mean of ``ll``. One
    that nothing belongs to stays as it was."""
    p, aggs = len(feats), [F.sum("w").alias("n"), F.sum(F.col("w") * F.col("ll")).alias("ll")]
    for j in range(k):
        w = F.col("w") * F.col(f"r{j}")
        aggs.append(F.sum(w).alias(f"n{j}"))
        aggs += [F.sum(w * F.col(f"`{f}`")).alias(f"s{j}_{i}") for i, f in enumerate(feats)]
        aggs += [F.sum(w * F.col(f"`{feats[i]}`") * F.col(f"`{feats[m]}`")).alias(f"q{j}_{i}_{m}") for i in range(p) for m in range(i, p)]
    r = df.agg(*aggs).first()
    out = []
    for j in range(k):
        if r[f"n{j}"] < 1e-9 and before:
            out.append(before[j])
            continue
        n = max(r[f"n{j}"], 1e-9)
        mean = np.array([r[f"s{j}_{i}"] / n for i in range(p)])
        cov = np.array([[r[f"q{j}_{min(i, m)}_{max(i, m)}"] / n - mean[i] * mean[m] for m in range(p)] for i in range(p)])
        cov = np.round(np.where(np.eye(p, dtype=bool), np.maximum(cov, 0), cov), 9) + FLOOR * np.eye(p)
        out.append((round(n / r["n"], 9), np.round(mean, 9), cov))
    return out, r["ll"] / r["n"]


def fit(df: DataFrame, feats: list[str], k: int = 2, tol: float = 1e-4, most: int = 500) -> list[Component]:
    """Weight, mean and covariance of each component; empty for an empty input.
    Raises if ``most`` steps don't settle it."""
    points = distinct_points(df, feats)
    if points.isEmpty():
        return []
    label, _ = nearest(feats, lloyd_frame(points, feats, k))
    hard = points.withColumn("j", label).withColumns({f"r{j}": F.when(F.col("j") == j, 1.0).otherwise(0.0) for j in range(k)})
    parts, _ = _maximise(hard.withColumn("ll", F.lit(0.0)), feats, k, None)
    parts = [c for c in parts if c[0] > 0]                 # fewer distinct points than components
    last = -math.inf
    for _ in range(most):
        new, ll = _maximise(_responsibilities(points, feats, parts), feats, len(parts), parts)
        if ll - last < tol:
            return parts
        parts, last = new, ll
    raise RuntimeError(f"the mixture did not settle in {most} steps")


def gmm(df: DataFrame, feats: list[str], k: int = 2, tol: float = 1e-4) -> DataFrame:
    """Adds ``prediction`` (the likeliest component, ties to the first; components
    are numbered by their start, from low to high on the first feature) and
    ``probability``, the array of responsibilities. On the features, not on cluster
    ids (SURVEY Q12). Rows with a null feature have neither."""
    parts = fit(df, feats, k, tol)
    if not parts:
        return df.withColumn("prediction", F.lit(None).cast("int")).withColumn("probability", F.lit(None).cast("array<double>"))
    names = [f"x{i}" for i in range(len(feats))]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
                     *[F.col(f"`{f}`").cast("double").alias(x) for f, x in zip(feats, names, strict=True)])
    got = _responsibilities(rows, names, parts)
    r = F.array(*[F.col(f"r{j}") for j in range(len(parts))])
    has = F.col("ll").isNotNull()                          # null where a feature is
    top = F.array_position(r, F.array_max(r)) - 1
    return got.select("row.*", F.when(has, top.cast("int")).alias("prediction"), F.when(has, r).alias("probability"))
