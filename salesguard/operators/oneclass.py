"""One-class SVM on random Fourier features.

With z(x) = sqrt(2/D) cos(W x + b), whose products approximate the RBF kernel, the
objective is

    1/2 |w|^2 - rho + 1 / (nu n) * sum max(0, rho - w z_i)

For a given w the best rho is the nu-quantile of the scores w z_i, and a
subgradient is w minus the mean feature vector m of the nu share of rows scored
lowest. Moving w towards m by an exact line search is the Frank-Wolfe method on
the dual (m is the farthest feasible combination), and w (w - m) is the gap
between the objective and the dual value |w|^2 / 2, which is proof of how near the
optimum is: it stops at a share ``tol`` of it. A step is one pass for the quantile
of the scores and one for m; features are made in Arrow batches, never stored,
and only the D numbers of m come back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesguard.functions.scalar import flag
from salesguard.plans.materialize import materialize

ACCURACY, MOST_STEPS = 50_000, 2_000


def one_class_weights(n_in: int, n_features: int = 64, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The random directions and phases of the features, the same for every run
    (gamma = 1 / n_in on standardised features)."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2 / n_in), size=(n_features, n_in)), rng.uniform(0, 2 * math.pi, size=n_features)


def features(x: np.ndarray, centre: np.ndarray, spread: np.ndarray, directions: np.ndarray, phases: np.ndarray) -> np.ndarray:
    return np.cos((x - centre) / spread @ directions.T + phases) * math.sqrt(2.0 / len(phases))


def objective(z: np.ndarray, w: np.ndarray, nu: float) -> float:
    """The primal value of ``w`` with its best rho."""
    s = z @ w
    rho = np.sort(s)[math.ceil(nu * len(s)) - 1]
    return float(0.5 * w @ w - rho + np.maximum(0, rho - s).sum() / (nu * len(s)))


class Fit:
    """Passes over the rows, each with a given weight vector."""

    def __init__(self, df: DataFrame, feats: list[str], directions: np.ndarray, phases: np.ndarray):
        self.rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(feats)])
        r = self.rows.agg(*[F.avg(c).alias(f"a{c}") for c in self.rows.columns],
                          *[F.stddev_pop(c).alias(f"s{c}") for c in self.rows.columns]).first()
        self.centre = np.array([r[f"a{c}"] for c in self.rows.columns])
        self.spread = np.array([r[f"s{c}"] or 1.0 for c in self.rows.columns])
        self.directions, self.phases = directions, phases

    @property
    def z(self):
        """The features of a batch's columns, without the rows, for tasks to carry."""
        given = self.centre, self.spread, self.directions, self.phases
        return lambda columns: features(np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns]), *given)

    def cut(self, w: np.ndarray, nu: float) -> float:
        """The nu-quantile of the scores, which are rounded to 12 digits."""
        make = self.z

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(np.round(make(b.columns) @ w, 12))], ["s"])

        return self.rows.mapInArrow(run, "s double").agg(F.percentile_approx("s", nu, ACCURACY)).first()[0]

    def mean(self, w: np.ndarray | None, cut: float) -> np.ndarray:
        """Mean feature vector of the rows scored up to ``cut`` (without ``w``: of all)."""
        make, d = self.z, len(self.phases)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, n = np.zeros(d), 0
            for b in batches:
                z = make(b.columns)
                if w is not None:
                    z = z[np.round(z @ w, 12) <= cut]
                total, n = total + z.sum(0), n + len(z)
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64())), pa.array([n])], ["z", "n"])

        parts = self.rows.mapInArrow(run, "z array<double>, n long")        # one row for each task
        sums = parts.select("n", F.posexplode("z").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
        return np.array([r["v"] / r["n"] for r in sorted(sums.collect())])

    def solve(self, nu: float, tol: float) -> np.ndarray:
        w = self.mean(None, 0.0)
        for _ in range(MOST_STEPS):
            away = w - self.mean(w, self.cut(w, nu))
            gap = float(w @ away)
            if gap <= tol * 0.5 * float(w @ w):
                return w
            w = w - min(1.0, gap / float(away @ away)) * away
        raise RuntimeError(f"the one-class objective is not within {tol} after {MOST_STEPS} steps")


def one_class(df: DataFrame, feats: list[str], nu: float = 0.01, n_features: int = 64, seed: int = 42,
              tol: float = 0.01) -> DataFrame:
    """Adds ``oc_score`` (w z - rho, 12 digits) and ``oc_flag`` (score below 0: less than
    the ``nu`` share of the rows).

    Features are standardised first; a constant one counts as 0. The objective is
    within ``tol`` of the optimum. Rows with a null feature have no score. The
    input is read for every step, so it is written to the shared folder first. An
    empty input gives an empty result."""
    df = materialize(df)
    whole = df.dropna(subset=feats)
    if whole.isEmpty():
        return df.withColumn("oc_score", F.lit(None).cast("double")).withColumn("oc_flag", F.lit(0))
    fit = Fit(whole, feats, *one_class_weights(len(feats), n_features, seed))
    w = fit.solve(nu, tol)
    rho, make = fit.cut(w, nu), fit.z
    names, at = df.columns, [df.columns.index(c) for c in feats]
    schema = T.StructType(df.schema.fields + [T.StructField("oc_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [b.column(k).cast(pa.float64()) for k in at]
            there = np.all([c.is_valid().to_numpy(zero_copy_only=False) for c in x], axis=0)
            z = make([c.fill_null(0.0) for c in x])
            s = np.round(np.round(z @ w, 12) - rho, 12)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, mask=~there)], [*names, "oc_score"])

    return df.mapInArrow(run, schema).withColumn("oc_flag", flag(F.col("oc_score") < 0))
