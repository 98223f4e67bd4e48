"""M1/M2: maximum-likelihood Box-Cox transform, per key and of a whole frame.

The profile log-likelihood of Box and Cox (1964) for positive x is, with
z = ln x - mean(ln x),

    llf(l) = -n mean(ln x) - n/2 ln var_pop(y),   y = (e^(l z) - 1) / l

so powers of x never overflow. It is evaluated on a coarse grid, [-5, 5] in steps
of 0.5 and +-10, 20, .. 160 beyond (ties, rounded to 6 digits, go to the smaller
lambda). Between the neighbours of the best point the likelihood rises where
cov(y, dy/dl) is negative, and its zero is bisected until nothing is left to
halve. A key whose likelihood still rises at the last point has no optimum, and
one whose transform would overflow has none that can be used; these, constant
keys and keys with values that are not positive get no lambda (the reference
raises there) and are reported.

Per key, all keys of an Arrow batch are searched side by side in numpy, after one
exchange by key. A whole frame (``keys=[]``) is first counted by distinct value;
each step is then one aggregation for a row of lambdas, and only their moments
come back.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesguard.operators.keyed import add_per_key, by_keys, numbers, one_per_key
from salesguard.plans.materialize import materialize

COARSE = sorted([k * 0.5 for k in range(-10, 11)] + [s * 10.0 * 2 ** j for j in range(5) for s in (-1, 1)])
HALVINGS = 60
#: Lambdas of one aggregation over a whole frame.
SECTIONS = 64
ZERO = 1e-9                          # a lambda nearer to 0 is 0
LARGEST = 690.0                      # |lambda ln x| beyond which x^lambda leaves the doubles


class Groups:
    """Positive values of many keys, one key's after the other's."""

    def __init__(self, x: np.ndarray, starts: np.ndarray):
        self.starts, self.n = starts, np.diff(np.r_[starts, len(x)]).astype(np.float64)
        self.of = np.repeat(np.arange(len(starts)), self.n.astype(np.int64))
        ln = np.log(x)
        self.mean = self.sum(ln) / self.n
        self.z = ln - self.mean[self.of]
        self.span = np.maximum.reduceat(np.abs(self.z), starts)
        self.reach = np.maximum.reduceat(np.abs(ln), starts)

    def sum(self, x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, self.starts)

    def _y(self, lam: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """y for each value (times e^-top where lambda is large), u, the keys with a small lambda, and top."""
        u = lam[self.of] * self.z
        near = np.abs(lam) * self.span < 1
        top = np.where(near, 0.0, np.maximum.reduceat(u, self.starts))
        tiny = np.abs(u) < 0.05
        v = np.where(tiny, 1.0, np.minimum(u, 1.0))
        growth = np.where(tiny, 1 + u / 2 + u ** 2 / 6 + u ** 3 / 24 + u ** 4 / 120 + u ** 5 / 720 + u ** 6 / 5040, np.expm1(v) / v)
        return np.where(near[self.of], self.z * growth, np.exp(u - top[self.of]) / np.where(near, 1.0, lam)[self.of]), u, near, top

    def llf(self, lam: np.ndarray) -> np.ndarray:
        """Log-likelihood at one lambda for each key."""
        y, _, _, top = self._y(lam)
        var = self.sum((y - (self.sum(y) / self.n)[self.of]) ** 2) / self.n
        with np.errstate(divide="ignore"):
            return self.n * (-top - 0.5 * np.log(var) - self.mean)

    def rises(self, lam: np.ndarray) -> np.ndarray:
        """Whether the likelihood rises at lambda: cov(y, dy/dl) < 0, both up to positive factors."""
        y, u, near, top = self._y(lam)
        tiny = np.abs(u) < 0.05
        v = np.where(tiny, 1.0, np.minimum(u, 1.0))
        slope = np.where(tiny, 1 / 2 + u / 3 + u ** 2 / 8 + u ** 3 / 30 + u ** 4 / 144 + u ** 5 / 840 + u ** 6 / 5760,
                         (v * np.exp(v) - np.expm1(v)) / v ** 2)
        safe = np.where(near, 1.0, lam)[self.of]
        dy = np.where(near[self.of], self.z ** 2 * slope, (u - 1) * np.exp(u - top[self.of]) / safe ** 2)
        return self.sum((y - (self.sum(y) / self.n)[self.of]) * (dy - (self.sum(dy) / self.n)[self.of])) < 0


def optima(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lambda and log-likelihood of each key (NaN where there is none) of the
    values ``x``, whose keys begin at ``starts``. NaN are missing values."""
    lam, llf = np.full(len(starts), np.nan), np.full(len(starts), np.nan)
    if not len(x):
        return lam, llf
    if np.isnan(x).any():
        there = np.add.reduceat(~np.isnan(x), starts, dtype=np.int64)
        some = there > 0
        if some.any():
            lam[some], llf[some] = optima(x[~np.isnan(x)], np.cumsum(there[some]) - there[some])
        return lam, llf
    low, high = np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts)
    fit = (low > 0) & (high > low) & np.isfinite(high)
    if not fit.any():
        return lam, llf
    size = np.diff(np.r_[starts, len(x)])
    g = Groups(x[np.repeat(fit, size)], (np.cumsum(size[fit]) - size[fit]))
    grid = np.round(np.array([g.llf(np.full(len(g.n), c)) for c in COARSE]), 6)
    best = np.argmax(grid, axis=0)                       # the first, so the smallest lambda
    inner = (best > 0) & (best < len(COARSE) - 1)
    points = np.array(COARSE)
    lo, hi = points[np.maximum(best - 1, 0)], points[np.minimum(best + 1, len(points) - 1)]
    for _ in range(HALVINGS):
        mid = (lo + hi) / 2
        up = g.rises(mid)
        lo, hi = np.where(up, mid, lo), np.where(up, hi, mid)
    found = (lo + hi) / 2
    found = np.where(np.abs(found) < ZERO, 0.0, found)
    ok = inner & (np.abs(found) * g.reach < LARGEST)
    lam[fit] = np.where(ok, found, np.nan)
    llf[fit] = np.where(ok, g.llf(found), np.nan)
    return lam, llf


def transform(x: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """Box-Cox transform by each value's lambda (NaN stays NaN)."""
    with np.errstate(all="ignore"):
        ln = np.log(x)
        safe = np.where(lam == 0, 1.0, lam)
        return np.where(lam == 0, ln, np.expm1(safe * ln) / safe)


def _null_nan(x: np.ndarray) -> pa.Array:
    return pa.array(x, pa.float64(), mask=np.isnan(x))


def boxcox_lambda(df: DataFrame, keys: list[str], x: str = "sales_quantity", partitioned: bool = False) -> DataFrame:
    """One row per transformable group: keys, lam, llf; ``keys=[]`` takes the whole frame.

    ``partitioned=True`` declares ``df`` already hash-partitioned by ``keys``. Rows
    without a value are left out."""
    src = df.select(*keys, F.col(x).cast("double").alias("_x")).where("_x is not null")
    if not keys:
        found = whole_frame(src, "_x")
        return df.sparkSession.createDataFrame([found] if found else [], "lam double, llf double")

    def fn(table: pa.Table, starts: np.ndarray) -> list[pa.Array]:
        return [_null_nan(c) for c in optima(numbers(table, "_x"), starts)]

    add = [T.StructField("lam", T.DoubleType()), T.StructField("llf", T.DoubleType())]
    return one_per_key(src if partitioned else by_keys(src, keys), keys, [], add, fn)


def _moments(points: DataFrame, lams: list[float], mean: float, low: float, high: float, n: float) -> list[tuple[float, float]]:
    """For each lambda the log-likelihood and cov(y, dy/dl), up to a positive factor, by one aggregation."""
    span = max(high - mean, mean - low)
    lam, z = F.col("lam"), F.col("z")
    u = lam * z
    top = F.greatest(lam * (low - mean), lam * (high - mean))
    near = F.abs(lam) * span < 1
    v = F.when(F.abs(u) < 0.05, 1.0).otherwise(u)
    growth = F.when(F.abs(u) < 0.05, _poly(u, [1, 2, 6, 24, 120, 720, 5040])).otherwise(F.expm1(v) / v)
    slope = F.when(F.abs(u) < 0.05, _poly(u, [2, 3, 8, 30, 144, 840, 5760])).otherwise((v * F.exp(v) - F.expm1(v)) / (v * v))
    e = F.exp(u - top)
    y, dy = F.when(near, z * growth).otherwise(e / lam), F.when(near, z * z * slope).otherwise((u - 1) * e / (lam * lam))
    rows = (points.withColumn("lam", F.explode(F.array(*[F.lit(float(x)) for x in lams]))).withColumns({"y": y, "dy": dy})
            .groupBy("lam").agg(*[F.sum(F.col("c") * c).alias(a) for a, c in
                                  (("s", F.col("y")), ("t", F.col("dy")), ("ss", F.col("y") ** 2), ("st", F.col("y") * F.col("dy")))])
            .collect())
    out = {}
    for r in rows:
        var = r["ss"] / n - (r["s"] / n) ** 2
        shift = 0.0 if abs(r["lam"]) * span < 1 else max(r["lam"] * (low - mean), r["lam"] * (high - mean))
        llf = n * (-shift - 0.5 * math.log(var) - mean) if var > 0 else -math.inf
        out[r["lam"]] = llf, r["st"] / n - r["s"] * r["t"] / n / n
    return [out[float(x)] for x in lams]


def _poly(u: Column, divisors: list[int]) -> Column:
    out = F.lit(0.0)
    for d in reversed(divisors):
        out = out * u + 1.0 / d
    return out


def whole_frame(df: DataFrame, x: str) -> tuple[float, float] | None:
    """Lambda and log-likelihood of one column, or None. About a dozen passes over
    its distinct values and their counts."""
    points = materialize(df.where(F.col(x).isNotNull()).groupBy(F.col(x).alias("x")).agg(F.count("*").cast("double").alias("c")))
    ln = F.ln("x")
    r = points.agg(F.sum("c").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if not r["n"] or r["lo"] <= 0 or r["hi"] <= r["lo"] or math.isinf(r["hi"]):
        return None
    n, low, high = r["n"], math.log(r["lo"]), math.log(r["hi"])
    mean = points.agg(F.sum(F.col("c") * ln)).first()[0] / n
    points = points.select((ln - F.lit(mean)).alias("z"), "c")
    grid = [round(a, 6) for a, _ in _moments(points, COARSE, mean, low, high, n)]
    best = grid.index(max(grid))
    if best in (0, len(COARSE) - 1):
        return None
    lo, hi = COARSE[best - 1], COARSE[best + 1]
    while True:
        inner = sorted({lo + (hi - lo) * k / SECTIONS for k in range(1, SECTIONS)} - {lo, hi})
        if hi - lo <= 1e-13 * max(1.0, abs(lo)) or not inner:
            break
        rising = [cov < 0 for _, cov in _moments(points, inner, mean, low, high, n)]
        k = rising.index(False) if False in rising else len(inner)
        lo, hi = ([lo] + inner)[k], (inner + [hi])[k]
    lam = (lo + hi) / 2
    lam = 0.0 if abs(lam) < ZERO else lam
    if abs(lam) * max(abs(low), abs(high)) >= LARGEST:
        return None
    return lam, _moments(points, [lam], mean, low, high, n)[0][0]


def apply_boxcox(df: DataFrame, keys: list[str], x: str = "sales_quantity", out: str = "Sales",
                 partitioned: bool = False) -> DataFrame:
    """Add the transformed value ``out`` (NULL for non-transformable groups) and ``lam``;
    ``keys=[]`` transforms the whole frame by one lambda."""
    add = [T.StructField("lam", T.DoubleType()), T.StructField(out, T.DoubleType())]
    if not keys:
        found = whole_frame(df.select(F.col(x).cast("double").alias("_x")), "_x")
        lam = F.lit(found[0] if found else None).cast("double")
        ln = F.ln(F.col(x).cast("double"))
        return df.withColumns({"lam": lam, out: F.when(lam == 0, ln).otherwise(F.expm1(lam * ln) / lam)})

    def fn(table: pa.Table, starts: np.ndarray) -> list[pa.Array]:
        v = numbers(table, x)
        lam = np.repeat(optima(v, starts)[0], np.diff(np.r_[starts, len(v)]))
        return [_null_nan(lam), _null_nan(transform(v, lam))]

    return add_per_key(df if partitioned else by_keys(df, keys), keys, [], add, fn)
