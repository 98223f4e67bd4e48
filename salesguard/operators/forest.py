"""Isolation forest whose trees any engine can grow again.

Every tree draws its own ``max_samples`` rows, those with its smallest draws
(``draws``), at every size of the table. A node's split feature and threshold
are drawn from the MD5 of tree and node, so a tree is a recursion of minima and
maxima. Trees grow in tasks, each on its bounded sample; the nodes, at most
trees x (2 max_samples - 1), come to the driver, and all rows are scored in
Arrow batches.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesguard.functions.scalar import flag
from salesguard.operators.draws import PRIME, draw, key_text, named, pair
from salesguard.plans.materialize import materialize

NODES = "tree int, node int, feat int, thr double, size int, depth int"


def mean_path(n: float) -> float:
    """Average path length of an unsuccessful search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n


def grow(x: np.ndarray, seed: int, tree: int, limit: int) -> list[tuple]:
    """Nodes (tree, number, feature or -1, threshold, size, depth); node k has the children 2k and 2k + 1."""
    out, todo = [], [(1, np.arange(len(x)), 0)]
    while todo:
        node, rows, depth = todo.pop()
        feat, thr = -1, 0.0
        if depth < limit and len(rows) > 1:
            lo, hi = x[rows].min(0), x[rows].max(0)
            splits = np.flatnonzero(hi > lo)
            if len(splits):
                pick, u = named(seed, tree, node)
                feat = int(splits[pick % len(splits)])
                thr = float(lo[feat] + (hi[feat] - lo[feat]) * u)
                left = x[rows, feat] < thr
                todo += [(2 * node, rows[left], depth + 1), (2 * node + 1, rows[~left], depth + 1)]
        out.append((tree, node, feat, thr, len(rows), depth))
    return out


def samples(df: DataFrame, keys: list[str], feats: list[str], n: int, n_trees: int, m: int, seed: int) -> DataFrame:
    """``tree`` and ``feats``: each tree's m rows with the smallest draws. Rows equal in
    key and features count once in a tree. Only draws below twice the expected
    m-th are sorted, and rows are counted before that."""
    a, b = pair(F.concat(key_text(keys), F.lit(f"|{seed}")))
    below = PRIME if n <= 2 * m else min(PRIME, math.ceil(PRIME * max(2.0 * m, m + 60.0) / n))
    rows = df.select(key_text(keys).alias("_k"), a.alias("_a"), b.alias("_b"), *feats)
    tree = F.explode(F.filter(F.sequence(F.lit(0), F.lit(n_trees - 1)), lambda t: draw(F.col("_a"), F.col("_b"), t) < below))
    near = rows.select("*", tree.alias("tree")).withColumn("_u", draw(F.col("_a"), F.col("_b"), F.col("tree")))
    once = near.groupBy("tree", "_u", "_k", *feats).agg(F.count("*").alias("_n"))
    place = F.row_number().over(Window.partitionBy("tree").orderBy("_u", "_k", *feats))
    return once.withColumn("_r", place).where(F.col("_r") <= m).select("tree", *feats)


def isolation_forest(df: DataFrame, keys: list[str], feats: list[str], n_trees: int = 100, max_samples: int = 256,
                     contamination: float = 0.01, seed: int = 42) -> DataFrame:
    """Adds ``iforest_score`` (higher = more anomalous, 9 digits) and ``iforest_flag``.

    Rows with a null feature take no part in the trees and have no score. The
    input is read several times (count, sample, score, cut-off), so it is written
    to the shared folder first. An empty input has no score; a single row scores 0.5.
    """
    df = materialize(df)
    whole = df.dropna(subset=feats)
    n = whole.count()
    if n == 0:
        return df.withColumn("iforest_score", F.lit(None).cast("double")).withColumn("iforest_flag", F.lit(0))
    m = min(max_samples, n)
    limit = int(math.ceil(math.log2(max(m, 2))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = grow(pdf[feats].to_numpy(dtype=float), seed, int(pdf["tree"].iloc[0]), limit)
        return pd.DataFrame(rows, columns=["tree", "node", "feat", "thr", "size", "depth"])

    drawn = samples(whole, keys, feats, n, n_trees, m, seed)
    nodes = drawn.groupBy("tree").applyInPandas(build, NODES).toPandas()
    feat, thr = np.full((n_trees, 2 << limit), -1, np.int64), np.zeros((n_trees, 2 << limit))
    path = np.zeros((n_trees, 2 << limit))
    at = nodes["tree"].to_numpy(), nodes["node"].to_numpy()
    feat[at], thr[at] = nodes["feat"], nodes["thr"]
    path[at] = nodes["depth"] + nodes["size"].map(mean_path)
    grown = sorted(nodes["tree"].unique())
    # Trees see rows of distinct key and features, so a table of copies gives fewer than m rows to each.
    average = mean_path(int(nodes.loc[nodes["node"] == 1, "size"].max()))
    schema = T.StructType(df.schema.fields + [T.StructField("iforest_score", T.DoubleType())])

    def score(batches):
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=float, na_value=np.nan)
            total = np.zeros(len(x))
            rows = np.arange(len(x))
            for t in grown:
                node = np.ones(len(x), np.int64)
                for _ in range(limit):
                    f = feat[t, node]
                    node = np.where(f < 0, node, 2 * node + (x[rows, np.maximum(f, 0)] >= thr[t, node]))
                total += path[t, node]
            # One row isolates nothing: its score is that of an average row.
            s = np.round(np.power(2.0, -(total / len(grown)) / average), 9) if average else np.full(len(x), 0.5)
            yield pdf.assign(iforest_score=np.where(np.isnan(x).any(1), np.nan, s))

    scored = df.mapInPandas(score, schema).withColumn("iforest_score", F.nanvl("iforest_score", F.lit(None).cast("double")))
    scored = materialize(scored)                               # read by the cut-off and by the caller
    cut = scored.agg(F.percentile_approx("iforest_score", 1 - contamination, 10000)).first()[0]
    return scored.withColumn("iforest_flag", flag(F.col("iforest_score") >= F.lit(cut)))
