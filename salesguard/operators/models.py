"""K-means detectors (M6, M12, M13) and what other models start from.

The reference fits scikit-learn models on one in-memory frame. Here a fit is a
Spark job: grouped ``applyInPandas`` on bounded per-key groups (2-D
three-means), and plain aggregations iterated from the driver with only the
centres as state. Mixture, forest, envelope and one-class machine have modules
of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesguard.functions.scalar import flag
from salesguard.operators.segments import ranked_three_means
from salesguard.plans.materialize import materialize

# ------------------------------------------------------------------ M6
def _kmeans2d_fn(keys: list[str], feats: list[str]):
    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(feats)
        clusters = ranked_three_means(pdf[feats].to_numpy(dtype=float), pdf["w"].to_numpy(dtype=float))
        if clusters is None:
            return pdf[keys + feats].assign(cluster=pd.Series([None] * len(pdf), dtype="Int32"))
        return pdf[keys + feats].assign(cluster=clusters)
    return fn


def kmeans_2d(df: DataFrame, keys: list[str], feats: list[str]) -> DataFrame:
    """M6: per-key three-means on several features (e.g. transformed sales, workday flag).

    Rows are reduced to a weighted histogram of distinct feature vectors per
    key (bounded by days), then clustered per key: Lloyd's iteration from the
    exact cuts of the first feature, run until it settles, without random
    restarts. Clusters are ranked by mean of the first feature (1 = lowest).
    Flag = lowest or highest cluster. Fewer than three distinct points: no cluster.
    """
    hist = df.groupBy(*keys, *feats).agg(F.count(F.lit(1)).alias("w"))
    schema = T.StructType([df.schema[c] for c in keys + feats] + [T.StructField("cluster", T.IntegerType())])
    lab = hist.groupBy(*keys).applyInPandas(_kmeans2d_fn(keys, feats), schema)
    return (df.join(lab, keys + feats, "left")
              .withColumn("kmeans_flag", flag(F.col("cluster").isin(1, 3))))


# ------------------------------------------------------------------ M12, M13
LLOYD_STEPS = 1000


def nearest(feats: list[str], centres: list[list[float]]):
    """(cluster number, squared distance) columns of the nearest centre, ties to the lower number."""
    d = [F.round(sum(((F.col(f) - float(c[i])) * (F.col(f) - float(c[i])) for i, f in enumerate(feats)), F.lit(0.0)), 9)
         for c in centres]
    least = F.least(*d) if len(d) > 1 else d[0]
    label = F.lit(len(d) - 1)
    for j in reversed(range(len(d) - 1)):
        label = F.when(d[j] == least, j).otherwise(label)
    return label, least


def lloyd_frame(points: DataFrame, feats: list[str], k: int) -> list[list[float]]:
    """Centres of Lloyd's iteration over all weighted points (columns ``feats``, ``w``).

    Starts at the middles of k equal spans of the first feature (means of the
    others); each step is one aggregation, of which only the k centres come
    back. Runs until the centres, rounded to 9 digits, stay; raises if they
    don't within ``LLOYD_STEPS``. An emptied cluster keeps its centre.
    """
    f0 = feats[0]
    r = points.agg(F.min(f0).alias("lo"), F.max(f0).alias("hi"),
                   *[F.round(F.sum(F.col(f) * F.col("w")) / F.sum("w"), 9).alias(f"m{i}") for i, f in enumerate(feats)]).first()
    centres = [[round(r["lo"] + (r["hi"] - r["lo"]) * (j + 0.5) / k, 9), *(r[f"m{i}"] for i in range(1, len(feats)))]
               for j in range(k)]
    for _ in range(LLOYD_STEPS):
        label, _d = nearest(feats, centres)
        inside = [F.when(F.col("j") == j, F.col("w")) for j in range(k)]
        got = points.withColumn("j", label).agg(
            *[F.round(F.sum(F.col(f) * x) / F.sum(x), 9) for x in inside for f in feats]).first()
        means = [list(got[j * len(feats):(j + 1) * len(feats)]) for j in range(k)]
        new = [c if m[0] is None else m for c, m in zip(centres, means, strict=True)]
        if new == centres:
            return centres
        centres = new
    raise RuntimeError(f"k-means not settled after {LLOYD_STEPS} steps")


def distinct_points(df: DataFrame, feats: list[str]) -> DataFrame:
    """Distinct points without nulls, with their weight; written once, for the steps to read."""
    named = df.select(*[F.col(f).cast("double").alias(f) for f in feats]).dropna()
    return materialize(named.groupBy(*feats).agg(F.count(F.lit(1)).cast("double").alias("w")))


def kmeans_elbow(df: DataFrame, feats: list[str], ks=range(1, 6)) -> DataFrame:
    """Score (minus within-cluster sum of squares) per k. No row for an empty input."""
    points, rows = distinct_points(df, feats), []
    if not points.isEmpty():
        for k in ks:
            _, d = nearest(feats, lloyd_frame(points, feats, k))
            rows.append((int(k), -float(points.agg(F.sum(d * F.col("w"))).first()[0])))
    return df.sparkSession.createDataFrame(rows, "k int, score double")


#: Points of a block; a tile of two blocks is one task's distance matrix.
BLOCK = 2048


def _tiles(feats: list[str], k: int):
    """Sums of distances from each point of two blocks to the other block's clusters."""
    names, p = [*[f"f{i}" for i in range(len(feats))], "j", "w"], len(feats)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                near, far = (np.array([[*x.values()] for x in r[side]], float) for side in ("near", "far"))
                d = np.sqrt(((near[:, None, :p] - far[None, :, :p]) ** 2).sum(-1))
                sides = [(near, far, d)] if r["block"] == r["other"] else [(near, far, d), (far, near, d.T)]
                for rows, cols, dist in sides:
                    weight = np.zeros((len(cols), k))
                    weight[np.arange(len(cols)), cols[:, p].astype(int)] = cols[:, p + 1]
                    sums = dist @ weight
                    yield pa.RecordBatch.from_arrays(
                        [*[pa.array(rows[:, i]) for i in range(p)], pa.array(rows[:, p].astype(np.int32)), pa.array(rows[:, p + 1]),
                         *[pa.array(sums[:, c]) for c in range(k)]], names + [f"s{c}" for c in range(k)])

    schema = ", ".join([*[f"f{i} double" for i in range(p)], "j int", "w double", *[f"s{c} double" for c in range(k)]])
    return run, schema


def silhouette(df: DataFrame, feats: list[str], k: int = 3, block: int = BLOCK) -> DataFrame:
    """Mean silhouette of the k-means clusters, with Euclidean distances.

    Distinct points, with their weights, are dealt to blocks of about ``block``;
    every two blocks meet in one tile, which gives each of their points its summed
    distances to the other block's clusters, one row a point. The work is that of
    all distances, as the measure asks; a tile holds block x block of them. A point
    alone in its cluster counts 0, and so does every point if there is one
    cluster only; no row for an empty input."""
    points = distinct_points(df, feats)
    n = points.count()
    if not n:
        return df.sparkSession.createDataFrame([], "k int, silhouette double")
    label, _ = nearest(feats, lloyd_frame(points, feats, k))
    blocks = math.ceil(n / block)
    dealt = points.select(F.pmod(F.xxhash64(*feats), F.lit(blocks)).cast("int").alias("block"),
                          F.struct(*[F.col(f"`{f}`").alias(f"f{i}") for i, f in enumerate(feats)], label.cast("double").alias("j"), "w").alias("x"))
    packed = materialize(dealt.groupBy("block").agg(F.collect_list("x").alias("near")))
    meets = packed.withColumn("other", F.explode(F.sequence("block", F.lit(blocks - 1))))
    pairs = meets.join(packed.select(F.col("block").alias("other"), F.col("near").alias("far")), "other")
    run, schema = _tiles(feats, k)
    tiles = pairs.select("block", "other", "near", "far").repartition("block", "other").mapInArrow(run, schema)
    place = [f"f{i}" for i in range(len(feats))]
    sums = materialize(tiles.groupBy(*place, "j", "w").agg(*[F.sum(f"s{c}").alias(f"s{c}") for c in range(k)]))
    size = {r["j"]: r["n"] for r in sums.groupBy("j").agg(F.sum("w").alias("n")).collect()}
    worth = F.lit(0.0)
    for j, m in size.items():
        others = [F.col(f"s{c}") / F.lit(size[c]) for c in size if c != j]
        if m > 1 and others:
            own, b = F.col(f"s{j}") / F.lit(m - 1), F.least(*others) if len(others) > 1 else others[0]
            worth = F.when(F.col("j") == j, F.when(own == b, 0.0).otherwise((b - own) / F.greatest(own, b))).otherwise(worth)
    s = sums.agg(F.sum(worth * F.col("w")) / F.sum("w")).first()[0]
    return df.sparkSession.createDataFrame([(int(k), float(s))], "k int, silhouette double")
