import numpy as np
import pytest
from pyspark.sql import functions as F

from salesguard.llm import ann

KIND = "vec_id long, embedding array<float>"


def brute(rows, k):
    ok = {i: np.array(v, np.float32).astype(float) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, x in ok.items():
        best = sorted((-(x * y).sum(), i) for i, y in ok.items() if i != q and len(y) == len(x))[:k]
        out[q] = [(i, -s) for s, i in best]
    return {q: v for q, v in out.items() if v}


def collect(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("k,blocks", [(3, (8, 16)), (20, (64, 7)), (100, (8192, 4096))])
def test_equals_brute_force_with_ties_and_bad_vectors(spark, k, blocks):
    rng = np.random.default_rng(k)
    rows = [(i, [float(x) for x in rng.normal(size=12).astype(np.float32)]) for i in range(70)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]                      # equal vectors: ties by id
    rows += [(200, None), (201, []), (202, [0.0] * 12), (203, [None] + [1.0] * 11), (204, [float("nan")] + [1.0] * 11),
             (205, [float("inf")] + [1.0] * 11), (206, [1.0, 2.0]), (207, [2.0, 1.0]), (208, [5.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows, KIND)
    got = collect(ann.block_matrix_join(df, df, k, q_block=blocks[0], c_block=blocks[1]))
    want = brute(rows, k)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    a, b = (ann.Coded(rng.normal(size=(50, 33)) * 10.0 ** rng.integers(-4, 4, (50, 1))) for _ in range(2))
    approx = ann.code_product(a.code, b.code) * a.scale[:, None] * b.scale[None, :]
    bound = a.near[:, None] * b.err[None, :] + a.err[:, None] * b.norm[None, :]
    assert (np.abs(a.x @ b.x.T - approx) <= bound).all()


def test_empty_and_extra_columns(spark):
    none = spark.createDataFrame([], KIND)
    assert ann.block_matrix_join(none, none).collect() == []
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.5, 0.1])], KIND)
    wide = df.withColumns({"id": F.lit(9), "rank": F.lit(0), "score": F.lit(0), "dim": F.lit(1)})
    assert [(r.query_id, r.vec_id) for r in ann.block_matrix_join(wide, wide).orderBy("query_id").collect()] == [(1, 2), (2, 1)]


def test_of_a_repeated_id_the_least_vector_counts(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(30)]
    again = rows + [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(0, 30, 3)] + rows[:5]
    least = {}
    for i, v in again:
        least[i] = min(least.get(i, v), v)
    want = brute(sorted(least.items()), 5)
    for seed in (1, 2):
        df = spark.createDataFrame(again, KIND).orderBy(F.rand(seed)).repartition(3)
        got = collect(ann.block_matrix_join(df, df, 5, q_block=8, c_block=16))
        assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
