"""Detectors on planted anomalies, and against plain computations."""

import itertools
import math

import numpy as np
import pytest

from salesguard.operators import envelope as EN
from salesguard.operators import forest as FO
from salesguard.operators import mixture as MX
from salesguard.operators import models as M
from salesguard.operators import oneclass as OC
from salesguard.operators.draws import PRIME

KIND = "id int, q double, ipc double"
FEATS = ["q", "ipc"]
PLANTED = {1000, 1001, 1002, 1003}


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    rows = [(i, float(rng.normal(10, 1)), float(rng.normal(0.5, 0.05))) for i in range(600)]
    rows += [(1000 + i, 60.0 + 5 * i, 0.95) for i in range(4)]
    return spark.createDataFrame(rows, KIND)


def flagged(df, col):
    return {r["id"] for r in df.filter(f"{col} = 1").select("id").collect()}


# ------------------------------------------------------------------ forest
def test_isolation_forest_finds_planted(planted):
    d = FO.isolation_forest(planted, ["id"], FEATS, n_trees=50, max_samples=128, contamination=0.01)
    assert PLANTED <= flagged(d, "iforest_flag")


def test_forest_does_not_depend_on_partitions(planted):
    a = FO.isolation_forest(planted, ["id"], FEATS, n_trees=9, max_samples=64)
    b = FO.isolation_forest(planted.repartition(5), ["id"], FEATS, n_trees=9, max_samples=64)
    assert {(r.id, r.iforest_score) for r in a.collect()} == {(r.id, r.iforest_score) for r in b.collect()}


def test_one_more_row_changes_few_trees(spark):
    """There is no size at which trees draw otherwise: a row more replaces at most one row of some trees."""
    rng = np.random.default_rng(1)
    n_trees, m = 20, 16
    rows = [(i, float(rng.normal()), float(rng.normal())) for i in range(n_trees * m)]
    most = spark.createDataFrame(rows, KIND)
    less = most.where(f"id < {len(rows) - 1}")

    def drawn(df, n):
        got = {}
        for r in FO.samples(df, ["id"], FEATS, n, n_trees, m, 42).collect():
            got.setdefault(r.tree, set()).add((r.q, r.ipc))
        return got

    a, b = drawn(most, len(rows)), drawn(less, len(rows) - 1)
    last = rows[-1][1:]
    assert all(len(a[t]) == len(b[t]) == m for t in range(n_trees))
    assert all((a[t] - {last}) <= b[t] and (a[t] == b[t]) == (last not in a[t]) for t in range(n_trees))
    assert sum(a[t] != b[t] for t in range(n_trees)) < n_trees


def test_samples_are_the_smallest_draws(spark):
    import hashlib
    rows = [(i, float(i), 0.0) for i in range(4000)]
    got = {}
    for r in FO.samples(spark.createDataFrame(rows, KIND), ["id"], FEATS, len(rows), 7, 32, 42).collect():
        got.setdefault(r.tree, set()).add(int(r.q))
    for t in range(7):
        def u(i, t=t):
            h = hashlib.md5(f"{i}|42".encode()).hexdigest()
            return (int(h[:15], 16) % PRIME + (t + 1) * (int(h[16:31], 16) % PRIME)) % PRIME
        assert got[t] == set(sorted(range(4000), key=u)[:32])


def test_forest_scores_by_hand(spark):
    rows = [(i, float(i % 7), float(i % 5)) for i in range(40)]
    df = spark.createDataFrame(rows, KIND)
    got = {r.id: r.iforest_score for r in FO.isolation_forest(df, ["id"], FEATS, n_trees=5, max_samples=16).collect()}
    trees = {}
    for r in FO.samples(df, ["id"], FEATS, 40, 5, 16, 42).collect():
        trees.setdefault(r.tree, []).append((r.q, r.ipc))
    total = dict.fromkeys(got, 0.0)
    for t, x in trees.items():
        nodes = {n[1]: n for n in FO.grow(np.array(x), 42, t, 4)}
        assert sum(n[4] for n in nodes.values() if n[2] < 0) == 16
        for i, *p in rows:
            k = 1
            while nodes[k][2] >= 0:
                k = 2 * k + (p[nodes[k][2]] >= nodes[k][3])
            total[i] += nodes[k][5] + FO.mean_path(nodes[k][4])
    for i, v in total.items():
        assert got[i] == pytest.approx(2 ** (-v / 5 / FO.mean_path(16)), abs=1e-8)


# ------------------------------------------------------------------ envelope
def test_envelope_finds_planted(planted):
    d = EN.elliptic_envelope(planted, ["id"], FEATS, contamination=0.01)
    assert PLANTED <= flagged(d, "envelope_flag")


def test_envelope_is_not_captured_by_a_tight_cluster(spark):
    """A fifth of the rows in one tight cluster far out: moments of all rows, and what
    concentration finds from them, lie between; the envelope flags just them."""
    rng = np.random.default_rng(3)
    rows = [(i, float(rng.normal(0, 1)), float(rng.normal(0, 1))) for i in range(800)]
    rows += [(1000 + i, float(rng.normal(9, 0.02)), float(rng.normal(9, 0.02))) for i in range(200)]
    d = EN.elliptic_envelope(spark.createDataFrame(rows, KIND), ["id"], FEATS, contamination=0.2)
    assert flagged(d, "envelope_flag") == {1000 + i for i in range(200)}


def test_mcd_is_the_best_of_all_subsets(spark):
    rng = np.random.default_rng(5)
    for seed in range(3):
        x = np.round(rng.normal(0, 1, (12, 2)) + 6 * (np.arange(12) >= 9)[:, None], 3)
        df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], KIND)
        mean, cov, _ = EN.robust_moments(df, ["id"], FEATS, 12, seed=seed)
        best = min((np.linalg.det(np.cov(x[list(s)].T, bias=True)), s) for s in itertools.combinations(range(12), EN.half_of(12, 2)))
        assert np.linalg.det(cov) == pytest.approx(best[0], rel=1e-6)
        assert mean == pytest.approx(x[list(best[1])].mean(0), abs=1e-9)


def test_envelope_on_one_feature_and_repeats(spark):
    rows = [(i, 5.0, 1.0) for i in range(50)] + [(i, float(i % 4), 1.0) for i in range(50, 90)] + [(200, 99.0, 1.0), (201, None, 1.0)]
    df = spark.createDataFrame(rows, KIND)
    d = EN.elliptic_envelope(df, ["id"], ["q"], contamination=0.02)
    assert flagged(d, "envelope_flag") == {200} and d.where("robust_distance is null").count() == 1
    again = EN.elliptic_envelope(df.repartition(7), ["id"], ["q"], contamination=0.02)
    assert sorted(d.select("id", "robust_distance").dropna().collect()) == sorted(again.select("id", "robust_distance").dropna().collect())


def test_chi2_quantiles():
    assert EN.chi2_quantile(0.5, 2) == pytest.approx(2 * math.log(2), rel=1e-12)
    assert EN.chi2_quantile(0.975, 2) == pytest.approx(-2 * math.log(0.025), rel=1e-12)
    assert EN.chi2_quantile(0.95, 1) == pytest.approx(3.841458820694124, rel=1e-10)
    assert EN.chi2_quantile(0.975, 5) == pytest.approx(12.832501994030027, rel=1e-10)


# ------------------------------------------------------------------ one-class
def test_one_class_finds_planted(planted):
    d = OC.one_class(planted, FEATS, nu=0.01)
    assert PLANTED <= flagged(d, "oc_flag") and d.where("oc_flag = 1").count() <= 0.01 * 604


@pytest.mark.parametrize("nu", [0.02, 0.2])
def test_one_class_objective_is_near_its_optimum(spark, nu):
    rng = np.random.default_rng(2)
    x = np.round(np.column_stack([rng.gamma(2, 3, 700), rng.beta(2, 5, 700)]), 3)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], KIND)
    weights = OC.one_class_weights(2)
    w = OC.Fit(df, FEATS, *weights).solve(nu, 0.01)
    z = OC.features(x, x.mean(0), x.std(0), *weights)
    # numpy: subgradient descent with averaged steps for the optimum of the same objective
    best, v = np.inf, z.mean(0)
    for t in range(1, 6000):
        s = z @ v
        low = z[s <= np.sort(s)[math.ceil(nu * len(s)) - 1]].mean(0)
        v = v - (v - low) / (t + 1)
        best = min(best, OC.objective(z, v, nu)) if t % 20 == 0 else best
    assert OC.objective(z, w, nu) <= best + 0.01 * abs(best)
    d = OC.one_class(df, FEATS, nu=nu)
    assert 0 < d.where("oc_flag = 1").count() <= nu * 700
    assert {r.id: r.oc_score for r in d.collect()} == pytest.approx({i: float(a) for i, a in enumerate(z @ w - np.sort(z @ w)[math.ceil(nu * 700) - 1])}, abs=1e-9)


# ------------------------------------------------------------------ k-means, silhouette, mixture
def test_kmeans_2d_ranks_clusters(spark):
    rows = [(1, float(v), float(v % 2)) for v in [1, 1, 2, 10, 11, 10, 30, 31, 30]]
    d = M.kmeans_2d(spark.createDataFrame(rows, "k int, s double, wd double"), ["k"], ["s", "wd"])
    by = {r["s"]: r["cluster"] for r in d.collect()}
    assert by[1.0] == 1 and by[10.0] == 2 and by[30.0] == 3


@pytest.mark.parametrize("block", [2048, 7])
def test_silhouette_against_all_pairs(spark, block):
    rng = np.random.default_rng(9)
    x = np.round(np.concatenate([rng.normal(c, 1, (25, 2)) for c in (0, 5, 9)] + [[[40, 40]], [[0, 0]] * 3]), 1)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], KIND)
    got = M.silhouette(df, FEATS, 3, block=block).first()
    points = M.distinct_points(df, FEATS)
    centres = np.array(M.lloyd_frame(points, FEATS, 3))
    lab = np.round(((x[:, None] - centres[None]) ** 2).sum(-1), 9).argmin(1)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    worth = []
    for i in range(len(x)):
        own = lab == lab[i]
        if own.sum() == 1:
            worth.append(0.0)
            continue
        a, b = d[i, own].sum() / (own.sum() - 1), min(d[i, lab == c].mean() for c in set(lab) - {lab[i]})
        worth.append((b - a) / max(a, b))
    assert got.k == 3 and got.silhouette == pytest.approx(np.mean(worth), abs=1e-9)


def test_mixture_against_plain_steps(spark):
    rng = np.random.default_rng(4)
    x = np.round(np.concatenate([rng.normal((0, 0), 1, (150, 2)), rng.normal((6, 3), (2, 0.5), (100, 2))]), 2)
    df = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], KIND + "")
    parts = MX.fit(df, FEATS, 2)
    centres = np.array(M.lloyd_frame(M.distinct_points(df, FEATS), FEATS, 2))
    r = np.eye(2)[((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)]
    last, now = -np.inf, None
    while True:
        n = r.sum(0)
        means = r.T @ x / n[:, None]
        covs = [(r[:, j, None] * (x - means[j])).T @ (x - means[j]) / n[j] + 1e-6 * np.eye(2) for j in range(2)]
        then = (n / len(x), means, covs)
        logs = np.column_stack([np.log(then[0][j]) - 0.5 * (2 * np.log(2 * np.pi) + np.log(np.linalg.det(covs[j]))
                                + np.einsum("ij,jk,ik->i", x - means[j], np.linalg.inv(covs[j]), x - means[j])) for j in range(2)])
        ll = np.logaddexp(*logs.T)
        now = then
        if ll.mean() - last < 1e-4:
            break
        last, r = ll.mean(), np.exp(logs - ll[:, None])
    for j, (w, m, c) in enumerate(parts):
        assert w == pytest.approx(now[0][j], abs=1e-6) and m == pytest.approx(now[1][j], abs=1e-6) and c == pytest.approx(now[2][j], abs=1e-6)
    a = {r.id: (r.prediction, r.probability) for r in MX.gmm(df, FEATS).collect()}
    assert a == {r.id: (r.prediction, r.probability) for r in MX.gmm(df.repartition(7), FEATS).collect()}
    want = np.exp(logs - ll[:, None])
    assert all(np.allclose(a[i][1], want[i], atol=1e-5) and a[i][0] == want[i].argmax() for i in a)


def test_mixture_with_nulls_ties_and_other_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0, 5), (2, 1.0, 1.0, 6), (3, None, 1.0, 7), (4, 9.0, 1.0, 8)], KIND + ", ll int")
    got = {r.id: r for r in MX.gmm(df, FEATS).collect()}
    assert got[3].prediction is None and got[3].probability is None and got[1].prediction == got[2].prediction == 0
    assert got[4].prediction == 1 and got[4].ll == 8
    same = spark.createDataFrame([(1, 1.0, 1.0), (2, 1.0, 1.0)], KIND)
    assert [r.prediction for r in MX.gmm(same, FEATS).collect()] == [0, 0]


def test_empty_and_single_rows(spark):
    none, one = spark.createDataFrame([], KIND), spark.createDataFrame([(1, 2.0, 0.5)], KIND)
    assert FO.isolation_forest(none, ["id"], FEATS).collect() == []
    assert EN.elliptic_envelope(none, ["id"], FEATS).collect() == []
    assert OC.one_class(none, FEATS).collect() == [] and MX.gmm(none, FEATS).collect() == []
    assert M.silhouette(none, FEATS).collect() == []
    assert [r["iforest_score"] for r in FO.isolation_forest(one, ["id"], FEATS).collect()] == [0.5]
    assert EN.elliptic_envelope(one, ["id"], FEATS).count() == 1 and OC.one_class(one, FEATS).count() == 1
    assert MX.gmm(one, FEATS).count() == 1 and M.silhouette(one, FEATS).first().silhouette == 0.0


def test_kmeans_2d_does_not_hang_on_partitions(spark):
    rows = [(k, float(v), float(v % 2)) for k in range(5) for v in (1, 2, 3, 9, 10, 11, 30, 31, 35)]
    df = spark.createDataFrame(rows, "k int, s double, wd double")
    a = sorted(tuple(r) for r in M.kmeans_2d(df, ["k"], ["s", "wd"]).collect())
    assert a == sorted(tuple(r) for r in M.kmeans_2d(df.repartition(7, "s"), ["k"], ["s", "wd"]).collect())
