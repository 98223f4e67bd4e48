"""DuckDB SQL of the fitted detectors: each fit is a recursion from the same start."""

from __future__ import annotations

import math

from salesguard.operators import envelope as E
from salesguard.operators import forest as R
from salesguard.operators import mixture as M
from salesguard.operators import oneclass as C
from salesguard.operators.draws import draw_sql, named_sql, pair_sql

STORE_KEYS = ["date_", "city_name", "facility_id", "item_id"]


def store_rows() -> dict[str, str]:
    """``sr(keys, q, i, ks)``: the store level's two features and each row's key as text."""
    text = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in STORE_KEYS)
    return {"sr": f"SELECT {', '.join(STORE_KEYS)}, CAST(sales_quantity AS DOUBLE) AS q, ipc AS i, {text} AS ks FROM daily_store "
                  "WHERE sales_quantity IS NOT NULL AND ipc IS NOT NULL"}


def rank_cut(src: str, col: str, rank: str, name: str = "cut") -> str:
    """The value of a rank (from 1) of a column."""
    return (f"SELECT any_value(v) AS {name} FROM (SELECT {col} AS v, row_number() OVER (ORDER BY {col}) AS rn, COUNT(*) OVER () AS n "
            f"FROM {src}) WHERE rn = {rank}")


# ------------------------------------------------------------------ M14
def mixture_ctes(tol: float = 1e-4) -> dict[str, str]:
    """``gm(x, y, r0, r1)`` from the settled partition ``l2_near(x, y, w, lab)``."""
    parts = [f"{v}{j}" for j in (0, 1) for v in ("w", "mx", "my", "xx", "xy", "yy")]
    two = f"{2 * math.log(2 * math.pi)!r}"

    def log_density(j):
        det = f"(xx{j} * yy{j} - xy{j} * xy{j})"
        q = f"((x - mx{j}) ** 2 * yy{j} - 2 * (x - mx{j}) * (y - my{j}) * xy{j} + (y - my{j}) ** 2 * xx{j}) / {det}"
        return f"ln(w{j}) - 0.5 * ({two} + ln({det})) - 0.5 * {q}"

    def maximise(j, r):
        n = f"SUM(w * {r})"
        mx, my = (f"(SUM(w * {r} * {v}) / {n})" for v in "xy")
        cov = lambda a, b, ma, mb: f"(SUM(w * {r} * {a} * {b}) / {n} - {ma} * {mb})"
        return [f"round({n} / SUM(w), 9) AS nw{j}", f"round({mx}, 9) AS nmx{j}", f"round({my}, 9) AS nmy{j}",
                f"round(greatest({cov('x', 'x', mx, mx)}, 0), 9) + {M.FLOOR} AS nxx{j}", f"round({cov('x', 'y', mx, my)}, 9) AS nxy{j}",
                f"round(greatest({cov('y', 'y', my, my)}, 0), 9) + {M.FLOOR} AS nyy{j}"]

    hard = ", ".join(x for j in (0, 1) for x in maximise(j, f"(CASE WHEN lab = {j + 1} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"))
    soft = ", ".join(x for j in (0, 1) for x in maximise(j, f"r{j}"))
    now = ", ".join(f"any_value({p}) AS {p}" for p in parts)
    dens = (f"SELECT *, l0 - ll AS d0, exp(l0 - ll) AS r0, exp(l1 - ll) AS r1 FROM (SELECT *, greatest(l0, l1) + ln(exp(l0 - greatest(l0, l1)) "
            f"+ exp(l1 - greatest(l0, l1))) AS ll FROM (SELECT *, {log_density(0)} AS l0, {log_density(1)} AS l1 FROM ")
    pts = "(SELECT p.x, p.y, p.w, s.* FROM {s} s CROSS JOIN lp p)))"
    return {
        "gm_0": f"SELECT {hard} FROM l2_near",
        "gm_it": ("SELECT 0 AS step, 0 AS stop, -1e300::DOUBLE AS last, " + ", ".join(f"n{p} AS {p}" for p in parts) + " FROM gm_0 "
                  "UNION ALL SELECT step + 1, CASE WHEN l - last < " + repr(tol) + " THEN 1 ELSE 0 END, l, "
                  + ", ".join(f"CASE WHEN l - last < {tol!r} THEN {p} ELSE n{p} END" for p in parts)
                  + f" FROM (SELECT any_value(step) AS step, any_value(last) AS last, SUM(w * ll) / SUM(w) AS l, {now}, {soft} FROM ("
                  + dens + pts.format(s="(SELECT * FROM gm_it WHERE stop = 0)") + ") HAVING COUNT(*) > 0)"),
        "gm_end": "SELECT * FROM gm_it WHERE stop = 1",
        "gm": "SELECT x, y, r0, r1 FROM (" + dens + pts.format(s="gm_end") + ")",
    }


# ------------------------------------------------------------------ M23
def forest_ctes(n_trees: int = 100, m: int = 256, contamination: float = 0.01, seed: int = 42) -> dict[str, str]:
    """``if_scored(keys, score, flag)``; trees grow level by level, rows fall through them."""
    a, b = pair_sql(f"ks || '|{seed}'")
    pick, u = named_sql(f"'{seed}|' || tree || '|' || node")
    limit = math.ceil(math.log2(m))
    path = ("depth + CASE WHEN n <= 1 THEN 0 WHEN n = 2 THEN 1 ELSE 2 * (ln(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n::DOUBLE END")
    split = "CASE WHEN NOT {o} THEN NULL WHEN hq > lq AND hi > li THEN {p} % 2 WHEN hq > lq THEN 0 WHEN hi > li THEN 1 END"
    open_ = f"(n > 1 AND depth < {limit})"
    thr = f"CASE WHEN f = 0 THEN lq + (hq - lq) * {u} ELSE li + (hi - li) * {u} END"
    stats = ("SELECT *, MIN(q) OVER g AS lq, MAX(q) OVER g AS hq, MIN(i) OVER g AS li, MAX(i) OVER g AS hi, COUNT(*) OVER g AS n "
             "FROM {src} WINDOW g AS (PARTITION BY tree, node)")
    part = f"SELECT *, {split.format(o=open_, p=pick)} AS f FROM ({stats})"
    return {
        "if_h": f"SELECT *, {a} AS a, {b} AS b FROM sr",
        "if_d": f"SELECT DISTINCT tree, {draw_sql('a', 'b', 'tree')} AS u, ks, q, i FROM if_h, (SELECT unnest(range({n_trees}))::INT AS tree)",
        "if_s": f"SELECT tree, q, i FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY u, ks, q, i) AS rn FROM if_d) WHERE rn <= {m}",
        "if_g": ("SELECT tree, 1 AS node, 0 AS depth, q, i FROM if_s UNION ALL SELECT tree, 2 * node + CASE WHEN CASE WHEN f = 0 THEN q ELSE i END >= "
                 f"{thr} THEN 1 ELSE 0 END, depth + 1, q, i FROM ({part.format(src='if_g')}) WHERE f IS NOT NULL"),
        "if_n": (f"SELECT tree, node, depth, n, f, CASE WHEN f IS NOT NULL THEN {thr} END AS thr FROM (SELECT DISTINCT tree, node, depth, n, f, "
                 f"lq, hq, li, hi FROM ({part.format(src='if_g')}))"),
        "if_p": "SELECT row_number() OVER () AS id, q, i FROM (SELECT DISTINCT q, i FROM sr)",
        "if_w": (f"SELECT id, q, i, tree, 1 AS node FROM if_p, (SELECT DISTINCT tree FROM if_n) UNION ALL SELECT w.id, w.q, w.i, w.tree, "
                 "2 * w.node + CASE WHEN CASE WHEN t.f = 0 THEN w.q ELSE w.i END >= t.thr THEN 1 ELSE 0 END "
                 "FROM if_w w JOIN if_n t ON t.tree = w.tree AND t.node = w.node AND t.f IS NOT NULL"),
        "if_l": f"SELECT w.q, w.i, AVG({path}) AS e FROM if_w w JOIN if_n t ON t.tree = w.tree AND t.node = w.node AND t.f IS NULL GROUP BY w.id, w.q, w.i",
        "if_r": f"SELECT s.*, round(power(2.0::DOUBLE, -l.e / {R.mean_path(m)!r}), 9) AS score FROM sr s JOIN if_l l ON l.q = s.q AND l.i = s.i",
        "if_cut": rank_cut("if_r", "score", f"ceil({1 - contamination!r} * n)"),
        "if_scored": f"SELECT {', '.join(STORE_KEYS)}, score, CASE WHEN score >= cut THEN 1 ELSE 0 END AS flag FROM if_r, if_cut",
    }


# ------------------------------------------------------------------ M25
def envelope_ctes(contamination: float = 0.01, starts: int = E.STARTS, sample: int = E.SAMPLE, seed: int = 42) -> dict[str, str]:
    """``ee(keys, d, flag)``: starts and their first steps on the sample, then steps over all rows."""
    a, b = pair_sql(f"ks || '|{seed}'")
    ridge = f"{E.RIDGE!r}"
    cq, ci = (f"({v} + {ridge} * CASE WHEN {s} > 0 THEN {s} ELSE 1 END)" for v, s in (("vq", "sq"), ("vi", "si")))
    det = f"({cq} * {ci} - vqi * vqi)"
    dist = f"round(((q - mq) ** 2 * {ci} - 2 * (q - mq) * (i - mi) * vqi + (i - mi) ** 2 * {cq}) / {det}, 9)"
    moments = "AVG(q) AS mq, AVG(i) AS mi, var_pop(q) AS vq, covar_pop(q, i) AS vqi, var_pop(i) AS vi"
    h = "((n + 3) // 2)"

    def step(cands: str, rows: str, count: str, more: str = "") -> str:
        """Moments of the h nearest rows of every candidate."""
        return (f"SELECT c, {more}{moments} FROM (SELECT *, MAX(CASE WHEN rn = least({h}, n) THEN d END) OVER (PARTITION BY c) AS cut FROM "
                f"(SELECT *, row_number() OVER (PARTITION BY c ORDER BY d) AS rn FROM (SELECT x.*, p.q, p.i, t.n, {dist} AS d "
                f"FROM {cands} x CROSS JOIN {rows} p CROSS JOIN ee_all CROSS JOIN {count} t))) WHERE d <= cut GROUP BY c")

    same = " AND ".join(f"abs(n{v} - o{v}) <= 1e-12 + 1e-9 * abs(o{v})" for v in ("mq", "mi", "vq", "vqi", "vi"))
    names = ("mq", "mi", "vq", "vqi", "vi")
    return {
        "ee_h": f"SELECT *, {a} AS a, {b} AS b FROM sr",
        "ee_all": "SELECT var_pop(q) AS sq, var_pop(i) AS si FROM sr",
        "ee_n": "SELECT COUNT(*) AS n FROM sr",
        "ee_few": f"SELECT q, i, a, b, row_number() OVER (ORDER BY ks, q, i) AS pos FROM (SELECT * FROM ee_h ORDER BY a, ks, q, i LIMIT {sample})",
        "ee_m": "SELECT COUNT(*) AS n FROM ee_few",
        "ee_0": (f"SELECT c, {moments} FROM (SELECT f.*, s.c, row_number() OVER (PARTITION BY s.c ORDER BY {draw_sql('f.a', 'f.b', 's.c')}, f.pos) AS rn "
                 f"FROM ee_few f CROSS JOIN (SELECT unnest(range({starts})) AS c) s) WHERE rn <= 3 GROUP BY c"),
        "ee_1": step("ee_0", "ee_few", "ee_m"),
        "ee_2": step("ee_1", "ee_few", "ee_m"),
        "ee_10": f"SELECT * FROM ee_2 ORDER BY round(vq * vi - vqi * vqi, 9), c LIMIT {E.KEPT}",
        "ee_3": step("ee_10", "sr", "ee_n"),
        "ee_4": step("ee_3", "sr", "ee_n"),
        "ee_it": ("SELECT 0 AS step, 0 AS stop, mq, mi, vq, vqi, vi FROM (SELECT e.* FROM ee_4 e JOIN (SELECT c, round(vq * vi - vqi * vqi, 9) AS was, "
                  "row_number() OVER (ORDER BY round(vq * vi - vqi * vqi, 9), c) AS nth FROM ee_2) o USING (c) "
                  "ORDER BY round(vq * vi - vqi * vqi, 9), nth LIMIT 1) UNION ALL "
                  f"SELECT step + 1, CASE WHEN {same} THEN 1 ELSE 0 END, {', '.join(f'n{v}' for v in names)} FROM (SELECT s.step, "
                  + ", ".join(f"s.{v} AS o{v}" for v in names) + ", " + ", ".join(f"z.{v} AS n{v}" for v in names)
                  + " FROM (SELECT * FROM ee_it WHERE stop = 0) s CROSS JOIN ("
                  + step("(SELECT 0 AS c, mq, mi, vq, vqi, vi FROM ee_it WHERE stop = 0)", "sr", "ee_n") + ") z)"),
        "ee_raw": f"SELECT p.*, {dist} AS d FROM sr p CROSS JOIN (SELECT * FROM ee_it WHERE stop = 1) CROSS JOIN ee_all",
        "ee_mid": rank_cut("ee_raw", "d", "ceil(0.5 * n)", "middle"),
        "ee_re": f"SELECT {moments} FROM ee_raw, ee_mid WHERE d / (middle / {E.chi2_quantile(0.5, 2)!r}) < {E.chi2_quantile(E.WITHIN, 2)!r}",
        "ee_d": f"SELECT p.*, {dist} AS d FROM sr p CROSS JOIN ee_re CROSS JOIN ee_all",
        "ee_cut": rank_cut("ee_d", "d", f"ceil({1 - contamination!r} * n)"),
        "ee": f"SELECT {', '.join(STORE_KEYS)}, d, CASE WHEN d > cut THEN 1 ELSE 0 END AS flag FROM ee_d, ee_cut",
    }


# ------------------------------------------------------------------ M24
def one_class_ctes(nu: float = 0.01, tol: float = 0.01) -> dict[str, str]:
    """``oc(keys, score, flag)``: line-searched steps towards the mean of the lowest-scored rows."""
    directions, phases = C.one_class_weights(2)
    d = len(phases)
    z = [f"cos({float(p)!r} + {float(w[0])!r} * zq + {float(w[1])!r} * zi) * sqrt(2.0::DOUBLE / {d})"
         for w, p in zip(directions, phases, strict=True)]
    mean = "[" + ", ".join(f"AVG(z[{k + 1}])" for k in range(d)) + "]"
    away = f"list_transform(range(1, {d + 1}), lambda k: w[k] - m[k])"
    scored = ("SELECT s.step, s.w, p.z, round(list_dot_product(p.z, s.w), 12) AS v FROM (SELECT * FROM oc_it WHERE stop = 0) s CROSS JOIN oc_z p")
    low = (f"SELECT any_value(step) AS step, any_value(w) AS w, {mean} AS m FROM (SELECT *, MAX(CASE WHEN rn = ceil({nu} * n) THEN v END) OVER () AS cut "
           f"FROM (SELECT *, row_number() OVER (ORDER BY v) AS rn, COUNT(*) OVER () AS n FROM ({scored}))) WHERE v <= cut HAVING COUNT(*) > 0")
    return {
        "oc_z": f"SELECT *, [{', '.join(z)}] AS z FROM (SELECT r.*, (q - a) / CASE WHEN b > 0 THEN b ELSE 1 END AS zq, (i - c) / CASE WHEN e > 0 "
                "THEN e ELSE 1 END AS zi FROM sr r, (SELECT AVG(q) AS a, stddev_pop(q) AS b, AVG(i) AS c, stddev_pop(i) AS e FROM sr))",
        "oc_it": (f"SELECT 0 AS step, 0 AS stop, {mean} AS w FROM oc_z UNION ALL SELECT step + 1, CASE WHEN gap <= {tol} * 0.5 * ww THEN 1 ELSE 0 END, "
                  f"CASE WHEN gap <= {tol} * 0.5 * ww THEN w ELSE list_transform(range(1, {d + 1}), lambda k: w[k] - least(1.0, gap / aa) * away[k]) END "
                  f"FROM (SELECT *, list_dot_product(w, away) AS gap, list_dot_product(w, w) AS ww, list_dot_product(away, away) AS aa "
                  f"FROM (SELECT *, {away} AS away FROM ({low})))"),
        "oc_v": f"SELECT p.*, round(list_dot_product(p.z, s.w), 12) AS v FROM oc_z p CROSS JOIN (SELECT w FROM oc_it WHERE stop = 1) s",
        "oc_rho": rank_cut("oc_v", "v", f"ceil({nu} * n)", "rho"),
        "oc": f"SELECT {', '.join(STORE_KEYS)}, round(v - rho, 12) AS score, CASE WHEN round(v - rho, 12) < 0 THEN 1 ELSE 0 END AS flag FROM oc_v, oc_rho",
    }


# ------------------------------------------------------------------ M13
SILHOUETTE = """
SELECT 3::INT AS k, round(SUM(w * CASE WHEN n = 1 OR a = b THEN 0 ELSE (b - a) / greatest(a, b) END) / SUM(w), 6) AS silhouette FROM (
  SELECT x, y, any_value(w) AS w, any_value(n) FILTER (own) AS n, MIN(s / n) FILTER (NOT own) AS b, any_value(s / (n - 1)) FILTER (own AND n > 1) AS a
  FROM (SELECT p.x, p.y, p.w, p.lab = o.lab AS own, SUM(o.w) AS n, SUM(o.w * sqrt((p.x - o.x) ** 2 + (p.y - o.y) ** 2)) AS s
        FROM l3_near p CROSS JOIN l3_near o GROUP BY p.x, p.y, p.w, p.lab, o.lab) GROUP BY x, y)"""
