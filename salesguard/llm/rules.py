"""Quality rules: a decision list learned by sequential covering.

Statistics of each text are array expressions over its words. From labelled
rows, rules for the unwanted class are grown one threshold at a time by
information gain, pruned on held-back rows, and kept while they are precise;
the rows a rule covers are then set aside for the next. The list becomes one
ordered Spark CASE expression, so judging texts is a single scan without a
shuffle. No Python runs on the executors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesguard.llm.columns import WHITE

#: Labelled rows used to learn at most: those with the smallest hash of the id.
FIT_ROWS = 20_000
BINS = 24
WINDOW = 3
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["f_words", "f_word_chars", "f_symbols", "f_dup_lines", "f_repeats", "f_upper", "f_marks", "f_line_words"]
_GAP = "[ \\t\\n\\x0B\\f\\r]"


def statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``COUNTS`` and ``FEATURES`` for the whole text (null: empty).

    A word of a 3-word window that occurs twice or more in the text counts as
    repeated, once however many such windows hold it; the windows are compared
    by 64-bit hash.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    without = lambda pattern: (F.length(t) - F.length(F.regexp_replace(t, pattern, ""))).cast("long")
    # Each step keeps only what a later one needs: what it hands on is copied for every row.
    df = df.withColumn("_t", F.trim(t, F.lit(WHITE)))
    df = df.withColumns({
        "_w": F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", _GAP + "+")),
        "_l": F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(WHITE)) != ""),
        "word_chars": F.length(F.regexp_replace(t, _GAP + "+", "")).cast("long"),
        "n_symbols": without("[#*$%&|<>]"), "_upper": without("[A-Z]"), "_marks": without("[!?;:]"),
    })
    df = df.withColumns({
        "n_words": F.size("_w").cast("long"),
        "n_dup_lines": (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        "_lines": F.greatest(F.size("_l"), F.lit(1)),
        "_h": F.expr(
            "CASE WHEN size(_w) < 3 THEN cast(array() AS array<struct<h:bigint,p:int>>) ELSE sort_array(transform("
            "sequence(0, size(_w) - 3), i -> named_struct('h', xxhash64(_w[i], _w[i + 1], _w[i + 2]), 'p', i))) END"),
    })
    df = df.withColumn("_p", F.expr(
        "sort_array(filter(transform(_h, (x, i) -> CASE WHEN (i > 0 AND _h[i - 1].h = x.h) OR "
        "(i < size(_h) - 1 AND _h[i + 1].h = x.h) THEN x.p END), p -> p IS NOT NULL))"))
    gaps = F.expr("zip_with(_p, slice(_p, 2, greatest(size(_p), 1)), (a, b) -> least(3, coalesce(b - a, 3)))")
    # A filter on a statistic must not move below this step: the optimiser would write the arrays' expressions
    # out in full inside each other's lambdas. It does not pass a step that asks for the partition.
    df = df.withColumn("n_repeat_words", F.when(F.spark_partition_id() >= 0, F.aggregate(
        gaps, F.lit(0), lambda a, x: a + x).cast("long")).otherwise(F.lit(0)))
    n, c = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return df.withColumns({
        "f_words": F.col("n_words").cast("double"), "f_word_chars": F.col("word_chars") / n,
        "f_symbols": F.col("n_symbols") / c, "f_dup_lines": F.col("n_dup_lines") / F.col("_lines"),
        "f_repeats": F.col("n_repeat_words") / n, "f_upper": F.col("_upper") / c, "f_marks": F.col("_marks") / c,
        "f_line_words": F.col("n_words") / F.col("_lines"),
    }).drop("_t", "_w", "_l", "_h", "_p", "_upper", "_marks", "_lines")


def base_failed() -> Column:
    """The fixed base: too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Cond:
    """``feature >= cut`` if ``up``, else ``feature < cut``."""

    feature: str
    up: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) >= self.cut if self.up else F.col(self.feature) < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.up else '<'} {self.cut:.6g}"


Rule = tuple[Cond, ...]


def rule_column(rule: Rule) -> Column:
    out = F.lit(True)
    for t in rule:
        out = out & t.column()
    return out


def listed(rules: list[Rule]) -> Column:
    """Number of the first rule that fits, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for n, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(rule_column(rule), F.lit(n)).otherwise(out)
    return out


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> DataFrame:
    """Statistics of at most ``limit`` labelled rows that pass the base, with
    ``bad`` 1 for the unwanted class. Labels of one id are averaged; null ids
    and labels are left out; of rows that repeat an id the least text counts. The chosen ids are few by ``limit``, so they are
    broadcast and the texts stay where they are read."""
    ids = (labels.select(F.col("doc_id").alias("_id"), F.col(label).alias("_y")).dropna()
           .groupBy("_id").agg((F.avg("_y") < 0.5).cast("int").alias("bad")))
    chosen = ids.orderBy(F.xxhash64("_id"), "_id").limit(limit)
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text")).join(F.broadcast(chosen), "_id")
            .groupBy("_id", "bad").agg(F.min("text").alias("text")))           # one row of a repeated id
    return (statistics(rows).where(~base_failed())
            .select("bad", (F.pmod(F.xxhash64("_id", F.lit("prune")), F.lit(3)) == 0).alias("held"), *FEATURES))


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Quantiles of each feature, from both classes alike, as candidate thresholds."""
    q = F.lit([k / BINS for k in range(1, BINS)])
    found: dict[str, set] = {f: set() for f in FEATURES}
    for r in rows.groupBy("bad").agg(*[F.percentile_approx(f, q, 10_000).alias(f) for f in FEATURES]).collect():
        for f in FEATURES:
            found[f] |= set(r[f] or [])
    return {f: sorted(v) for f, v in found.items()}


def _bin(x: Column, cuts: list[float]) -> Column:
    """How many of the cuts ``x`` reaches."""
    return F.size(F.filter(F.lit(cuts or [math.inf]), lambda c: x >= c))


def _tests(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[Cond, tuple[int, int]]:
    """(bad, good) rows that each candidate test covers, from one histogram per feature."""
    bins = F.array(*[F.struct(F.lit(f).alias("f"), _bin(F.col(f), cuts[f]).alias("b")) for f in FEATURES])
    hist = (rows.select("bad", F.explode(bins).alias("x")).groupBy("x.f", "x.b")
            .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n")).collect())
    out: dict[Cond, tuple[int, int]] = {}
    for f in FEATURES:
        mine = {r["b"]: (r["p"], r["n"]) for r in hist if r["f"] == f}
        all_p, all_n = sum(p for p, _ in mine.values()), sum(n for _, n in mine.values())
        low_p = low_n = 0
        for k, cut in enumerate(cuts[f]):
            p, n = mine.get(k, (0, 0))
            low_p, low_n = low_p + p, low_n + n
            out[Cond(f, False, cut)] = (low_p, low_n)
            out[Cond(f, True, cut)] = (all_p - low_p, all_n - low_n)
    return out


def learn(rows: DataFrame, max_rules: int = 8, max_tests: int = 3, precision: float = 0.9,
          least: int = 5) -> list[Rule]:
    """An ordered list of rules for ``bad`` rows (frame of ``labelled``).

    A rule grows while a test raises FOIL's information gain, is cut back to
    the prefix with the best (p - n) / (p + n) on the held rows, and joins the
    list if it covers ``least`` bad rows in all with at least ``precision`` of
    what it covers bad. The rest goes on without the covered rows. Equal
    gains go by feature, direction and threshold. No bad row, no rule.
    """
    rows = rows.checkpoint()
    cuts, rules = _cuts(rows), []
    bad, good = F.sum("bad"), F.sum(1 - F.col("bad"))
    while len(rules) < max_rules:
        left = rows.where(listed(rules).isNull())
        grown, rule = left.where("NOT held"), ()
        p0, n0 = (x or 0 for x in grown.agg(bad, good).first())
        while p0 and n0 and len(rule) < max_tests:
            gain = lambda p, n, p0=p0, n0=n0: p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
            every = _tests(grown.where(rule_column(rule)), cuts)
            best = max(sorted(every, key=lambda t: (t.feature, t.up, t.cut)), key=lambda t: gain(*every[t]),
                       default=None)
            if best is None or gain(*every[best]) <= 1e-9 or every[best] == (p0, n0):
                break
            rule, (p0, n0) = (*rule, best), every[best]
        if not rule:
            break
        prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
        sums = [s for pre in prefixes for s in (F.sum(F.when(rule_column(pre) & F.col("held"), F.col("bad"))),
                                                F.sum(F.when(rule_column(pre) & F.col("held"), 1 - F.col("bad"))),
                                                F.sum(F.when(rule_column(pre), F.col("bad"))),
                                                F.sum(F.when(rule_column(pre), 1 - F.col("bad"))))]
        got = [x or 0 for x in left.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()]
        worth = lambda k: (got[4 * k] - got[4 * k + 1]) / max(1, got[4 * k] + got[4 * k + 1])
        k = max(range(len(prefixes)), key=lambda k: (worth(k), got[4 * k]))
        p, n = got[4 * k + 2], got[4 * k + 3]
        if p < least or p < precision * (p + n):
            break
        rules.append(prefixes[k])
    return rules


def judge(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = FIT_ROWS) -> DataFrame:
    """Every row of ``docs`` with ``COUNTS``, ``FEATURES``, ``base_failed``,
    ``rule`` (number of the first rule that fits, else null) and ``kept``.

    Null and empty texts have no words and fail the base. Repeated rows are
    each judged. Extra columns stay; one that clashes with an added name is
    replaced. Empty tables: no rows, or no rules when nothing is labelled.
    """
    rules = learn(labelled(docs, labels, label, limit))
    added = [*COUNTS, *FEATURES, "base_failed", "rule", "kept"]
    keep = [c for c in docs.columns if c not in added]
    rest = [F.col(f"`{c}`") for c in keep if c != "text"] or [F.lit(0).alias("none")]
    rows = statistics(docs.select("text", F.struct(*rest).alias("row")))
    judged = rows.withColumn("base_failed", base_failed()).withColumn("rule", listed(rules)).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull())
    return judged.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`").alias(c) for c in keep], *added)
