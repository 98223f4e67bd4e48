from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from salesguard.llm import mixing

KIND = "doc_id long, text string, source string"


def test_bisection_meets_its_targets():
    totals = {"big": 900_000, "mid": 90_000, "small": 10_000, "none": 0}
    a = mixing.solve(totals, max_repeats=4.0)
    assert mixing.spread(totals, mixing.tempered(totals, a)) == pytest.approx(4.0, rel=1e-6)
    b = mixing.solve(totals, target_entropy=0.9)
    assert mixing.entropy(mixing.tempered(totals, b)) == pytest.approx(0.9, rel=1e-6)
    assert mixing.solve(totals, max_repeats=1e9) == 0.0 and mixing.solve(totals) == 1.0
    assert mixing.solve(totals, target_entropy=-1.0) == 1.0
    assert mixing.solve({}, max_repeats=2.0) == 0.0
    w = mixing.tempered(totals, a)
    assert sum(w.values()) == pytest.approx(1) and w["none"] == 0


def docs(spark):
    rows = [(k, "w " * (1 + k % 37), "big") for k in range(800)] + [(1000 + k, "w " * (1 + k % 11), "small") for k in range(60)]
    rows += [(2000 + k, "w w", None) for k in range(5)] + [(3000, None, "small"), (3001, "", "small"), (3002, "a b", "small"), (3002, "a b", "small")]
    return spark.createDataFrame(rows, KIND), rows


def tokens(text):
    return max(1, len((text or "").split()))


def test_every_row_is_kept_and_budgets_are_met(spark):
    df, rows = docs(spark)
    got = mixing.mix(df.withColumns({"full": F.lit(1), "mix_epoch": F.lit("x"), "turn": F.lit(0)}), max_repeats=3.0, blocks=16).collect()
    totals, copies, spent = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, t, s in rows:
        totals[s or ""] += tokens(t)
    for r in got:
        copies[r.doc_id, r.text] += 1
        spent[r.source or ""] += r.mix_tokens
        assert r.mix_tokens == tokens(r.text)
    assert set(copies) == {(i, t) for i, t, _ in rows}
    w = mixing.tempered(totals, mixing.solve(totals, max_repeats=3.0))
    want = mixing.budgets(totals, w)
    for s in totals:
        assert want[s] <= spent[s] < want[s] + 50          # the last row may run over
    assert want[""] == pytest.approx(3 * totals[""], rel=0.01) and want["big"] == totals["big"]


def test_an_epoch_holds_each_row_once_and_blocks_stay_together(spark):
    df, rows = docs(spark)
    got = mixing.mix(df, max_repeats=3.0, blocks=16).where("source = 'small' and mix_epoch = 0").collect()
    assert sorted(r.doc_id for r in got) == sorted(i for i, _, s in rows if s == "small")
    turns = [{r.doc_id: r.mix_block for r in mixing.mix(df, max_repeats=3.0, blocks=16).where(f"source = 'small' and mix_epoch = {e}").collect()}
             for e in (0, 1)]
    assert turns[0] != turns[1]                            # another permutation
    same = {i: {j for j in turns[0] if turns[0][j] == turns[0][i]} for i in turns[0]}
    assert all({j for j in turns[1] if turns[1][j] == turns[1][i]} <= same[i] for i in turns[1])


def test_explicit_budget_leaves_rows_out_only_beyond_it(spark):
    df, _ = docs(spark)
    got = mixing.mix(df, max_repeats=None, budget=5_000, blocks=16)
    assert abs(sum(r.mix_tokens for r in got.collect()) - 5_000) < 150


def plain(rows, max_repeats, budget=None, seed=17, blocks=16):
    """Emissions by source, from the target weights alone: the exponent by a fine scan,
    whole epochs and the rest of the budget in rows that begin before its end."""
    totals = defaultdict(int)
    for _, t, s in rows:
        totals[s or ""] += tokens(t)
    size = sum(totals.values())
    for k in range(100_001):
        up = {s: (n / size) ** (k / 100_000) for s, n in totals.items()}
        per = [up[s] / totals[s] for s in totals]
        if max(per) / min(per) <= max_repeats:
            break
    scale = budget / sum(up.values()) if budget else max(totals[s] / up[s] for s in totals)
    return totals, {s: up[s] * scale for s in totals}


def test_emissions_against_a_plain_count(spark):
    df, rows = docs(spark)
    totals, want = plain(rows, 3.0)
    got = defaultdict(lambda: defaultdict(int))
    sizes = defaultdict(int)
    for r in mixing.mix(df.repartition(5), max_repeats=3.0, blocks=16).collect():
        got[r.source or ""][r.doc_id, r.text] += 1
        sizes[r.source or "", r.mix_epoch] += r.mix_tokens
    given = defaultdict(int)
    for i, t, s in rows:
        given[s or "", (i, t)] += 1
    for s, total in totals.items():
        full, rest = divmod(want[s], total)
        for (source, row), n in given.items():
            if source == s:
                assert got[s][row] in range(int(full + 1e-6) * n, (int(full + 1e-6) + 1) * n + 1)
        assert all(sizes[s, e] == total for e in range(int(full + 1e-6)))
        assert abs(sizes.get((s, int(full + 1e-6)), 0) - (rest if rest / total < 0.999 else 0)) < 50


def test_the_end_of_a_budget_among_copies(spark):
    """Copies are numbered, so no more of them pass than begin before the end."""
    for budget, extra in ((500, 0), (500, 3), (1, 0), (1999, 1), (2000, 2), (2001, 0), (5000, 1)):
        rows = [(1, "two words", "s")] * 1000
        df = spark.createDataFrame(rows, KIND).withColumn("other", F.pmod(F.monotonically_increasing_id(), F.lit(extra + 1)))
        got = mixing.mix(df, max_repeats=None, budget=budget).collect()
        assert sum(r.mix_tokens for r in got) == -(-budget // 2) * 2


def test_null_ids_spread_over_blocks(spark):
    rows = [(None, f"text {k}", "s") for k in range(1000)] + [(5, f"other {k}", "s") for k in range(1000)]
    got = mixing.mix(spark.createDataFrame(rows, KIND)).collect()
    assert len(got) == 2000 and len({r.mix_block for r in got}) > 500


def test_long_texts_and_a_tiny_source(spark):
    rows = [(1, "w " * 200_000, "long"), (2, "a", "tiny"), (3, "b c", "tiny")]
    got = mixing.mix(spark.createDataFrame(rows, KIND), max_repeats=1e9, budget=400_000).collect()
    spent = defaultdict(int)
    for r in got:
        spent[r.source] += r.mix_tokens
    assert spent["long"] == 200_000 and abs(spent["tiny"] - 200_000) <= 2
    assert max(r.mix_epoch for r in got if r.source == "tiny") == 66_666


def test_empty(spark):
    assert mixing.mix(spark.createDataFrame([], KIND)).collect() == []
