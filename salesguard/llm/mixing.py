"""Temperature mixing of sources, realised as budgeted block permutations.

Target weights are token shares raised to an exponent between 0 (all sources
alike) and 1 (as they are), found by bisection: the least exponent that keeps
within a repetition limit, or the one that meets an entropy. A source's budget
is its weight's part of all tokens. It is spent in epochs; each epoch visits
the source's blocks in a keyed permutation (the order of a hash of epoch and
block), and the last one ends where the budget does. A row belongs to a block
by its id and text, and a source has more blocks the larger it is.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesguard.llm.columns import words
from salesguard.session import cut, release

#: Blocks of a source, at least; and tokens of a block, beyond. Only the block in which a
#: budget ends is ordered row by row.
BLOCKS, BLOCK_TOKENS = 1024, 1 << 26
#: Entries of the last epochs (one for each block they reach) that are broadcast; more are joined.
ENTRIES = 500_000


def tempered(totals: dict[str, int], alpha: float) -> dict[str, float]:
    """Token shares to the power ``alpha``, normalised; empty sources weigh nothing."""
    size = sum(totals.values())
    up = {s: (n / size) ** alpha for s, n in totals.items() if n > 0}
    whole = math.fsum(up.values())
    return {s: up.get(s, 0.0) / whole if whole else 0.0 for s in totals}


def entropy(weights: dict[str, float]) -> float:
    """In nats."""
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def spread(totals: dict[str, int], weights: dict[str, float]) -> float:
    """Epochs of the most repeated source for one of the least repeated."""
    per = [weights[s] / n for s, n in totals.items() if n > 0]
    return max(per) / min(per) if per else 1.0


def solve(totals: dict[str, int], max_repeats: float | None = None, target_entropy: float | None = None) -> float:
    """The exponent, by bisection. Repetition falls and entropy too as it rises.
    With both aims given, repetition binds. A target no exponent meets gives
    the nearer end."""
    if max_repeats is not None:
        fits = lambda a: spread(totals, tempered(totals, a)) <= max_repeats
    elif target_entropy is not None:
        fits = lambda a: entropy(tempered(totals, a)) <= target_entropy
    else:
        return 1.0
    low, high = 0.0, 1.0
    if fits(low):
        return low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if fits(mid) else (mid, high)
    return high


def budgets(totals: dict[str, int], weights: dict[str, float], budget: int | None = None) -> dict[str, int]:
    """Tokens to emit by source. Without ``budget``, the least at which every
    source is seen once in full, so no row is left out."""
    live = {s: n for s, n in totals.items() if n > 0}
    if not live:
        return dict.fromkeys(totals, 0)
    if budget is not None:
        return {s: round(weights[s] * budget) for s in totals}
    rare = max(live, key=lambda s: (live[s] / weights[s], s))
    whole = live[rare] / weights[rare]
    return {s: max(n, round(weights[s] * whole)) if n > 0 else 0 for s, n in totals.items()}


def mix(docs: DataFrame, max_repeats: float | None = 2.0, target_entropy: float | None = None,
        budget: int | None = None, seed: int = 17, id_col: str = "doc_id", source: str = "source",
        blocks: int = BLOCKS) -> DataFrame:
    """One row for each time a row of ``docs`` is emitted: its columns, then
    ``mix_tokens``, ``mix_weight``, ``mix_epoch`` (from 0), ``mix_block`` (the
    key of the block's place in the epoch) and ``mix_order`` (key of the order in a block).

    Tokens are words, one at least, so that empty texts are emitted too. Null
    sources are one source. The totals of sources come to the driver, one
    number for each; a source's full epochs are a number, and only the blocks
    that its last epoch reaches are listed. The last epoch's rows are those that
    begin before the budget ends, in the order of the blocks and of the rows'
    keys. Rows equal in id and text share a key and are numbered there, so that as
    many of them pass as the budget has room for; of those that differ in other
    columns the ones with the smaller hash go first. An empty table gives no rows. Columns of
    ``docs`` that start with ``mix_`` are replaced.
    """
    keep = [c for c in docs.columns if not c.startswith("mix_")]
    named = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(*named).withColumns({
        "mix_tokens": F.greatest(F.size(words(F.col("text"))), F.lit(1)).cast("long"),
        "mix_source": F.coalesce(F.col(source).cast("string"), F.lit("")),
        "mix_key": F.xxhash64(F.lit(seed), id_col, "text"),
    })
    # Text length in tokens costs the pass over the texts; the plan needs only these few numbers of it.
    light = cut(rows.select("mix_source", "mix_tokens", "mix_key"), "tokens")
    totals = {r[0]: r[1] for r in light.groupBy("mix_source").agg(F.sum("mix_tokens")).collect()}
    weights = tempered(totals, solve(totals, max_repeats, target_entropy))
    spend = budgets(totals, weights, budget)
    spark = docs.sparkSession
    plan = spark.createDataFrame([(s, *divmod(spend[s], n), weights[s], max(blocks, -(-n // BLOCK_TOKENS))) for s, n in totals.items()],
                                 "mix_source string, mix_full long, mix_rest long, mix_weight double, mix_blocks long")
    plan = F.broadcast(plan) if len(totals) <= ENTRIES else plan
    block = F.pmod(F.xxhash64(F.lit(seed), "mix_key"), F.col("mix_blocks"))
    turn = lambda epoch: F.xxhash64(F.lit(seed), epoch, "mix_place")

    # The last epoch: its blocks in order, up to the one in which the budget ends.
    partly = light.join(plan.where("mix_rest > 0"), "mix_source").withColumn("mix_place", block)
    by_block = partly.groupBy("mix_source", "mix_place").agg(F.sum("mix_tokens").alias("within"), F.first("mix_full").alias("mix_full"),
                                                             F.first("mix_rest").alias("mix_rest"))
    order = W.partitionBy("mix_source").orderBy(turn("mix_full"), "mix_place")
    upto = F.sum("within").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    reached = by_block.withColumn("room", F.col("mix_rest") - (upto - F.col("within"))).where("room > 0").select(
        "mix_source", "mix_place", "room", (F.col("room") < F.col("within")).alias("ends"))
    # In it, rows by key; those of one key are counted first, so copies meet as one number.
    keys = partly.join(reached.where("ends"), ["mix_source", "mix_place"]).groupBy("mix_source", "mix_place", "mix_key", "room").agg(
        F.sum("mix_tokens").alias("within"), F.max("mix_tokens").alias("each"))
    order = W.partitionBy("mix_source", "mix_place").orderBy("mix_key")
    begins = F.sum("within").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("within")
    last = (keys.withColumn("begins", begins).where("begins < room").groupBy("mix_source", "mix_place")
            .agg(F.max_by(F.struct("mix_key", F.ceil((F.col("room") - F.col("begins")) / F.col("each")).alias("copies"),
                                   (F.col("within") / F.col("each")).cast("long").alias("there")), "mix_key").alias("edge")))
    last = cut(reached.join(last, ["mix_source", "mix_place"], "left").select(
        "mix_source", "mix_place", F.col("edge.mix_key").alias("mix_edge"), F.least("edge.copies", "edge.there").alias("mix_copies"),
        F.lit(True).alias("mix_last")), "last")
    release(light)
    last = F.broadcast(last) if last.count() <= ENTRIES else last

    placed = rows.join(plan, "mix_source").withColumn("mix_place", block).join(last, ["mix_source", "mix_place"], "left")
    whole = F.coalesce(F.col("mix_last") & (F.col("mix_edge").isNull() | (F.col("mix_key") < F.col("mix_edge"))), F.lit(False))
    full = F.when(F.col("mix_full") > 0, F.sequence(F.lit(0).cast("long"), F.col("mix_full") - 1)).otherwise(F.array().cast("array<long>"))
    epochs = F.concat(full, F.when(whole, F.array("mix_full")).otherwise(F.array().cast("array<long>")))
    out = placed.withColumn("mix_epoch", F.explode(epochs))
    # Of rows with the last key, as many as there is room for: equal rows are a number here too.
    edge = placed.where("mix_key = mix_edge")
    every = [x for c in keep for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    own = ["mix_tokens", "mix_source", "mix_key", "mix_full", "mix_weight", "mix_place"]
    same = edge.groupBy(*named, *own, "mix_copies").agg(F.count("*").alias("mix_n")).withColumn("mix_hash", F.xxhash64(*every))
    order = W.partitionBy("mix_source", "mix_place").orderBy("mix_hash", *named)
    before = F.sum("mix_n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("mix_n")
    room = F.least(F.col("mix_n"), F.col("mix_copies") - before)
    some = (same.withColumn("mix_room", room).where("mix_room > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), "mix_room")))
            .withColumn("mix_epoch", F.col("mix_full")))
    given = lambda df: df.select(*named, "mix_tokens", "mix_weight", "mix_epoch", turn("mix_epoch").alias("mix_block"),
                                 F.xxhash64(F.lit(seed), "mix_epoch", "mix_key").alias("mix_order"))
    return given(out).unionByName(given(some))
