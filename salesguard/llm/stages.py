"""Stages of the corpus pipeline: the operators over a table of documents.

Each takes (spark, docs, sf_dir) and works on all rows; all but the last return
the columns they were given, in order, whatever other columns there are and
however they are named (they travel packed). Rows keep their other values.
"""

from __future__ import annotations

from functools import reduce

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesguard.llm import mixing, packing, pii, queries, rules, simhash


def packed_row(docs: DataFrame, *names: str) -> DataFrame:
    """The named columns, and ``row``, a struct of all others."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in names] or [F.lit(0).alias("none")]
    return docs.select(*names, F.struct(*rest).alias("row"))


def unpacked(df: DataFrame, docs: DataFrame, *names: str, **new) -> DataFrame:
    """The columns of ``docs``: the named ones as they are now, those in ``new``, the others from ``row``."""
    return df.select(*[(new[c] if c in new else F.col(c) if c in names else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or that a learned rule rejects go.

    Null, empty and blank texts have no words and go. Repeated rows are each
    judged, so they stay or go together. An empty table gives no rows; without
    labels (an empty table of them, or none that match) only the base decides.
    Long texts are judged whole."""
    judged = rules.judge(packed_row(docs, "doc_id", "text"), queries.table(spark, sf_dir, "labels"))
    return unpacked(judged.where("kept"), docs, "doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group stays: the one with the least id, and of
    rows that share it the one with the least hash of its text, then of all its
    columns. Null ids are larger than others. Groups are named by that key of a
    row, which is never null and has one text, so rows that repeat an id or have
    none stand for their own group each. Null and blank texts are one group; an
    empty table gives no rows; texts of any length are fingerprinted whole."""
    every = [x for c in docs.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    key = {"none": F.col("doc_id").isNull(), "id": F.col("doc_id"), "hash": F.xxhash64("text", F.col("text").isNull()),
           "row": F.xxhash64(*every)}
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] or [F.lit(0).alias("none")]
    keyed = docs.select("doc_id", "text", F.struct(*rest).alias("row"), F.struct(*[c.alias(k) for k, c in key.items()]).alias("key"))
    groups = simhash.near_duplicates(keyed.select("key", "text"), id_col="key", size=3, radius=2)
    first = groups.select("component_id").distinct()
    same = [F.col(f"key.{k}").eqNullSafe(F.col(f"component_id.{k}")) for k in key]
    kept = keyed.join(first, reduce(lambda x, y: x & y, same), "left_semi")
    return unpacked(kept.dropDuplicates(["key"]), docs, "doc_id", "text")


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced; ``n_chars`` follows the text.

    Texts without any stay byte for byte, null stays null (with null
    ``n_chars``); an entity has one surrogate in all rows, repeated ones
    included. An empty table gives no rows; long texts are scanned whole."""
    out = pii.replace(packed_row(docs, "doc_id", "text"), queries.KEY)
    new = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(out, docs, "doc_id", "text", **new)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Small sources are repeated, up to twice as often as large ones; every
    document stays. Rows come epoch by epoch, each epoch over many partitions,
    in the order of its permutation of blocks.

    Null sources are one source; null and empty texts count as one token;
    repeated rows are emitted each. An empty table gives no rows."""
    mixed = mixing.mix(packed_row(docs, "doc_id", "source", "text"), max_repeats=2.0)
    return unpacked(mixed.orderBy("mix_epoch", "mix_block", "mix_order"), docs, "doc_id", "source", "text")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids in sequences of 1024; the queues run in the order
    in which the mixture was written.

    Null and empty texts are their end id alone; rows that repeat an id are
    packed each; a long text is cut over many sequences. An empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path(queries.TOKENIZER), as_written=True)
