"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``. What a stage does with nulls, ties,
empty tables and other columns is said in ``salesguard.llm.stages``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salesguard.llm import queries
from salesguard.llm.stages import near_duplicates, packed, quality_rules, source_mixture, surrogates
from salesguard.session import cut

STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("pii_surrogates", surrogates),
          ("source_mixture", source_mixture), ("packing", packed)]

#: Learned rules, fingerprints and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and read again."""
    docs = queries.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
