"""Readers and SQL helpers.

Failures are not retried here and never turn into a missing result: Spark
retries tasks, and a failed read raises.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesguard.sources.tables import Catalog

VIEWS = ["fact_items", "outlets", "locations", "item_product_map", "offers", "items", "item_types",
         "item_categories", "products", "merchants", "calendar", "mobile_events"]


def read_sql(spark: SparkSession, sql: str, args: dict | None = None) -> DataFrame:
    """Run SQL text with named parameters (``:city``), never string formatting."""
    return spark.sql(sql, args=args or {})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, header: bool = True) -> DataFrame:
    """S3: CSV with a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              column: str | None = None, lower: int | None = None, upper: int | None = None,
              partitions: int | None = None) -> DataFrame:
    """A warehouse table over JDBC, split into ``partitions`` range reads on ``column``."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if column is not None:
        r = (r.option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
              .option("numPartitions", partitions))
    return r.load()


def register_views(cat: Catalog, prefix: str = "") -> list[str]:
    """Expose the canonical views to ``spark.sql`` (temp views, lazy)."""
    names = []
    for v in VIEWS:
        getattr(cat, v).createOrReplaceTempView(prefix + v)
        names.append(prefix + v)
    return names


def restrict_to(df: DataFrame, allowed: DataFrame, cols: list[str]) -> DataFrame:
    """Keep rows whose key occurs in ``allowed`` (left semi join; empty
    or one-element lists work, unlike an IN list built as text)."""
    return df.join(allowed.select(*cols).distinct(), cols, "left_semi")
