"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"          # the separators of a word: \x20 and \x09-\x0D
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def words(text: Column) -> Column:
    """Array of the maximal runs of non-separators; null or blank text gives none."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, "[ \\t\\n\\x0B\\f\\r]+"))


def need(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so extra ones can't clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])
