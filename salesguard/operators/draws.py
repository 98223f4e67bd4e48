"""Random draws that any engine repeats.

A row's draw comes from the MD5 of its key: two numbers a, b below the prime
2^31 - 1, and (a + (i + 1) b) mod that prime for the i-th tree or start, so one
digest serves them all and the draws of two of them are independent. Draws
without a row (a tree's node) come from the MD5 of their name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = (1 << 31) - 1


def key_text(keys: list[str]) -> Column:
    """The key's columns as text, joined by ``|`` (null as empty)."""
    return F.concat_ws("|", *[F.coalesce(F.col(f"`{k}`").cast("string"), F.lit("")) for k in keys])


def pair(text: Column) -> tuple[Column, Column]:
    digest = F.md5(text.cast("binary"))
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long") % PRIME
    return part(1), part(17)


def draw(a: Column, b: Column, i: Column) -> Column:
    return (a + (i.cast("long") + 1) * b) % PRIME


def named(*name) -> tuple[int, float]:
    """A whole number below 2^32 and one between 0 and 1 for a name."""
    h = hashlib.md5("|".join(map(str, name)).encode()).hexdigest()
    return int(h[:8], 16), (int(h[8:16], 16) + 0.5) / 2 ** 32


def pair_sql(text: str) -> tuple[str, str]:
    """``pair`` in DuckDB."""
    return tuple(f"(('0x' || substr(md5({text}), {at}, 15))::BIGINT % {PRIME})" for at in (1, 17))


def draw_sql(a: str, b: str, i: str) -> str:
    return f"(({a} + ({i} + 1) * {b}) % {PRIME})"


def named_sql(text: str) -> tuple[str, str]:
    h = f"md5({text})"
    return f"('0x' || substr({h}, 1, 8))::BIGINT", f"((('0x' || substr({h}, 9, 8))::BIGINT + 0.5) / 4294967296.0::DOUBLE)"
