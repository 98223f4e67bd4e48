"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def week_of_month(d) -> Column:
    """Day 1-7 -> 1, 8-14 -> 2, 15-21 -> 3, 22-28 -> 4, else 5."""
    day = F.dayofmonth(col(d))
    return (F.when(day <= 7, 1).when(day <= 14, 2).when(day <= 21, 3)
             .when(day <= 28, 4).otherwise(5))


def dow_sunday0(d) -> Column:
    """Day of week with Sunday = 0 (warehouse ``date_part(dow)``)."""
    return F.dayofweek(col(d)) - 1


def weekday_monday0(d) -> Column:
    """pandas ``dayofweek``: Monday = 0 ... Sunday = 6."""
    return F.weekday(col(d))


def is_workday(d) -> Column:
    return F.when(F.weekday(col(d)) < 5, 1).otherwise(0)


def money(c, digits: int = 2) -> Column:
    """Half-even rounding of ``x * 10^d`` (numpy's ``round``: binary, not decimal text)."""
    m = float(10 ** digits)
    return F.bround(col(c) * m, 0) / m


def r6(c) -> Column:
    """Output rounding of derived doubles: half away from zero on ``x * 1e6``."""
    return F.round(col(c) * 1e6, 0) / 1e6


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero divisor (ANSI mode raises)."""
    return F.try_divide(col(a), col(b))


def flag(cond: Column) -> Column:
    """0/1 integer flag; NULL conditions count as false."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def boxcox(x, lam) -> Column:
    """Box-Cox transform ``(x^l - 1)/l``, ``ln x`` at ``l = 0``."""
    x, lam = col(x), col(lam)
    return F.when(lam == 0, F.ln(x)).otherwise((F.pow(x, lam) - 1) / lam)


def sample_skewness(x, n) -> Column:
    """Bias-adjusted skewness G1 from Spark's population ``skewness``."""
    n = col(n).cast("double")
    return F.when(n >= 3, F.skewness(col(x)) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x, n) -> Column:
    """Bias-adjusted excess kurtosis G2 from Spark's population ``kurtosis``."""
    n = col(n).cast("double")
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(col(x)) + 6))


def after_date(c, value: str, fmt: str = "yyyy-MM-dd") -> Column:
    """Rows after a date given as text in an explicit format."""
    return col(c) > F.to_date(F.lit(value), fmt)


def ist(ts) -> Column:
    """shift a UTC timestamp by +5:30 (interval arithmetic, no time-zone table)."""
    return col(ts) + F.expr("INTERVAL '5:30' HOUR TO MINUTE")


def calendar_features(d) -> list[Column]:
    """hour, ISO week, day, month, weekday (Monday = 0) and workday flag."""
    c = col(d)
    return [F.hour(c.cast("timestamp_ntz")).alias("hours"), F.weekofyear(c).alias("week"),
            F.dayofmonth(c).alias("day"), F.month(c).alias("month"), F.weekday(c).alias("DayOfTheWeek"),
            is_workday(c).alias("WeekDay")]
