"""Numeric expressions: floors, safe ratios, exact sums, text of rates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Values are added with this many decimals, far below any rounding used; a sum may
# reach 1e26 and a single value 1e16.
ADDED_AS = "decimal(28,12)"


def at_least(value: Column, floor: float | int, default: float | int | None = None) -> Column:
    """The larger of value and floor, with NULL taken as ``default``.

    Without a default NULL stays NULL: Spark's ``greatest`` alone would skip it.
    """
    if default is None:
        return F.when(value.isNotNull(), F.greatest(value, F.lit(floor)))
    return F.greatest(F.coalesce(value, F.lit(default)), F.lit(floor))


def safe_divide(dividend: Column, divisor: Column) -> Column:
    """NULL instead of an error for a zero or missing divisor."""
    return F.try_divide(dividend, divisor)


def exact_sum(value: Column) -> Column:
    """Sum of a double column that does not depend on the order of the rows.

    A sum of doubles changes with the order in which shuffled parts arrive, so
    a retried or repeated job could round to another cent. Values are added as
    decimals instead, whatever their number and size. Infinities and NaN have no
    decimal: a group that holds any has their sum.
    """
    double = value.cast("double")
    unusual = F.isnan(double) | (F.abs(double) == float("inf"))
    total = F.sum(F.when(~unusual, double).cast(ADDED_AS)).cast("double")
    return F.coalesce(F.sum(F.when(unusual, double)), total)


def exact_avg(value: Column) -> Column:
    return safe_divide(exact_sum(value), F.count(value))


def avg_rate(rate: Column) -> Column:
    """Mean of a ratio column, likewise independent of the order of the rows."""
    return exact_avg(rate)


def share(condition: Column, digits: int = 4) -> Column:
    """Rows meeting the condition out of all rows of the group."""
    return F.round(safe_divide(F.count_if(condition), F.count(F.lit(1))), digits)


def percentiles(name: str, *fractions: float) -> Column:
    """Array of the first values, rounded to cents, that reach each share of the rows.

    Exact for any number of rows and any partitioning: tasks count the distinct
    cents of each group and add up the counts, so what a group takes is bounded by
    its distinct cents, not by its rows. NULLs do not count.
    """
    exact = "percentile_disc({}) WITHIN GROUP (ORDER BY round(`{}`, 2))"
    return F.array(*[F.expr(exact.format(fraction, name)) for fraction in fractions])


def percent_text(rate: Column, digits: int = 2) -> Column:
    """0.0712 as ``7.12%``."""
    return F.format_string(f"%.{digits}f%%", F.round(rate.cast("double"), digits + 2) * 100)
