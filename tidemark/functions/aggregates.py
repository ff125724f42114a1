"""Aggregate expressions. All of them combine on the map side.

Sums keep the input type, so decimal inputs add exactly; the division happens once,
on doubles, after aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def null_safe_sum(value: Column | str) -> Column:
    """Sum that is 0 when a group holds only NULLs."""
    return F.coalesce(F.sum(value), F.lit(0))


def mean(value: Column | str) -> Column:
    return F.sum(value).cast("double") / F.count(value)


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """sum(numerator) / sum(denominator), 0 when the denominator sums to 0."""
    below = F.sum(denominator).cast("double")
    return F.when(below == 0, F.lit(0.0)).otherwise(F.sum(numerator).cast("double") / below)


def count_where(condition: Column) -> Column:
    """Rows that meet ``condition``; a NULL condition does not count."""
    return F.sum(F.when(condition, 1).otherwise(0))
