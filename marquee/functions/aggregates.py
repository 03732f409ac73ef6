"""Aggregate expressions with partition-independent results.

Double sums depend on the order rows are added in, so the same query can
give different last digits on a different partitioning. Values that a
fixed-point decimal holds exactly (up to 6 decimals, under 1e17) are summed
as such: associative, exact, and the same on 8 or 8,000 partitions. Any
other value (finer, larger, infinite) goes into a double sum beside it, so
nothing is rounded away, no size fails, and the mean divides by the count of
exactly the values that were added. NaN counts as missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions.columns import col_
from marquee.schemas import FIXED


def _parts(c: str | Column) -> tuple[Column, Column]:
    """(sum, count) of the non-missing values."""
    v = col_(c).cast("double")
    v = F.when(~F.isnan(v), v)
    plain = (F.abs(v) < F.lit(1e17)) & (F.round(v, 6) == v)
    exact = F.sum(F.when(plain, F.when(plain, v).otherwise(F.lit(0.0)).cast(FIXED))).cast("double")
    rest = F.sum(F.when(~plain, v))
    return F.when(exact.isNull(), rest).when(rest.isNull(), exact).otherwise(exact + rest), F.count(v)


def exact_sum(c: str | Column) -> Column:
    """Sum, returned as double (null when no values)."""
    return _parts(c)[0]


def exact_mean(c: str | Column) -> Column:
    """Mean over the non-missing values."""
    total, n = _parts(c)
    return F.when(n > 0, total / n)
