"""Column expressions used across the catalogue operators.

All of these are built-in Spark expressions, so they stay inside
whole-stage codegen; none needs a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from marquee.schemas import DIRECTOR_JOB, MULTI_SEP, PLACEHOLDER_TEXT


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_of(dtype=StringType()) -> Column:
    return F.lit(None).cast(dtype)


def joined_names(items: str | Column, sep: str = MULTI_SEP) -> Column:
    """Join an array of names; a null or empty array (or one with only
    null names) gives null, never an empty string. Null items are skipped."""
    arr = F.filter(col_(items), lambda x: x.isNotNull())
    return F.when(F.size(arr) > 0, F.array_join(arr, sep)).otherwise(null_of())


def directors(crew: str | Column, sep: str = MULTI_SEP) -> Column:
    """Names of crew members whose job is exactly 'Director', in crew
    order, duplicates kept; null when there is none."""
    picked = F.transform(F.filter(col_(crew), lambda m: m["job"] == F.lit(DIRECTOR_JOB)),
                         lambda m: m["name"])
    return joined_names(picked, sep)


def array_size(arr: str | Column) -> Column:
    """Number of items; null for a null array (independent of the
    legacy size-of-null setting)."""
    a = col_(arr)
    return F.when(a.isNull(), F.lit(None).cast("int")).otherwise(F.size(a))


def to_double(c: str | Column) -> Column:
    """Text to double; malformed text and NaN become null."""
    v = col_(c).try_cast("double")
    return F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)


def to_long(c: str | Column) -> Column:
    """Text to long; malformed text (including '10.0') becomes null."""
    return col_(c).try_cast("bigint")


def to_date(c: str | Column) -> Column:
    """Text to date; malformed text becomes null."""
    return F.try_to_date(col_(c))


def zero_to_null(c: str | Column) -> Column:
    return F.nullif(col_(c), F.lit(0))


def placeholder_to_null(c: str | Column, placeholders: Iterable[str] = PLACEHOLDER_TEXT) -> Column:
    v = col_(c)
    return F.when(v.isin(list(placeholders)), null_of()).otherwise(v)


def contains_ci(c: str | Column, term: str) -> Column:
    """Case-insensitive literal substring test; null column -> null."""
    return F.contains(F.lower(col_(c)), F.lit(term.lower()))


def has_token_ci(c: str | Column, term: str, sep: str = MULTI_SEP) -> Column:
    """Case-insensitive whole-item test on a multi-valued text column."""
    t = term.lower()
    return F.exists(split_multi(c, sep), lambda x: F.lower(x) == F.lit(t))


def float_columns(df) -> list[str]:
    from pyspark.sql.types import DoubleType, FloatType

    return [f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]


def split_multi(c: str | Column, sep: str = MULTI_SEP) -> Column:
    """Split multi-valued text on a literal separator; empty items dropped."""
    import re

    parts = F.split(col_(c), re.escape(sep))
    return F.filter(parts, lambda x: x != F.lit(""))


def populated_count(columns: Iterable[str], float_columns: Iterable[str] = ()) -> Column:
    """How many of the given columns are non-null; NaN in one of
    ``float_columns`` counts as missing (as ``dropna`` does)."""
    floats = set(float_columns)
    terms = [(F.col(c).isNotNull() & ~F.isnan(F.col(c)) if c in floats else F.col(c).isNotNull())
             .cast("int") for c in columns]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total
