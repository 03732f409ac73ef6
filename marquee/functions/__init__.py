"""Column expressions and aggregate helpers."""

from marquee.functions.aggregates import exact_mean, exact_sum
from marquee.functions.columns import (
    array_size,
    contains_ci,
    directors,
    has_token_ci,
    joined_names,
    placeholder_to_null,
    populated_count,
    split_multi,
    to_date,
    to_double,
    to_long,
    zero_to_null,
)

__all__ = [
    "array_size", "contains_ci", "directors", "exact_mean", "exact_sum",
    "has_token_ci", "joined_names", "placeholder_to_null", "populated_count",
    "split_multi", "to_date", "to_double", "to_long", "zero_to_null",
]
