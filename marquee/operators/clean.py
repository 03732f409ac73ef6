"""Types, value repair and row cleaning (the raw -> clean contract).

``clean_catalogue`` is the whole chain: parse -> flatten -> types ->
rows. It is lazy; nothing here runs a Spark action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.columns import (
    float_columns,
    placeholder_to_null,
    populated_count,
    to_date,
    to_double,
    to_long,
    zero_to_null,
)
from marquee.operators.nested import flatten, parse_nested
from marquee.schemas import (
    CLEAN_COLUMNS,
    DOUBLE_COLUMNS,
    LONG_COLUMNS,
    MIN_POPULATED_FIELDS,
    RELEASED,
    ZERO_IS_MISSING,
)


def fix_types(df: DataFrame) -> DataFrame:
    """Text -> double / long / date (malformed -> null, NaN -> null), zero
    money and runtime -> null, money in millions, rating without votes ->
    null, placeholder overview/tagline -> null. Raw budget and revenue stay
    beside the new ``*_musd`` columns. One projection."""
    cols = set(df.columns)
    expr: dict[str, Column] = {}
    for c in df.columns:
        e = F.col(c)
        if c in DOUBLE_COLUMNS:
            e = to_double(e)
        elif c in LONG_COLUMNS:
            e = to_long(e)
        elif c == "release_date":
            e = to_date(e)
        if c in ZERO_IS_MISSING:
            e = zero_to_null(e)
        if c in ("overview", "tagline"):
            e = placeholder_to_null(e)
        expr[c] = e
    if "vote_average" in cols and "vote_count" in cols:
        expr["vote_average"] = F.when(expr["vote_count"] == 0, F.lit(None).cast("double")) \
            .otherwise(expr["vote_average"])
    out = [e.alias(c) for c, e in expr.items()]
    if "budget" in cols:
        out.append((expr["budget"] / F.lit(1_000_000)).alias("budget_musd"))
    if "revenue" in cols:
        out.append((expr["revenue"] / F.lit(1_000_000)).alias("revenue_musd"))
    return df.select(*out)


def drop_missing_keys(df: DataFrame) -> DataFrame:
    """Rows without id or title cannot be keyed or shown."""
    return df.dropna(subset=["id", "title"])


def dedupe_by_id(df: DataFrame, prefer: Sequence[Column] | None = None,
                 populated_of: Sequence[str] | None = None) -> DataFrame:
    """One row per id, chosen deterministically: the most populated row,
    then ``prefer`` (default: most popular), then a hash of the row.

    ``row_number() == 1`` plans as a WindowGroupLimit that drops losing
    duplicates on the map side before the shuffle, so an id repeated in a
    third of the rows still reaches one task as at most one row per input
    partition."""
    cols = list(populated_of or df.columns)
    order = [populated_count(cols, float_columns(df)).desc()]
    order += list(prefer) if prefer is not None else (
        [F.col("popularity").desc_nulls_last()] if "popularity" in df.columns else [])
    order.append(F.xxhash64(*[F.col(c) for c in df.columns]).asc())
    w = Window.partitionBy("id").orderBy(*order)
    return df.withColumn("_dup_rank", F.row_number().over(w)).where(F.col("_dup_rank") == 1) \
        .drop("_dup_rank")


def keep_populated(df: DataFrame, min_fields: int = MIN_POPULATED_FIELDS,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at least ``min_fields`` non-null (and non-NaN)
    values, counted over all current columns."""
    return df.dropna(thresh=min_fields, subset=list(columns) if columns else None)


def keep_released(df: DataFrame) -> DataFrame:
    """Keep status == 'Released' (exact; null drops), then drop status."""
    if "status" not in df.columns:
        return df
    return df.where(F.col("status") == F.lit(RELEASED)).drop("status")


def to_contract(df: DataFrame) -> DataFrame:
    """Select the clean contract columns that exist, in contract order."""
    return df.select(*[c for c in CLEAN_COLUMNS if c in df.columns])


def clean_rows(df: DataFrame, prefer: Sequence[Column] | None = None) -> DataFrame:
    """Drop keyless rows, de-duplicate ids, keep well-populated released
    titles, project to the contract."""
    out = drop_missing_keys(df)
    out = dedupe_by_id(out, prefer=prefer)
    out = keep_populated(out)
    out = keep_released(out)
    return to_contract(out)


def clean_catalogue(raw: DataFrame, prefer: Sequence[Column] | None = None) -> DataFrame:
    """Raw (all text, nested JSON text) -> the 22-column clean catalogue."""
    return clean_rows(fix_types(flatten(parse_nested(raw))), prefer=prefer)


def stage_counts(raw: DataFrame) -> DataFrame:
    """Rows kept after each cleaning stage as (stage, rows): raw, keyed
    (id and title present), deduplicated, populated, released. The
    de-duplication is the same ``dedupe_by_id`` the clean chain uses
    (map-side WindowGroupLimit), so a hot id never meets one task whole."""
    typed = fix_types(flatten(parse_nested(raw)))
    front = typed.agg(F.count(F.lit(1)).alias("raw"),
                      F.count_if(F.col("id").isNotNull() & F.col("title").isNotNull()).alias("keyed"))
    survivors = dedupe_by_id(drop_missing_keys(typed))
    populated = populated_count(survivors.columns, float_columns(survivors)) >= F.lit(MIN_POPULATED_FIELDS)
    released = (F.col("status") == F.lit(RELEASED)) if "status" in survivors.columns else F.lit(True)
    back = survivors.agg(F.count(F.lit(1)).alias("deduplicated"),
                         F.count_if(populated).alias("populated"),
                         F.count_if(populated & released).alias("released"))

    def _rows(df: DataFrame, names: list[str]) -> DataFrame:
        return df.select(F.explode(F.array(*[
            F.struct(F.lit(n).alias("stage"), F.col(n).cast("bigint").alias("rows")) for n in names
        ])).alias("e")).select("e.*")

    return _rows(front, ["raw", "keyed"]).unionByName(
        _rows(back, ["deduplicated", "populated", "released"]))
