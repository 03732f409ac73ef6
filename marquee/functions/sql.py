"""SQL functions for the catalogue, for users of ``spark.sql``.

They are SQL-bodied functions (``CREATE TEMPORARY FUNCTION ... RETURN``):
Catalyst inlines their bodies into the plan, so they run inside
whole-stage codegen like any built-in and never start a Python worker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.schemas import (
    DIRECTOR_JOB,
    FRANCHISE_LABEL,
    MULTI_SEP,
    PLACEHOLDER_TEXT,
    STANDALONE_LABEL,
)

def _lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SEP_RE = "[" + MULTI_SEP + "]"
_PLACEHOLDERS = ", ".join(_lit(t) for t in PLACEHOLDER_TEXT)
_DIRECTOR = _lit(DIRECTOR_JOB)

_FUNCTIONS = {
    "mq_joined_names": (
        "items ARRAY<STRING>", "STRING",
        "CASE WHEN size(filter(items, x -> x IS NOT NULL)) > 0 "
        f"THEN array_join(filter(items, x -> x IS NOT NULL), {_lit(MULTI_SEP)}) END"),
    "mq_directors": (
        "crew ARRAY<STRUCT<name: STRING, job: STRING>>", "STRING",
        f"CASE WHEN size(filter(crew, m -> m.job = {_DIRECTOR} AND m.name IS NOT NULL)) > 0 "
        f"THEN array_join(transform(filter(crew, m -> m.job = {_DIRECTOR} AND m.name IS NOT NULL), "
        f"m -> m.name), {_lit(MULTI_SEP)}) END"),
    "mq_profit": ("revenue DOUBLE, budget DOUBLE", "DOUBLE", "revenue - budget"),
    "mq_roi": ("revenue DOUBLE, budget DOUBLE", "DOUBLE", "try_divide(revenue, budget)"),
    "mq_musd": ("amount DOUBLE", "DOUBLE", "nullif(amount, 0) / 1000000"),
    "mq_placeholder_null": (
        "text STRING", "STRING",
        f"CASE WHEN text IN ({_PLACEHOLDERS}) THEN NULL ELSE text END"),
    "mq_membership": (
        "collection STRING", "STRING",
        f"CASE WHEN collection IS NOT NULL THEN {_lit(FRANCHISE_LABEL)} ELSE {_lit(STANDALONE_LABEL)} END"),
    "mq_has_item": (
        "multi STRING, item STRING", "BOOLEAN",
        f"exists(split(multi, {_lit(_SEP_RE)}), x -> lower(x) = lower(item))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the catalogue's SQL functions as temporary functions."""
    for name, (params, returns, body) in _FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) "
                  f"RETURNS {returns} RETURN {body}")
    return list(_FUNCTIONS)


def register_catalogue(clean: DataFrame, name: str = "titles") -> str:
    """Expose a clean catalogue to SQL as a temporary view (and the
    functions above)."""
    register_sql_functions(clean.sparkSession)
    clean.createOrReplaceTempView(name)
    return name
