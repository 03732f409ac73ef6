"""Nested fields: parse JSON text, then flatten to the clean text columns.

Parsing uses minimal projection schemas (only the fields read later), so
the JSON reader materialises nothing else. Flattening is one projection of
built-in higher-order functions; the parsed credits are read four times
but Catalyst keeps a single ``from_json`` for them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import array_size, directors, joined_names
from marquee.schemas import IRRELEVANT_COLUMNS, NESTED_SCHEMAS


def parse_nested(df: DataFrame, options: dict[str, str] | None = None) -> DataFrame:
    """JSON text -> struct / array for genres, collection, companies,
    countries, languages and credits. Text that does not parse becomes
    null (arrays) or a struct of nulls (credits, collection)."""
    opts = options or {}
    present = [c for c in NESTED_SCHEMAS if c in df.columns]
    return df.withColumns({c: F.from_json(F.col(c), NESTED_SCHEMAS[c], opts) for c in present})


def parse_health(df: DataFrame) -> dict[str, Column]:
    """Aggregate expressions for the two parse gates: rows whose genres
    parsed to a non-empty array holding a name, rows whose credits parsed
    to a cast or crew list. Both zero on a non-empty input means the
    nested text did not have the expected shape."""
    return {
        "rows": F.count(F.lit(1)),
        "genres_parsed": F.count_if(F.exists(F.col("genres"), lambda g: g["name"].isNotNull())),
        "credits_parsed": F.count_if(F.col("credits.cast").isNotNull() | F.col("credits.crew").isNotNull()),
    }


def flatten(df: DataFrame) -> DataFrame:
    """Drop irrelevant columns and turn the parsed nested fields into text:
    pipe-joined names, collection name, cast/crew sizes and directors.
    One projection."""
    cols = {
        "genres": joined_names(F.col("genres.name")),
        "belongs_to_collection": F.col("belongs_to_collection.name"),
        "production_companies": joined_names(F.col("production_companies.name")),
        "production_countries": joined_names(F.col("production_countries.name")),
        "spoken_languages": joined_names(F.col("spoken_languages.english_name")),
        "cast": joined_names(F.col("credits.cast.name")),
        "cast_size": array_size(F.col("credits.cast")),
        "director": directors(F.col("credits.crew")),
        "crew_size": array_size(F.col("credits.crew")),
    }
    dropped = set(IRRELEVANT_COLUMNS) | {"credits"}
    kept = [F.col(c) if c not in cols else cols[c].alias(c) for c in df.columns if c not in dropped]
    added = [e.alias(c) for c, e in cols.items() if c not in df.columns]
    return df.select(*kept, *added)
