"""Schemas and fixed values of the title catalogue.

Everything in the block marked FIXED VALUES must stay exactly as written:
the clean-column contract, the required ingest keys, the columns dropped
as irrelevant, the placeholder texts treated as missing and the nested
field names that are read out of the raw JSON.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the catalogue contract exactly; natural order)
# ---------------------------------------------------------------------------

# Final clean columns, in this order.
CLEAN_COLUMNS = [
    "id", "title", "tagline", "release_date", "genres", "belongs_to_collection",
    "original_language", "budget_musd", "revenue_musd", "production_companies",
    "production_countries", "vote_count", "vote_average", "popularity", "runtime",
    "overview", "spoken_languages", "poster_path", "cast", "cast_size",
    "director", "crew_size",
]

# A raw record missing any of these keys is rejected at ingest.
REQUIRED_KEYS = ["id", "title", "status", "budget", "revenue", "genres", "credits", "release_date"]

# Raw fields that hold nested JSON.
NESTED_KEYS = ["genres", "belongs_to_collection", "production_companies",
               "production_countries", "spoken_languages", "credits"]

# Columns with no analytic value, dropped when present.
IRRELEVANT_COLUMNS = ["adult", "imdb_id", "original_title", "video", "homepage"]

# Text that stands for "no value" in overview / tagline (exact match).
PLACEHOLDER_TEXT = ["No Data", "No overview found.", ""]

# Columns converted to double / to long.
DOUBLE_COLUMNS = ["budget", "popularity", "revenue", "runtime", "vote_average"]
LONG_COLUMNS = ["id", "vote_count"]

# Money, runtime: a zero means "unknown".
ZERO_IS_MISSING = ["budget", "revenue", "runtime"]

# The crew job that marks a director (case-sensitive).
DIRECTOR_JOB = "Director"

# Rows need at least this many populated fields to be kept.
MIN_POPULATED_FIELDS = 10

# The only status kept in the clean catalogue.
RELEASED = "Released"

# Earliest plausible release date.
EARLIEST_RELEASE = "1888-01-01"

# Ranking defaults: ROI rankings need budget >= 10 (million), rating
# rankings need >= 10 votes; a report shows 5 rows.
ROI_MIN_BUDGET = 10
RATING_MIN_VOTES = 10
TOP_N = 5

# Labels for titles inside / outside a collection.
FRANCHISE_LABEL = "Franchise"
STANDALONE_LABEL = "Standalone"

# Separator of multi-valued text columns.
MULTI_SEP = "|"

# ---------------------------------------------------------------------------
# Nested projection schemas: only the fields the catalogue reads.
# ---------------------------------------------------------------------------

NAME_LIST = ArrayType(StructType([StructField("name", StringType())]))
COLLECTION = StructType([StructField("name", StringType())])
LANGUAGE_LIST = ArrayType(StructType([StructField("english_name", StringType())]))
CREDITS = StructType([
    StructField("cast", ArrayType(StructType([StructField("name", StringType())]))),
    StructField("crew", ArrayType(StructType([
        StructField("name", StringType()),
        StructField("job", StringType()),
    ]))),
])

NESTED_SCHEMAS = {
    "genres": NAME_LIST,
    "belongs_to_collection": COLLECTION,
    "production_companies": NAME_LIST,
    "production_countries": NAME_LIST,
    "spoken_languages": LANGUAGE_LIST,
    "credits": CREDITS,
}

# Fixed-point type used for order-independent sums of money / scores.
# Musd values carry at most 6 decimals (whole dollars), ratings 3.
FIXED = DecimalType(24, 6)

# Types of the clean columns (text columns are strings).
CLEAN_TYPES = {
    "id": LongType(), "release_date": DateType(), "budget_musd": DoubleType(),
    "revenue_musd": DoubleType(), "vote_count": LongType(), "vote_average": DoubleType(),
    "popularity": DoubleType(), "runtime": DoubleType(), "cast_size": IntegerType(),
    "crew_size": IntegerType(),
}


def clean_schema() -> StructType:
    """The clean contract as a StructType (for typed re-reads)."""
    return StructType([StructField(c, CLEAN_TYPES.get(c, StringType())) for c in CLEAN_COLUMNS])
