"""Incremental ingest of raw title records.

Records arrive as JSON text, one object per line (a landing folder or a
stream). A record lacking a required key is rejected with the list of
keys it lacks; the accepted ones are turned into the raw-cache shape.
``gap_fill`` loads only the requested ids the cache does not hold yet.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.schemas import REQUIRED_KEYS


class NoUsableRecords(RuntimeError):
    """Nothing usable was ingested and there is no cache to fall back on."""


def to_json_lines(records: DataFrame, column: str = "value") -> DataFrame:
    """Records -> one JSON object per row. Null fields are left out, the
    way an upstream API omits absent keys."""
    return records.select(F.to_json(F.struct(*[F.col(c) for c in records.columns])).alias(column))


def missing_keys(text: str | Column, required: Sequence[str] = REQUIRED_KEYS) -> Column:
    """Required keys absent from a JSON object, in required order; a key
    present with a null value counts as present. Text that is not a JSON
    object lacks every key."""
    t = F.col(text) if isinstance(text, str) else text
    keys = F.coalesce(F.json_object_keys(t), F.array().cast("array<string>"))
    return F.filter(F.array(*[F.lit(k) for k in required]), lambda k: ~F.array_contains(keys, k))


def split_records(lines: DataFrame, column: str = "value",
                  required: Sequence[str] = REQUIRED_KEYS) -> tuple[DataFrame, DataFrame]:
    """(accepted lines, rejected lines with ``missing``)."""
    tagged = lines.withColumn("missing", missing_keys(column, required))
    return (tagged.where(F.size("missing") == 0).drop("missing"),
            tagged.where(F.size("missing") > 0))


def parse_records(lines: DataFrame, keys: Sequence[str], column: str = "value") -> DataFrame:
    """JSON lines -> raw-cache shape: one text column per key; nested
    objects and arrays come back as their JSON text."""
    schema = StructType([StructField(k, StringType()) for k in keys])
    return lines.select(F.from_json(F.col(column), schema).alias("_r")).select("_r.*")


def ingest(lines: DataFrame, keys: Sequence[str], column: str = "value",
           required: Sequence[str] = REQUIRED_KEYS) -> tuple[DataFrame, DataFrame]:
    """(accepted raw records, rejected lines). Lazy; see ``require_usable``."""
    good, bad = split_records(lines, column, required)
    return parse_records(good, keys, column), bad


def require_usable(records: DataFrame, cache: DataFrame | None = None) -> None:
    """Raise when no record is usable and no cache exists (one cheap job)."""
    if records.isEmpty() and (cache is None or cache.isEmpty()):
        raise NoUsableRecords("no usable title record was ingested")


def requested_ids(ids: DataFrame, column: str = "id") -> DataFrame:
    """Distinct integer ids of a request (non-integers dropped)."""
    return ids.select(F.col(column).try_cast("bigint").alias("id")).where(F.col("id").isNotNull()) \
        .distinct()


def gap_fill(cache: DataFrame, landing: DataFrame, requested: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cache + newly loaded, newly loaded). Only ids that are requested
    and not yet cached are taken from the landing records; all joins are
    semi / anti joins on the id (no record pairs are formed)."""
    req = requested_ids(requested)
    cached = cache.select(F.col("id").try_cast("bigint").alias("id")).where(F.col("id").isNotNull())
    gap = req.join(cached, "id", "left_anti")
    keyed = landing.withColumn("_id", F.col("id").try_cast("bigint"))
    new = keyed.join(gap.withColumnRenamed("id", "_id"), "_id", "left_semi").drop("_id")
    return cache.unionByName(new, allowMissingColumns=True), new


def gap_report(cache: DataFrame, landing: DataFrame, requested: DataFrame) -> DataFrame:
    """Every requested id with its outcome: ``cached`` (already in the
    cache), ``loaded`` (taken from the landing records now) or
    ``unavailable`` (in neither; the cache is kept as it is for it).
    Left joins of distinct ids, so each requested id appears once."""
    def ids(df: DataFrame, flag: str) -> DataFrame:
        return df.select(F.col("id").try_cast("bigint").alias("id")).where(F.col("id").isNotNull()) \
            .distinct().withColumn(flag, F.lit(True))

    out = requested_ids(requested).join(ids(cache, "_cached"), "id", "left") \
        .join(ids(landing, "_landed"), "id", "left")
    status = F.when(F.col("_cached"), F.lit("cached")).when(F.col("_landed"), F.lit("loaded")) \
        .otherwise(F.lit("unavailable"))
    return out.select("id", status.alias("status"))
