"""Readers for the raw cache and the clean catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.schemas import CLEAN_COLUMNS, CLEAN_TYPES


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             multiline: bool = True, keys: list[str] | None = None) -> DataFrame:
    """Raw cache, every column as text. CSV: header names (bound by name,
    never by position), RFC-4180 quoting with doubled quotes, no type
    inference, and ``multiLine`` so line breaks inside quoted text stay in
    their cell (``multiline=False`` reads a CSV file in many tasks when no
    cell holds a line break). JSON lines: one column per key of ``keys`` (the
    declared raw keys when not given), scalars as their text and nested values
    as their original JSON text; no pass over the data looks for keys.
    Parquet caches may grow columns: all files' columns are read, null where
    a file lacks one. Parquet / JSON lines are splittable and preferred."""
    if fmt == "csv":
        return (spark.read.option("header", True).option("quote", '"').option("escape", '"')
                .option("multiLine", multiline).option("inferSchema", False).csv(path))
    if fmt == "json":
        from marquee.sources.ingest import parse_records
        from marquee.sources.starview import RAW_KEYS

        return parse_records(spark.read.text(path), keys or RAW_KEYS)
    df = spark.read.option("mergeSchema", True).format(fmt).load(path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_raw_if_exists(spark: SparkSession, path: str, fmt: str = "parquet",
                       schema: StructType | None = None) -> DataFrame:
    """The cache at ``path``, or an empty text frame when there is none."""
    from pyspark.errors import AnalysisException

    try:
        return read_raw(spark, path, fmt)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    empty = schema or StructType([StructField("id", StringType())])
    return spark.createDataFrame([], empty)


def typed_clean(df: DataFrame) -> DataFrame:
    """Re-type a clean catalogue read from text (CSV): numbers, dates and
    sizes by the contract, malformed -> null."""
    return df.select(*[
        (F.col(c).try_cast(CLEAN_TYPES[c]) if c in CLEAN_TYPES else F.col(c).cast("string")).alias(c)
        for c in CLEAN_COLUMNS if c in df.columns])


def read_clean(spark: SparkSession, path: str, fmt: str = "parquet",
               require_checked: bool = False) -> DataFrame:
    """The clean catalogue written by ``write_clean`` / ``preprocess``.
    ``require_checked`` refuses an output whose quality gates failed or
    never ran (no ``_checked`` marker written by ``preprocess``)."""
    if require_checked:
        from pyspark.errors import AnalysisException

        from marquee.operators.quality import QualityError

        try:
            spark.read.parquet(f"{path.rstrip('/')}/_checked").schema  # noqa: B018
        except AnalysisException as e:
            raise QualityError(f"{path} has not passed its quality gates") from e
    if fmt == "csv":
        from marquee.sources.sinks import CSV_NULL

        text = StructType([StructField(c, StringType()) for c in CLEAN_COLUMNS])
        return typed_clean(spark.read.schema(text).option("header", True).option("multiLine", True)
                           .option("quote", '"').option("escape", '"').options(**CSV_NULL).csv(path))
    return spark.read.format(fmt).load(path)
