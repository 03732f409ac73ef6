"""Sinks: the raw cache and the clean catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


# one set of CSV options for every write; text is never trimmed
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
# the clean catalogue tells null from empty text in CSV
CSV_NULL = {"nullValue": "\\N", "emptyValue": ""}


def encode_raw(df: DataFrame) -> DataFrame:
    """Raw-cache shape: columns in sorted order, nested values (arrays,
    structs, maps) as JSON text, every other value as text. Text that is
    already JSON passes through unchanged (never encoded twice)."""
    cols = []
    for name in sorted(df.columns):
        dt = df.schema[name].dataType
        c = F.to_json(F.col(name)) if isinstance(dt, (ArrayType, StructType, MapType)) \
            else F.col(name).cast("string")
        cols.append(c.alias(name))
    return df.select(*cols)


def union_records(*frames: DataFrame) -> DataFrame:
    """Union by column name; a column missing from one side is null there."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def write_raw(df: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Write encoded records (parallel; append keeps the cache incremental)."""
    w = encode_raw(df).write.mode(mode)
    if fmt == "csv":
        w = w.options(**CSV_WRITE)
    w.format(fmt).save(path)


def write_clean(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Write the clean catalogue, in parallel by default. ``single_file``
    funnels the output through one task (only for small hand-off files)."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w = w.options(**CSV_WRITE, **CSV_NULL)
    w.format(fmt).save(path)
