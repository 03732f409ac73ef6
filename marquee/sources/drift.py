"""Raw records as VARIANT cells: one type for any shape of record, and a
profile of how landings depart from the expected shape.

A landing is read without declaring its keys. ``shapes`` counts, per path and
type, the values of every record in one scan; ``drift`` sets them beside the
expected types and names unknown keys and changed types;
``raw_from_variant`` gives the raw-cache shape, so the usual cleaning runs
on records whose keys or types have moved.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from marquee.schemas import NESTED_SCHEMAS

DEPTH = 4
MALFORMED = "MALFORMED"


def as_variant(lines: DataFrame, column: str = "value", name: str = "record") -> DataFrame:
    """JSON text as VARIANT beside it; text that is not JSON gives null."""
    return lines.withColumn(name, F.try_parse_json(F.col(column)))


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID ..."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def shapes(records: DataFrame, by: Sequence[str] = (), column: str = "record", depth: int = DEPTH) -> DataFrame:
    """(by..., path, type, rows): how many values of each type lie at each
    path (``$.genres[*].name``), down to ``depth`` levels. A record that is
    null, because its text was no JSON, counts as ``MALFORMED`` at ``$``.

    Members are exploded level under level in one scan; a value is counted
    on the first of the rows that its own members make. A value with members
    shows its type by them, so only scalars and empty values are asked for
    theirs, and it is dropped when its members have been made. The lambda
    around that question keeps the levels in generated methods of their own:
    all of them in one are too large for the JVM to compile."""
    def asked(value: Column) -> Column:
        return F.get(F.transform(F.array(value), _kind), F.lit(0))

    spark = records.sparkSession
    # the level's value, and of every level up to it: path, type, place
    rows = records.select(*by, F.col(column).alias("_v"), F.lit("$").alias("_path0"))
    for d in range(1, depth + 1):
        above = [c for c in rows.columns if c != "_v"]
        kind = F.when(F.col("_key").isNotNull(), "OBJECT").when(F.col("_pos").isNotNull(), "ARRAY").otherwise(
            asked(F.col("_v")))
        path = F.concat(f"_path{d - 1}", F.when(F.col("_key").isNull(), F.lit("[*]")).otherwise(
            F.concat(F.lit("."), F.col("_key"))))
        rows = rows.lateralJoin(spark.tvf.variant_explode_outer(F.col("_v").outer()).select(
            F.col("pos").alias("_pos"), F.col("key").alias("_key"), F.col("value").alias("_member")))
        rows = rows.select(*above, kind.alias(f"_type{d - 1}"), F.col("_pos").alias(f"_at{d}"), path.alias(f"_path{d}"),
                           F.col("_member").alias("_v"))
    rows = rows.withColumn(f"_type{depth}", asked(F.col("_v"))).withColumn(
        "_type0", F.coalesce("_type0", F.lit(MALFORMED)))
    found = []
    for d in range(depth + 1):
        first = reduce(lambda a, b: a & b, [F.coalesce(F.col(f"_at{i}"), F.lit(0)) == 0
                                            for i in range(d + 1, depth + 1)], F.lit(True))
        found.append(F.when(first & F.col(f"_type{d}").isNotNull(), F.struct(
            F.col(f"_path{d}").alias("path"), F.col(f"_type{d}").alias("type"))))
    return rows.select(*by, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("x")).groupBy(
        *by, F.col("x.path").alias("path"), F.col("x.type").alias("type")).agg(F.count(F.lit(1)).alias("rows"))


def expected_types(keys: Sequence[str], scalar: Sequence[str] = ("STRING",)) -> dict[str, list[str]]:
    """Types allowed per path: nested keys as their projection schemas say,
    all other keys one of ``scalar``."""
    out: dict[str, list[str]] = {"$": ["OBJECT"]}

    def walk(path: str, kind: DataType) -> None:
        if isinstance(kind, ArrayType):
            out[path] = ["ARRAY"]
            walk(f"{path}[*]", kind.elementType)
        elif isinstance(kind, StructType):
            out[path] = ["OBJECT"]
            for f in kind.fields:
                walk(f"{path}.{f.name}", f.dataType)
        else:
            out[path] = ["STRING"]

    for key in keys:
        if key in NESTED_SCHEMAS:
            walk(f"$.{key}", NESTED_SCHEMAS[key])
        else:
            out[f"$.{key}"] = list(scalar)
    return out


def drift(shaped: DataFrame, expected: Mapping[str, Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """``shapes`` with a status: ``ok``; ``type changed``; ``unknown key``
    (a top-level key that is not one of ``keys``, and what lies under it);
    ``unread`` (any other path outside the expected ones, such as members
    that no projection reads). JSON nulls are ok anywhere they are known."""
    pairs = F.create_map(*[x for p, types in expected.items() for x in (F.lit(p), F.array(*map(F.lit, types)))])
    allowed = F.try_element_at(pairs, F.col("path"))
    top = F.regexp_extract("path", r"^\$\.([^.\[]*)", 1)
    status = (F.when((top != "") & ~top.isin(list(keys)), "unknown key")
              .when(allowed.isNull(), "unread")
              .when((F.col("type") == "VOID") | F.array_contains(allowed, F.col("type")), "ok")
              .otherwise("type changed"))
    return shaped.withColumn("status", status)


def raw_from_variant(records: DataFrame, keys: Sequence[str], column: str = "record") -> DataFrame:
    """Raw-cache shape: one text column per key. Scalars of any type as
    their text, objects and arrays as JSON text; absent keys, JSON nulls and
    records that are not objects are null."""
    return records.select(*[F.try_variant_get(F.col(column), f"$['{k}']", "string").alias(k) for k in keys])
