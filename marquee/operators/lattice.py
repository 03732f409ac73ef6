"""Filling missing values from similar titles, by a lattice of levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import split_multi
from marquee.operators.groups import group_median

LEVELS = ("collection", "director and genre", "genre", "year")


def _keys() -> Column:
    """The groups a title belongs to, as an array of (level, key); level 0
    is the finest."""
    empty = F.array().cast("array<string>")
    genres = F.array_distinct(F.coalesce(split_multi("genres"), empty))
    directors = F.array_distinct(F.coalesce(split_multi("director"), empty))
    pairs = F.flatten(F.transform(directors, lambda d: F.transform(genres, lambda g: F.concat(d, F.lit(" / "), g))))
    groups = (F.array("belongs_to_collection"), pairs, genres, F.array(F.year("release_date").cast("string")))
    return F.concat(*[_tag(g, i) for i, g in enumerate(groups)])


def _tag(keys: Column, level: int) -> Column:
    return F.transform(F.filter(keys, lambda k: k.isNotNull()),
                       lambda k: F.struct(F.lit(level).alias("level"), k.alias("key")))


def impute_from_lattice(df: DataFrame, column: str, min_support: int = 3) -> DataFrame:
    """``df`` with missing values of ``column`` filled by the median of a
    group of similar titles, and ``<column>_level``, the level used (null
    where nothing was filled).

    Levels go from fine to coarse: the collection, a director together with
    a genre, a genre, the release year. The finest level counts that has a
    group with at least ``min_support`` known values; of several groups
    there the one with most of them, then the first by name. Titles without
    such a group stay null.

    All levels are aggregated at once, from one row per title and group
    (grouping sets over multi-valued columns); only titles that miss the
    value look their groups up."""
    tagged = df.select(F.col(column).cast("double").alias("_value"), F.explode(_keys()).alias("_g")).select(
        F.col("_g.level").alias("_level"), F.col("_g.key").alias("_key"), "_value").where(
        F.col("_value").isNotNull() & ~F.isnan("_value"))
    support = tagged.groupBy("_level", "_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_support)
    medians = group_median(tagged.join(support, ["_level", "_key"], "left_semi"), ["_level", "_key"], "_value", "_fill")
    groups = medians.join(support, ["_level", "_key"])
    missing = df.where(F.col(column).isNull()).select("id", F.explode(_keys()).alias("_g")).select(
        "id", F.col("_g.level").alias("_level"), F.col("_g.key").alias("_key"))
    best = missing.join(groups, ["_level", "_key"]).groupBy("id").agg(
        F.min(F.struct("_level", (-F.col("_n")).alias("_less"), "_key", "_fill")).alias("_best"))
    names = F.element_at(F.array(*map(F.lit, LEVELS)), F.col("_best._level") + 1)
    filled = df.join(best.select(F.col("id").alias("_id"), "_best"), F.col("id") == F.col("_id"), "left")
    gap = F.col(column).isNull() & F.col("_best").isNotNull()
    return filled.select(*[F.when(gap, F.col("_best._fill")).otherwise(F.col(column)).alias(column)
                           if c == column else F.col(c) for c in df.columns],
                         F.when(gap, names).alias(f"{column}_level"))
