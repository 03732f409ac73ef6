"""Finding spellings of one value among the values of a column.

Values are blocked, never compared all with all: values of equal fingerprint
(lower case, words in order, each once) are one spelling group; groups whose
most frequent values, without spaces and marks, have the same set of letter
pairs meet in a block, where each is compared with the block's largest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import split_multi


def fingerprint(value: Column) -> Column:
    """Lower case; runs of anything but letters and digits separate words;
    distinct words in order."""
    words = F.filter(F.split(F.lower(value), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_join(F.array_sort(F.array_distinct(words)), " ")


def bare(value: Column) -> Column:
    """Lower-case letters and digits alone."""
    return F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", "")


def pair_key(text: Column) -> Column:
    """The distinct letter pairs of a text, in order; a single letter is its
    own key."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))),
                        lambda i: F.substring(text, i, F.lit(2)))
    return F.array_join(F.array_sort(F.array_distinct(pairs)), "")


def value_variants(df: DataFrame, column: str, multi: bool = False, max_distance: int = 2) -> DataFrame:
    """(value, n, canonical, distance): values that have another spelling.

    The most frequent value of a group (of equals the first by name) stands
    for it; a group whose bare value lies within ``max_distance`` edits of
    that of its block's largest group takes that one's value as canonical.
    ``distance`` is the Levenshtein distance of a value to its canonical one.
    Values alone with their canonical one are left out, as are nulls and
    values without a letter or digit. Blocks hold distinct values with their
    counts, combined before the shuffle."""
    values = df.select(F.explode(split_multi(column)).alias("value")) if multi else df.select(
        F.col(column).alias("value")).where(F.col("value").isNotNull())
    counted = values.groupBy("value").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "_print", fingerprint(F.col("value"))).where("_print != ''")
    groups = counted.groupBy(F.col("_print").alias("_group")).agg(
        F.sum("n").alias("_total"), F.min(F.struct((-F.col("n")).alias("less"), "value"))["value"].alias("_head"))
    keyed = groups.withColumn("_bare", bare(F.col("_head"))).withColumn("_key", pair_key(F.col("_bare")))
    blocks = keyed.groupBy(F.col("_key").alias("_block")).agg(
        F.min(F.struct((-F.col("_total")).alias("less"), "_head", "_bare")).alias("_top"))
    linked = keyed.join(blocks, F.col("_key") == F.col("_block")).select("_group", F.when(
        F.levenshtein("_bare", "_top._bare") <= max_distance, F.col("_top._head")).otherwise(
        F.col("_head")).alias("canonical"))
    met = counted.join(linked, F.col("_print") == F.col("_group")).select(
        "value", "n", "canonical", F.levenshtein("value", "canonical").alias("distance"))
    several = met.groupBy(F.col("canonical").alias("_c")).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    return met.join(several, F.col("canonical") == F.col("_c"), "left_semi")
