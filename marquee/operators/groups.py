"""Group comparisons: membership, collections, directors, genres, years.

Sums and means use fixed-point aggregation (see ``functions.aggregates``)
with map-side partial aggregation, so a hot group is combined in every
task before the shuffle. Medians use ``group_median``, which never holds
a whole group in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.aggregates import exact_mean, exact_sum
from marquee.functions.columns import split_multi
from marquee.operators.metrics import add_metrics
from marquee.schemas import FRANCHISE_LABEL, STANDALONE_LABEL


def group_median(df: DataFrame, keys: Sequence[str], value: str | Column,
                 alias: str = "median", approx: bool = False,
                 accuracy: int = 10000) -> DataFrame:
    """Exact median (linear interpolation between the two middle values)
    of ``value`` per group of ``keys``; nulls and NaN are skipped, and a
    group without any other value has no row.

    Spark's ``percentile`` merges every distinct value of a group into one
    task. Here the middle ranks are found by narrowing value ranges, so no
    task holds a whole group:

    1. identical (key, value) pairs are counted (combined before the shuffle);
    2. they are counted again per (key, coarse range of the value), at most
       some 80,000 ranges a key, and the ranges of the middle ranks are kept;
    3. the same inside those, per fine range (relative width 2**-20);
    4. the values inside the fine ranges are ranked.

    The ranges are functions of the value alone and the steps are joined on
    values, so the result does not depend on partitioning, on the reuse of
    exchanges or on adaptive execution.

    ``approx=True`` uses the bounded-memory ``percentile_approx`` instead.
    """
    keys = list(keys)
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    named = df.select(*[F.col(k) for k in keys], v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    if approx:
        return named.groupBy(*keys).agg(F.percentile_approx("_v", 0.5, accuracy).alias(alias))
    counted = named.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_w"))
    return median_of_counts(counted, keys, alias)


def median_of_counts(counted: DataFrame, keys: Sequence[str], alias: str = "median") -> DataFrame:
    """Exact median per group of values that come with their counts
    (``_v``, ``_w``): steps 2 to 4 of ``group_median``."""
    keys = list(keys)
    ranged = counted.withColumn("_b0", _coarse(F.col("_v"))).withColumn("_b1", _fine(F.col("_v"), F.col("_b0")))

    total = Window.partitionBy(*keys)
    first = ranged.groupBy(*keys, "_b0").agg(F.sum("_w").alias("_w")).withColumn("_n", F.sum("_w").over(total))
    first = _middle(first, keys, ["_b0"], F.lit(0))
    second = _matched(ranged, first, keys, ["_b0"]).groupBy(*keys, "_b0", "_b1").agg(
        F.sum("_w").alias("_w"), F.min("_at").alias("_at"), F.min("_n").alias("_n"))
    second = _middle(second, [*keys, "_b0"], ["_b1"], F.col("_at"))
    third = _matched(ranged, second, keys, ["_b0", "_b1"])
    picked = _middle(third, [*keys, "_b0", "_b1"], ["_v"], F.col("_at"))
    lo, hi = _ranks()
    here = lambda r: (F.col("_at") <= r) & (r < F.col("_at") + F.col("_w"))
    out = picked.groupBy(*keys).agg(F.max(F.when(here(lo), F.col("_v"))).alias("_lo"),
                                    F.max(F.when(here(hi), F.col("_v"))).alias("_hi"))
    middle = F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(
        F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.lit(0.5))
    return out.select(*keys, middle.alias(alias))


def _coarse(v: Column) -> Column:
    """Number of a value's range of 1/16 octave; grows with the value."""
    size = F.when(F.abs(v) == float("inf"), F.lit(40000)).otherwise(
        F.floor(F.log2(F.abs(v)) * 16).cast("int") + 20000)
    return F.when(v == 0, F.lit(0)).otherwise(F.signum(v).cast("int") * size)


def _fine(v: Column, coarse: Column) -> Column:
    """Number of a value's part of its coarse range; grows with the value."""
    scale = F.pow(F.lit(2.0), (F.abs(coarse) - 20000) / F.lit(16.0))
    return F.when((v == 0) | (F.abs(v) == float("inf")), F.lit(0).cast("long")).otherwise(
        F.floor(v / scale * F.lit(float(1 << 20))).cast("long"))


def _ranks() -> tuple[Column, Column]:
    return F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)


def _middle(ranges: DataFrame, group: Sequence[str], order: Sequence[str], start: Column) -> DataFrame:
    """The rows of each group that hold a middle rank, with ``_at``, the
    0-based rank of their first value (``start``: that of the group's)."""
    run = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = ranges.withColumn("_at", start + F.sum("_w").over(run) - F.col("_w"))
    lo, hi = _ranks()
    end = F.col("_at") + F.col("_w")
    return placed.where(((F.col("_at") <= lo) & (lo < end)) | ((F.col("_at") <= hi) & (hi < end)))


def _matched(ranged: DataFrame, kept: DataFrame, keys: Sequence[str], bins: Sequence[str]) -> DataFrame:
    """The counted values inside the kept ranges (at most two a key), with
    the rank their range starts at."""
    on = [*keys, *bins]
    small = kept.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(on)], "_at", "_n")
    cond = F.lit(True)
    for i, c in enumerate(on):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k{i}"))
    return ranged.join(small, cond).drop(*[f"_k{i}" for i in range(len(on))])


def membership_label(df: DataFrame) -> Column:
    return F.when(F.col("belongs_to_collection").isNotNull(), F.lit(FRANCHISE_LABEL)) \
        .otherwise(F.lit(STANDALONE_LABEL))


def franchise_vs_standalone(df: DataFrame, approx: bool = False) -> DataFrame:
    """Titles in a collection vs standalone titles: mean revenue, median
    roi, mean budget, mean popularity, mean rating per label."""
    data = add_metrics(df).withColumn("is_franchise", membership_label(df))
    means = data.groupBy("is_franchise").agg(
        exact_mean("revenue_musd").alias("mean_revenue"),
        exact_mean("budget_musd").alias("mean_budget"),
        exact_mean("popularity").alias("mean_popularity"),
        exact_mean("vote_average").alias("mean_rating"),
    )
    med = group_median(data, ["is_franchise"], "roi", "median_roi", approx=approx)
    return means.join(med, "is_franchise", "left").select(
        "is_franchise", "mean_revenue", "median_roi", "mean_budget",
        "mean_popularity", "mean_rating").orderBy("is_franchise")


def franchise_summary(df: DataFrame, min_movies: int = 2, by_year: bool = False) -> DataFrame:
    """Per collection: titles, total / mean budget, total / mean revenue,
    mean rating; only collections with at least ``min_movies`` titles.
    ``by_year`` splits each collection by release year."""
    data = add_metrics(df).where(F.col("belongs_to_collection").isNotNull())
    keys = ["belongs_to_collection"]
    if by_year:
        data = data.withColumn("year", F.year("release_date"))
        keys.append("year")
    out = data.groupBy(*keys).agg(
        F.count("title").alias("num_movies"),
        exact_sum("budget_musd").alias("total_budget"),
        exact_mean("budget_musd").alias("mean_budget"),
        exact_sum("revenue_musd").alias("total_revenue"),
        exact_mean("revenue_musd").alias("mean_revenue"),
        exact_mean("vote_average").alias("mean_rating"),
    ).where(F.col("num_movies") >= F.lit(min_movies))
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), *keys)


def director_summary(df: DataFrame, by_year: bool = False) -> DataFrame:
    """Per director (a co-directed title counts in full for each):
    titles, total revenue, mean rating."""
    data = add_metrics(df).where(F.col("director").isNotNull()) \
        .withColumn("director", F.explode(split_multi("director")))
    keys = ["director"]
    if by_year:
        data = data.withColumn("year", F.year("release_date"))
        keys.append("year")
    out = data.groupBy(*keys).agg(
        F.count("title").alias("num_movies"),
        exact_sum("revenue_musd").alias("total_revenue"),
        exact_mean("vote_average").alias("mean_rating"),
    )
    return out.orderBy(F.col("total_revenue").desc_nulls_last(), *keys)


def roi_by_genre(df: DataFrame, approx: bool = False) -> DataFrame:
    """Median roi per genre; a title counts in each of its genres."""
    data = add_metrics(df).where(F.col("genres").isNotNull() & F.col("roi").isNotNull()) \
        .withColumn("genres", F.explode(split_multi("genres")))
    return group_median(data, ["genres"], "roi", "median_roi", approx=approx) \
        .orderBy(F.col("median_roi").asc(), "genres")


def yearly_box_office(df: DataFrame) -> DataFrame:
    """Total revenue per release year."""
    data = df.where(F.col("release_date").isNotNull() & F.col("revenue_musd").isNotNull())
    return data.groupBy(F.year("release_date").alias("year")) \
        .agg(exact_sum("revenue_musd").alias("total_revenue")).orderBy("year")


def value_counts(df: DataFrame, column: str, multi: bool = False) -> DataFrame:
    """How often each value occurs (nulls included), most frequent first.
    ``multi`` counts each item of a pipe-joined column."""
    data = df.select(F.explode_outer(split_multi(column)).alias(column)) if multi \
        else df.select(column)
    return data.groupBy(column).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), F.col(column).asc_nulls_first())


def impute_from_similar(df: DataFrame, column: str, by: str = "belongs_to_collection",
                        approx: bool = False) -> DataFrame:
    """Opt-in repair: fill a missing ``column`` with the median of the
    titles sharing ``by``; adds ``<column>_imputed``. Titles without a
    group, or whose group has no value, stay null; they take no part in the
    join, so they are not gathered under one null key."""
    med = group_median(df.where(F.col(by).isNotNull()), [by], column, "_fill", approx=approx)
    out = df.where(F.col(by).isNotNull()).join(med, by, "left").unionByName(
        df.where(F.col(by).isNull()).withColumn("_fill", F.lit(None).cast("double")))
    return out.withColumns({
        f"{column}_imputed": F.col(column).isNull() & F.col("_fill").isNotNull(),
        column: F.coalesce(F.col(column), F.col("_fill")),
    }).select(by, *[c for c in df.columns if c != by], f"{column}_imputed")
