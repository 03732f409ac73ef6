"""Stored sketches that answer later questions without the titles.

* Quantile sketches (KLL) of roi per genre and year; they roll up to genre,
  to year and to all, and give medians with a stated rank error.
* Distinct-count sketches (theta) of the ids of every landing; unions,
  overlaps and differences of any landings come from them alone.

A sketch has a bounded size whatever it has seen, is built by partial
aggregation in every task, and merges with others of its kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.columns import split_multi
from marquee.operators.groups import group_median
from marquee.operators.metrics import add_metrics

KLL_K = 200
THETA_BITS = 12


def rank_error(k: int = KLL_K) -> float:
    """Rank error of a KLL sketch of size k that is exceeded with a
    probability of about 1 %: 1.65 % at 200, in inverse proportion to k
    (to the power of 0.9). A sketch of up to k values is exact."""
    return 0.0165 * (200 / k) ** 0.9


def distinct_error(bits: int = THETA_BITS, deviations: float = 3.0) -> float:
    """Relative error of a theta sketch of 2**bits entries, at three standard
    deviations by default; exact up to that many ids."""
    return deviations / (2 ** bits - 1) ** 0.5


def roi_sketches(df: DataFrame, k: int = KLL_K) -> DataFrame:
    """(genre, year, n, sketch): roi of the titles with a genre and a roi; a
    title counts in each of its genres; year is null without a date."""
    data = add_metrics(df).where(F.col("genres").isNotNull() & F.col("roi").isNotNull()).select(
        F.explode(split_multi("genres")).alias("genre"), F.year("release_date").alias("year"), "roi")
    return data.groupBy("genre", "year").agg(F.count(F.lit(1)).alias("n"),
                                             F.kll_sketch_agg_double("roi", k).alias("sketch"))


def rolled_up(sketches: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sketches of coarser groups: ``keys``, n, sketch."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantile(column: str = "sketch", at: float = 0.5) -> Column:
    return F.kll_sketch_get_quantile_double(F.col(column), F.lit(float(at)))


def median_report(df: DataFrame, sketches: DataFrame) -> DataFrame:
    """Per genre, and for all genres together (null): n, the exact median,
    the sketch's, and the sketch's rank error, the distance of its median's
    rank interval among the titles from one half. A check of the stored
    sketches against the titles, so it reads both."""
    both = rolled_up(sketches, ["genre"]).unionByName(rolled_up(sketches).withColumn("genre", F.lit(None).cast("string")))
    of = both.select("genre", "n", quantile().alias("sketch_median"))
    rows = add_metrics(df).where(F.col("genres").isNotNull() & F.col("roi").isNotNull()).select(
        F.explode(split_multi("genres")).alias("genre"), "roi")
    rows = rows.unionByName(rows.withColumn("genre", F.lit(None).cast("string")))
    exact = group_median(rows, ["genre"], "roi", "exact_median").withColumnRenamed("genre", "_g")
    counted = rows.groupBy(F.col("genre").alias("_k"), "roi").agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.join(of, F.col("_k").eqNullSafe(F.col("genre"))).groupBy("genre", "n", "sketch_median").agg(
        F.sum(F.when(F.col("roi") < F.col("sketch_median"), F.col("_n")).otherwise(F.lit(0))).alias("_less"),
        F.sum(F.when(F.col("roi") <= F.col("sketch_median"), F.col("_n")).otherwise(F.lit(0))).alias("_most"))
    error = F.greatest(F.col("_less") / F.col("n") - 0.5, 0.5 - F.col("_most") / F.col("n"), F.lit(0.0))
    return placed.join(exact, F.col("genre").eqNullSafe(F.col("_g"))).select(
        "genre", "n", "exact_median", "sketch_median", error.alias("rank_error"))


def landing_sketches(records: DataFrame, landing: str = "landing", id_col: str = "id",
                     bits: int = THETA_BITS) -> DataFrame:
    """(landing, rows, sketch) of the integer ids of every landing; other
    ids and nulls are rows without a part in the sketch."""
    return records.groupBy(F.col(landing).alias("landing")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.theta_sketch_agg(F.col(id_col).try_cast("bigint"), bits).alias("sketch"))


def _estimate(sketch: Column) -> Column:
    return F.theta_sketch_estimate(sketch).cast("bigint")


def landing_overlaps(sketches: DataFrame, bits: int = THETA_BITS) -> DataFrame:
    """For every two landings: distinct ids of either (``union_ids``), in
    both (``shared_ids``) and in the first alone (``only_ids``). From the
    sketches alone: one row per landing, however many ids."""
    a = sketches.select(F.col("landing").alias("first"), F.col("sketch").alias("_a"))
    b = sketches.select(F.col("landing").alias("second"), F.col("sketch").alias("_b"))
    return a.join(b, F.col("first") < F.col("second")).select(
        "first", "second", _estimate(F.theta_union("_a", "_b", bits)).alias("union_ids"),
        _estimate(F.theta_intersection("_a", "_b")).alias("shared_ids"),
        _estimate(F.theta_difference("_a", "_b")).alias("only_ids"))
