"""Chart feeds: the data behind the five catalogue charts.

Drawing is left to the caller; each feed is a DataFrame. Point feeds can
be binned into a 2-D histogram, or sampled (``sampled``), so a feed stays
small at any scale.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.operators.groups import roi_by_genre, yearly_box_office
from marquee.operators.topn import first_per_group


def revenue_vs_budget(df: DataFrame) -> DataFrame:
    """(budget_musd, revenue_musd) of titles with both."""
    return df.where(F.col("budget_musd").isNotNull() & F.col("revenue_musd").isNotNull()) \
        .select("budget_musd", "revenue_musd")


def breakeven_end(df: DataFrame) -> DataFrame:
    """End of the break-even line: the largest budget or revenue among
    titles with both (null on an empty feed)."""
    pts = revenue_vs_budget(df)
    return pts.agg(F.greatest(F.max("budget_musd"), F.max("revenue_musd")).alias("breakeven_end"))


def popularity_vs_rating(df: DataFrame) -> DataFrame:
    """(vote_average, popularity) of titles with both."""
    return df.where(F.col("vote_average").isNotNull() & F.col("popularity").isNotNull()) \
        .select("vote_average", "popularity")


def membership_bars(df: DataFrame) -> DataFrame:
    """Mean revenue and mean budget per franchise / standalone label."""
    from marquee.functions.aggregates import exact_mean
    from marquee.operators.groups import membership_label

    return df.groupBy(membership_label(df).alias("is_franchise")).agg(
        exact_mean("revenue_musd").alias("mean_revenue"),
        exact_mean("budget_musd").alias("mean_budget")).orderBy("is_franchise")


def binned(points: DataFrame, x: str, y: str, width: float) -> DataFrame:
    """2-D histogram of a point feed: cell corner and count per cell."""
    return points.groupBy(
        (F.floor(F.col(x) / width) * width).alias(x),
        (F.floor(F.col(y) / width) * width).alias(y),
    ).agg(F.count(F.lit(1)).alias("n"))


def _priority() -> Column:
    """Where a title stands in the line for a sample: a hash of its id."""
    return F.md5(F.col("id").cast("string").cast("binary"))


def sampled(df: DataFrame, x: str, y: str, k: int) -> DataFrame:
    """A bottom-k sample of a point feed, by release year: year, id, x, y and
    stratum_rows, the number of points of the year (so k points stand for
    stratum_rows). Titles without a date are a stratum of their own.

    The k titles of least priority, a hash of the id, are taken, so the
    sample does not depend on partitioning, is uniform within a year, and
    samples of parts merge to the sample of the whole (``merge_samples``).
    Every task keeps k rows a year before the shuffle; nothing is sorted
    whole."""
    points = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(
        F.year("release_date").alias("year"), "id", x, y)
    counts = points.groupBy(F.col("year").alias("_year")).agg(F.count(F.lit(1)).alias("stratum_rows"))
    taken = first_per_group(points, ["year"], [_priority(), F.col("id")], k).drop("rank")
    return taken.join(counts, F.col("year").eqNullSafe(F.col("_year"))).select("year", "id", x, y, "stratum_rows")


def merge_samples(samples: Sequence[DataFrame], k: int) -> DataFrame:
    """The sample of the whole from samples (of k titles a year or more) of
    its parts; no title may be in two parts."""
    x, y = samples[0].columns[2:4]
    parts = [s.select("year", "id", x, y, "stratum_rows", F.lit(i).alias("_part")) for i, s in enumerate(samples)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    counts = rows.groupBy("year", "_part").agg(F.max("stratum_rows").alias("n")).groupBy(
        F.col("year").alias("_year")).agg(F.sum("n").alias("stratum_rows"))
    taken = first_per_group(rows.drop("stratum_rows", "_part"), ["year"], [_priority(), F.col("id")], k).drop("rank")
    return taken.join(counts, F.col("year").eqNullSafe(F.col("_year"))).select("year", "id", x, y, "stratum_rows")


def all_feeds(df: DataFrame, approx_median: bool = False, points_per_year: int | None = None) -> dict[str, DataFrame]:
    """The five chart feeds in their fixed, numbered order. With
    ``points_per_year`` the two point feeds are samples."""
    def points(feed, x: str, y: str) -> DataFrame:
        return feed(df) if points_per_year is None else sampled(df, x, y, points_per_year)

    return {
        "01-revenue-vs-budget": points(revenue_vs_budget, "budget_musd", "revenue_musd"),
        "02-roi-by-genre": roi_by_genre(df, approx=approx_median),
        "03-popularity-vs-rating": points(popularity_vs_rating, "vote_average", "popularity"),
        "04-yearly-box-office": yearly_box_office(df),
        "05-franchise-vs-standalone": membership_bars(df),
    }


def write_feeds(df: DataFrame, out_dir: str, fmt: str = "parquet", points_per_year: int | None = None) -> list[str]:
    """Write every feed under ``out_dir/<name>``; returns the paths."""
    paths = []
    for name, feed in all_feeds(df, points_per_year=points_per_year).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        feed.write.mode("overwrite").format(fmt).option("header", True).save(path)
        paths.append(path)
    return paths
