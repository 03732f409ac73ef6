"""Reports over time: every year of a key's span, running totals, change."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.aggregates import exact_sum
from marquee.functions.columns import split_multi
from marquee.schemas import FIXED


def over_time(df: DataFrame, key: str, multi: bool = False) -> DataFrame:
    """Per value of ``key`` (each item of it with ``multi``) and year, from
    its first to its last: num_movies, total_revenue (0 in a year without
    titles), running_movies, running_revenue, and revenue_change, the
    difference to the year before (null in the first year).

    Titles without key or date take no part. Only sums per key and year are
    shuffled; a key's window holds its years, not its titles. Running sums
    are taken in decimals, so they do not depend on the order of addition."""
    data = df.where(F.col("release_date").isNotNull()).withColumn("year", F.year("release_date"))
    data = data.withColumn(key, F.explode(split_multi(key))) if multi else data.where(F.col(key).isNotNull())
    yearly = data.groupBy(key, "year").agg(F.count("title").alias("num_movies"),
                                           F.coalesce(exact_sum("revenue_musd"), F.lit(0.0)).alias("total_revenue"))
    span = data.groupBy(F.col(key).alias("_key")).agg(F.min("year").alias("_first"), F.max("year").alias("_last"))
    spine = span.select("_key", F.explode(F.sequence("_first", "_last")).alias("_year"))
    full = spine.join(yearly, (F.col("_key") == F.col(key)) & (F.col("_year") == F.col("year")), "left").select(
        F.col("_key").alias(key), F.col("_year").alias("year"), F.coalesce("num_movies", F.lit(0)).alias("num_movies"),
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"))
    order = Window.partitionBy(key).orderBy("year")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    money = F.col("total_revenue").cast(FIXED)
    return full.withColumns({
        "running_movies": F.sum("num_movies").over(so_far),
        "running_revenue": F.sum(money).over(so_far).cast("double"),
        "revenue_change": (money - F.lag(money).over(order)).cast("double"),
    })
