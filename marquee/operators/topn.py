"""The first n rows of every group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# up to here Spark cuts every group on the map side (its default of
# spark.sql.optimizer.windowGroupLimitThreshold)
GROUP_LIMIT = 1000
SPREAD = 256


def first_per_group(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int,
                    spread_by: Sequence[str] = ("id",), rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their ``rank`` from 1.

    Up to ``GROUP_LIMIT`` rows a group, Spark keeps n rows per map task and
    group before the shuffle. Beyond it, groups are first cut in ``SPREAD``
    parts by a hash of ``spread_by``, so that a group holding most rows is
    sorted in many tasks, and then once more over what is left."""
    n = max(int(n), 0)
    if n > GROUP_LIMIT:
        part = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(SPREAD))
        inner = Window.partitionBy(*groups, "__part").orderBy(*order)
        df = df.withColumn("__part", part).withColumn(rank, F.row_number().over(inner)).where(
            F.col(rank) <= n).drop("__part", rank)
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*groups).orderBy(*order))).where(
        F.col(rank) <= n)
