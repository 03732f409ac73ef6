"""Derived KPI columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def add_metrics(df: DataFrame) -> DataFrame:
    """profit_musd = revenue - budget; roi = revenue / budget.
    Null in -> null out; a zero budget gives a null roi instead of an error."""
    return df.withColumns({
        "profit_musd": F.col("revenue_musd") - F.col("budget_musd"),
        "roi": F.try_divide(F.col("revenue_musd"), F.col("budget_musd")),
    })
