"""Calendar spine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def date_spine(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of a column, as ``full_date``.

    DATE covers years 1 to 9999, so the spine is at most some 3.7 million rows.
    """
    bounds = df.agg(F.min(column).alias("first"), F.max(column).alias("last")).where("first IS NOT NULL")
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def date_key(column: str) -> Column:
    """Integer key yyyymmdd."""
    return F.year(column) * 10000 + F.month(column) * 100 + F.day(column)
