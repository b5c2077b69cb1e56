"""Named report measures: aggregate Columns over the fact's grain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DIGITS = 6


def total_revenue() -> Column:
    return F.sum("revenue").alias("total_revenue")


def total_budget() -> Column:
    return F.sum("budget").alias("total_budget")


def total_profit() -> Column:
    """Difference of the two totals, each skipping its own NULLs; a missing total counts as 0.

    Not the sum of ``profit``: that one leaves out movies where either side is unknown.
    """
    revenue, budget = F.sum("revenue"), F.sum("budget")
    return F.coalesce(revenue - budget, revenue, -budget).alias("total_profit")


def known_profit() -> Column:
    """Sum of the movies whose budget and revenue are both known."""
    return F.sum("profit").alias("known_profit")


def avg_roi() -> Column:
    """Mean of the ratios, not the ratio of the sums."""
    return F.round(F.avg("roi"), DIGITS).alias("avg_roi")


def avg_rating() -> Column:
    return F.round(F.avg("vote_average"), DIGITS).alias("avg_rating")


def movie_count() -> Column:
    """Number of movies where ``movie_key`` cannot repeat: on the fact, or within one genre.

    There it equals the distinct count, without the shuffle on the key. Filters on the bridge are
    semi joins for the same reason: they never repeat a movie.
    """
    return F.count("movie_key").alias("movie_count")


def hit_rate() -> Column:
    """Share of movies earning more than their budget, among those with both known."""
    return F.round(F.avg((F.col("revenue") > F.col("budget")).cast("int")), DIGITS).alias("hit_rate")


def budget_band() -> Column:
    """Order of magnitude of the budget, for grouping."""
    budget = F.col("budget")
    return (
        F.when(budget.isNull(), "unknown")
        .when(budget < 50_000, "under 50k")
        .when(budget < 150_000, "50k to 150k")
        .when(budget < 300_000, "150k to 300k")
        .otherwise("300k and over")
    )
