"""Gold: the star schema and the two KPI views. Reads silver only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_key
from ..operators.spine import date_key, date_spine
from ..schemas import GOLD, conform

Store = Callable[[DataFrame], DataFrame]


def dim_date(movies: DataFrame) -> DataFrame:
    """One row per day between the first and the last release."""
    days = date_spine(movies, "release_date").select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("calendar_year"),
        F.quarter("full_date").alias("calendar_quarter"),
        F.month("full_date").alias("calendar_month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
    )
    return conform(days, GOLD["dim_date"])


def dim_language(movies: DataFrame, store: Store) -> DataFrame:
    codes = movies.where("original_language IS NOT NULL").select(
        F.col("original_language").alias("language_code")
    ).distinct()
    return conform(dense_key(codes, ["language_code"], "language_key", store), GOLD["dim_language"])


def dim_genre(genres: DataFrame, store: Store) -> DataFrame:
    return conform(dense_key(genres, ["genre_name", "genre_id"], "genre_key", store), GOLD["dim_genre"])


def keyed_movies(movies: DataFrame, store: Store) -> DataFrame:
    """Silver movies with their surrogate key. Dimension and fact are both projections of this; neither has the time of
    ingestion, which is not moved."""
    return dense_key(movies.drop("ingested_at"), ["movie_id"], "movie_key", store)


def dim_movie(keyed: DataFrame) -> DataFrame:
    return conform(keyed, GOLD["dim_movie"])


def fact_movie(keyed: DataFrame, dim_language: DataFrame) -> DataFrame:
    """One row per movie. The key comes with the frame and the date key is arithmetic (the date
    dimension covers every release date), so the language lookup is the only join."""
    budget, revenue = F.col("budget"), F.col("revenue")
    profit = revenue - budget
    facts = keyed.join(
        dim_language, keyed.original_language == dim_language.language_code, "left"
    ).select(
        "movie_key",
        date_key("release_date").alias("date_key"),
        "language_key",
        "budget",
        "revenue",
        profit.alias("profit"),
        (profit.cast("double") / F.nullif(budget, F.lit(0))).alias("roi"),
        "runtime",
        "vote_average",
        "vote_count",
        "popularity",
    )
    return conform(facts, GOLD["fact_movie"])


def bridge_movie_genre(movie_genres: DataFrame, dim_movie: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Movie/genre key pairs; ids unknown to either dimension are dropped.

    The small dimension goes first, so unknown genres leave before the join on the movie.
    """
    pairs = (
        movie_genres.join(dim_genre.select("genre_id", "genre_key"), "genre_id")
        .join(dim_movie.select("movie_id", "movie_key"), "movie_id")
        .select("movie_key", "genre_key")
    )
    return conform(pairs, GOLD["bridge_movie_genre"])


# The views name their tables through the namespaces filled in below.
KPI_VIEWS = {
    "kpi_by_genre_year": """
        SELECT d.calendar_year, g.genre_name, count(*) AS movie_count,
          avg(f.vote_average) AS average_rating, sum(f.revenue) AS total_revenue
        FROM {gold}.bridge_movie_genre b
        JOIN {gold}.dim_genre g ON b.genre_key = g.genre_key
        JOIN {gold}.fact_movie f ON b.movie_key = f.movie_key
        JOIN {gold}.dim_date d ON f.date_key = d.date_key
        GROUP BY d.calendar_year, g.genre_name""",
    # Fact and dimension meet first: both have one row per movie, and the longer company bridge is
    # then shuffled once.
    "kpi_studio_performance": """
        SELECT c.company_name, count(*) AS movie_count,
          sum(m.revenue) AS total_revenue, avg(m.vote_average) AS average_rating
        FROM {silver}.movie_companies c
        JOIN (SELECT d.movie_id, f.revenue, f.vote_average
              FROM {gold}.fact_movie f JOIN {gold}.dim_movie d ON f.movie_key = d.movie_key) m
          ON c.movie_id = m.movie_id
        GROUP BY c.company_name""",
}


def studio_performance(
    movie_companies: DataFrame, dim_movie: DataFrame, fact: DataFrame, collation: str | None = None
) -> DataFrame:
    """The studio KPI as a frame. A collation such as ``UTF8_LCASE`` merges spellings of a name."""
    company = F.col("company_name") if collation is None else F.collate("company_name", collation)
    movies = fact.join(dim_movie.select("movie_key", "movie_id"), "movie_key")
    return (
        movie_companies.join(movies, "movie_id")
        .groupBy(company.alias("company_name"))
        .agg(
            F.count("*").alias("movie_count"),
            F.sum("revenue").alias("total_revenue"),
            F.avg("vote_average").alias("average_rating"),
        )
    )
