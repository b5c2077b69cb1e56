"""The questions asked of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as m
from ..operators.dedup import keep_first
from ..operators.reconcile import union_all

DEFAULT_TOP = 10
DEFAULT_MIN_VOTES = 10


def overview_kpis(fact: DataFrame, bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Headline figures, and when anything was last ingested, whether or not it won.

    ``as_of`` tells the latter where it is known already (``Lake.as_of``); else bronze is read for it.
    """
    if as_of is None:
        as_of = bronze.agg(F.max("ingested_at").alias("at")).scalar()
    return _headline(fact).withColumn("data_as_of", as_of)


def _headline(fact: DataFrame) -> DataFrame:
    return fact.agg(
        m.total_revenue(), m.total_budget(), m.total_profit(), m.known_profit(), m.avg_roi(),
        m.movie_count(), m.avg_rating(),
    )


def sliced(
    fact: DataFrame,
    dim_date: DataFrame,
    bridge: DataFrame,
    dim_genre: DataFrame,
    years: tuple[int, int] | None = None,
    genres: list[str] | None = None,
) -> DataFrame:
    """Fact rows inside a release-year range and having one of the genres, each movie once."""
    if years is not None:
        days = dim_date.where(F.col("calendar_year").between(*years))
        fact = fact.join(days, "date_key", "left_semi")
    if genres is not None:
        wanted = bridge.join(dim_genre.where(F.col("genre_name").isin(*genres)), "genre_key", "left_semi")
        fact = fact.join(wanted, "movie_key", "left_semi")
    return fact


def overview_sliced(fact, dim_date, bridge, dim_genre, years=None, genres=None) -> DataFrame:
    """Headline figures under the report's slicers."""
    return _headline(sliced(fact, dim_date, bridge, dim_genre, years, genres))


def drill_through(
    fact: DataFrame, dim_date: DataFrame, bridge: DataFrame, dim_genre: DataFrame, dim_movie: DataFrame,
    genre: str, year: int,
) -> DataFrame:
    """The movies behind one cell of the genre/year KPI."""
    cell = sliced(fact, dim_date, bridge, dim_genre, (year, year), [genre])
    return cell.join(dim_movie.select("movie_key", "movie_id", "title"), "movie_key").select(
        "movie_id", "title", "budget", "revenue", "roi", "vote_average"
    )


def _by_year(fact: DataFrame, dim_date: DataFrame, *aggs: Column) -> DataFrame:
    dated = fact.join(dim_date.select("date_key", "calendar_year"), "date_key")
    return dated.groupBy("calendar_year").agg(*aggs)


def trend_by_year(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _by_year(
        fact, dim_date, m.total_revenue(), m.total_budget(), m.movie_count(), m.avg_rating(), m.avg_roi()
    ).orderBy("calendar_year")


def revenue_yoy(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Growth against the calendar year before; unknown when that year is missing.

    The window runs over the yearly totals: at most one row per year of the DATE range.
    """
    yearly = _by_year(fact, dim_date, m.total_revenue())
    before = F.sum("total_revenue").over(Window.orderBy("calendar_year").rangeBetween(-1, -1))
    growth = (F.col("total_revenue") - F.col("previous_revenue")).cast("double") / F.nullif(
        F.col("previous_revenue"), F.lit(0)
    )
    return (
        yearly.withColumn("previous_revenue", before)
        .withColumn("revenue_yoy", F.round(growth, m.DIGITS))
        .orderBy("calendar_year")
    )


def _with_genre(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    named = bridge.join(dim_genre.select("genre_key", "genre_name"), "genre_key")
    return named.join(fact, "movie_key")


def genre_performance(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Gross and profitability by genre. A movie counts in each of its genres, so rows do not add up."""
    return (
        _with_genre(fact, bridge, dim_genre).groupBy("genre_name")
        .agg(m.total_revenue(), m.total_budget(), m.total_profit(), m.avg_roi(), m.avg_rating(), m.movie_count())
        .orderBy(F.desc("total_revenue"), "genre_name")
    )


def genre_hit_rate(fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame) -> DataFrame:
    """Which genres earn back their budget most often?"""
    both = F.col("budget").isNotNull() & F.col("revenue").isNotNull()
    return (
        _with_genre(fact, bridge, dim_genre).where(both).groupBy("genre_name")
        .agg(m.hit_rate(), m.movie_count())
    )


def budget_revenue(fact: DataFrame) -> DataFrame:
    """Linear relationship of revenue to budget over the movies with both known."""
    budget, revenue = F.col("budget").cast("double"), F.col("revenue").cast("double")
    return fact.agg(
        F.round(F.corr(budget, revenue), m.DIGITS).alias("correlation"),
        F.round(F.regr_slope(revenue, budget), m.DIGITS).alias("slope"),
        F.round(F.regr_r2(revenue, budget), m.DIGITS).alias("r2"),
        F.regr_count(revenue, budget).alias("movies_with_both"),
    )


def budget_bands(fact: DataFrame) -> DataFrame:
    """Do big budgets pay off?"""
    return fact.groupBy(m.budget_band().alias("budget_band")).agg(
        m.movie_count(), m.total_revenue(), m.avg_roi(), m.avg_rating(), m.hit_rate()
    )


def _top(fact: DataFrame, by: Column, n: int) -> DataFrame:
    """``n`` rows, kept by the sort itself (no full sort); ties go to the lower key."""
    return fact.orderBy(by, "movie_key").limit(n)


def _titled(rows: DataFrame, dim_movie: DataFrame) -> DataFrame:
    """Attach titles to ``n`` rows; while they are few, adaptive execution broadcasts them by itself."""
    return dim_movie.select("movie_key", "movie_id", "title").join(rows, "movie_key")


def top_roi(fact: DataFrame, dim_movie: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    best = _top(fact.where("roi IS NOT NULL"), F.desc("roi"), n)
    return _titled(best, dim_movie).select("movie_id", "title", "budget", "revenue", "roi").orderBy(
        F.desc("roi"), "movie_id"
    ).limit(n)


def bottom_roi(fact: DataFrame, dim_movie: DataFrame, n: int = DEFAULT_TOP) -> DataFrame:
    worst = _top(fact.where("roi IS NOT NULL"), F.asc("roi"), n)
    return _titled(worst, dim_movie).select("movie_id", "title", "budget", "revenue", "roi").orderBy(
        "roi", "movie_id"
    ).limit(n)


def top_rated(
    fact: DataFrame, dim_movie: DataFrame, n: int = DEFAULT_TOP, min_votes: int = DEFAULT_MIN_VOTES
) -> DataFrame:
    """Best ratings among the movies with enough votes."""
    rated = fact.where((F.col("vote_count") >= min_votes) & F.col("vote_average").isNotNull())
    return _titled(_top(rated, F.desc("vote_average"), n), dim_movie).select(
        "movie_id", "title", "vote_average", "vote_count"
    ).orderBy(F.desc("vote_average"), "movie_id").limit(n)


def top_studios(studios: DataFrame, by: str = "total_revenue", n: int = DEFAULT_TOP) -> DataFrame:
    """Strongest studios by revenue or by number of movies, from the studio KPI."""
    return studios.orderBy(F.desc_nulls_last(by), "company_name").limit(n)


def top_movies_per_genre(
    fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame, dim_movie: DataFrame, n: int = 3
) -> DataFrame:
    """Best-earning movies of every genre; only ``n`` rows per genre and task reach the shuffle."""
    earning = fact.where("revenue IS NOT NULL").select("movie_key", "revenue")
    best = keep_first(
        bridge.join(earning, "movie_key"), "genre_key", [F.desc("revenue"), F.asc("movie_key")], n, "place"
    )
    return (
        best.join(dim_genre.select("genre_key", "genre_name"), "genre_key")
        .join(dim_movie.select("movie_key", "movie_id", "title"), "movie_key")
        .select("genre_name", "place", "movie_id", "title", "revenue")
    )


def movie_explorer(
    fact: DataFrame, dim_movie: DataFrame, bridge: DataFrame, dim_genre: DataFrame,
    sort_by: str = "revenue", ascending: bool = False,
) -> DataFrame:
    """Detail table of all movies with their genre names, sorted. A movie has each genre once at most,
    so the list is never longer than the genre dimension."""
    names = (
        bridge.join(dim_genre.select("genre_key", "genre_name"), "genre_key").groupBy("movie_key")
        .agg(F.array_join(F.sort_array(F.collect_set("genre_name")), ", ").alias("genres"))
    )
    order = F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by)
    return (
        fact.join(dim_movie.select("movie_key", "movie_id", "title", "release_year"), "movie_key")
        .join(names, "movie_key", "left")
        .select("movie_id", "title", "release_year", "genres", "budget", "revenue", "roi", "vote_average")
        .orderBy(order, "movie_id")
    )


def performer_profile(
    fact: DataFrame, bridge: DataFrame, dim_genre: DataFrame, dim_language: DataFrame, n: int = 100
) -> DataFrame:
    """What the ``n`` best and the ``n`` worst movies by ROI have in common: how often each genre,
    language and budget band occurs among them, as a share of the group."""
    known = fact.where("roi IS NOT NULL")
    columns = ["performers", "movie_key", "language_key", "budget"]
    chosen = union_all([
        _top(known, order, n).withColumn("performers", F.lit(name)).select(*columns)
        for name, order in (("top", F.desc("roi")), ("bottom", F.asc("roi")))
    ])
    genre = (
        bridge.join(chosen, "movie_key").join(dim_genre, "genre_key")
        .select("performers", F.lit("genre").alias("trait"), F.col("genre_name").alias("value"))
    )
    others = chosen.join(dim_language, "language_key", "left").select(
        "performers",
        F.inline(F.array(
            F.struct(F.lit("language").alias("trait"), F.col("language_code").alias("value")),
            F.struct(F.lit("budget band").alias("trait"), m.budget_band().alias("value")),
        )),
    )
    sizes = chosen.groupBy("performers").agg(F.count("*").alias("group_size"))
    counts = genre.unionByName(others).where("value IS NOT NULL").groupBy("performers", "trait", "value")
    return counts.agg(F.count("*").alias("movies")).join(sizes, "performers").select(
        "performers", "trait", "value", "movies",
        F.round(F.col("movies") / F.col("group_size"), m.DIGITS).alias("share"),
    )
