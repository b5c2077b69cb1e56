"""Registered queries, each over its whole tables.

The given tables stand in for a movie catalogue (FIXTURES.md). A query takes the written tables of the
layer above as its input and returns the plan of its own operator.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from datetime import datetime
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracle_statements
from stratalake.functions import clean
from stratalake.functions import measures as m
from stratalake.operators import enforce, reconcile
from stratalake.operators.dedup import preference
from stratalake.operators.quantile import exact_quantiles
from stratalake.plans import gold, mart, quality, reports, silver, silver_sql
from stratalake.plans.growing import GrowingLake
from stratalake.plans.lake import Lake
from stratalake.schemas import BRONZE, SILVER, TEXT_LIMITS
from stratalake.sources import catalogue, documents, tables
from stratalake.sources.workspace import fresh_path, store
from stratalake.streaming.landing import land_new_files

try:  # the operators for training data are an optional part
    import corpus_pipeline
    from stratalake.llm import queries as llm_queries
except ImportError as missing:
    # Not there, or a library of theirs is not: the other queries work without, and the reason is reported.
    warnings.warn(f"without the operators for training data: {missing}", stacklevel=1)
    llm_queries = None

BATCH = datetime(2024, 6, 1)
LANDED = documents.SAVED_PATTERN
DRILL_GENRE, DRILL_YEAR = "MEDIUM", 1998
SLICE_YEARS, SLICE_GENRES = (1996, 1999), ["ECONOMY", "PROMO"]

FIRST_BATCH = "1996-01-01"
CUT_EVERY, CUT_AT, CUT_BY = 7, 3, 20
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

_landed: dict[tuple[str, str], str] = {}
_grown: dict[tuple[str, str], GrowingLake] = {}
_marts: dict[tuple[str, str], DataFrame] = {}


def _lake(spark: SparkSession, folder: str) -> Lake:
    return Lake.from_tables(spark, folder)


def _landing_folder(spark: SparkSession, folder: str) -> str:
    """Raw responses as files per endpoint, written once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _landed:
        path = fresh_path(spark, "responses")
        documents.save_responses(catalogue.responses(spark, folder), path)
        _landed[key] = path
    return _landed[key]


_TITLES = "title STRING, budget STRING, crew ARRAY<STRUCT<job: STRING>>, genres ARRAY<STRUCT<id: STRING>>"


def _titles(bronze: DataFrame) -> DataFrame:
    fields = bronze.select(
        "movie_id", "source_endpoint", "ingested_at", F.inline(F.array(F.from_json("payload", _TITLES)))
    )
    return fields.select(
        "movie_id", "source_endpoint", "ingested_at", "title", F.col("budget").try_cast("bigint").alias("budget"),
        F.get("crew", F.lit(0))["job"].alias("first_job"),
        F.get("genres", F.lit(0))["id"].try_cast("bigint").alias("first_genre"),
    )


def _growing(spark: SparkSession, folder: str) -> GrowingLake:
    """A lake that was given everything in three batches, once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _grown:
        bronze, lake = _lake(spark, folder).bronze, GrowingLake(spark, fresh_path(spark, "growing"), buckets=16)
        early = F.col("ingested_at") < F.lit(FIRST_BATCH).cast("timestamp_ntz")
        popular = F.col("source_endpoint") == "popular"
        for batch in (early, ~early & ~popular, ~early & popular):
            lake.refresh(bronze.where(batch))
        _grown[key] = lake
    return _grown[key]


def _star(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    lake = _lake(spark, folder)
    return [lake.gold(name) for name in names]


# --- landing and bronze


def bronze_land(spark, folder):
    return _titles(documents.land(spark, _landing_folder(spark, folder), BATCH, "lines", LANDED))


def bronze_incremental(spark, folder):
    """Two sets of files landed one after the other, with a batch appended in between."""
    responses = catalogue.responses(spark, folder)
    source, target, checkpoint = (fresh_path(spark, name) for name in ("responses", "bronze", "stream"))
    lookup = F.col("source_endpoint") == "genres"
    documents.save_responses(responses.where(lookup), source)
    land_new_files(spark, source, target, checkpoint, BATCH, "lines", LANDED)
    tables.append_bronze(tables.by_endpoint(_lake(spark, folder).bronze, "popular"), target, BRONZE)
    documents.save_responses(responses.where(~lookup), source)
    for _ in range(2):  # the second run finds nothing new
        landed = land_new_files(spark, source, target, checkpoint, BATCH, "lines", LANDED)
    return _titles(landed)


def land_json_documents(spark, folder):
    """Whole files, one document each."""
    path = fresh_path(spark, "documents")
    catalogue.genre_lists(spark, folder).write.option("maxRecordsPerFile", 1).json(f"{path}/genres")
    genre = F.from_json("payload", "genres ARRAY<STRUCT<id: BIGINT, name: STRING>>")["genres"]
    return documents.land(spark, path, BATCH).select(
        "source_endpoint", F.get_json_object("payload", "$.brand").alias("brand"),
        F.array_join(F.transform(genre, lambda g: F.concat_ws(":", g["id"], g["name"])), ",").alias("genres"),
    )


def bronze_by_endpoint(spark, folder):
    rows = tables.by_endpoint(_lake(spark, folder).bronze, "credits", "popular")
    return rows.select("movie_id", "source_endpoint", "ingested_at")


def discover_ids(spark, folder):
    return documents.listed_ids(
        documents.read_documents(spark, _landing_folder(spark, folder), "lines", LANDED)
    )


def missing_details(spark, folder):
    return documents.missing_documents(_lake(spark, folder).bronze)


def bronze_roundtrip(spark, folder):
    bronze, path = _lake(spark, folder).bronze, fresh_path(spark, "bronze")
    tables.append_bronze(bronze, path, BRONZE)
    # Landing one endpoint again replaces its folder and no other.
    tables.overwrite_bronze(tables.by_endpoint(bronze, "popular"), path, BRONZE)
    return tables.read_bronze(spark, path, BRONZE).select("movie_id", "source_endpoint", "ingested_at")


def bronze_dedup_append(spark, folder):
    bronze, path = _lake(spark, folder).bronze, fresh_path(spark, "bronze")
    tables.append_bronze(tables.by_endpoint(bronze, "discover", "popular"), path, BRONZE)
    # What is known was read for good, so the table can be added to at once.
    tables.append_bronze(tables.unseen_documents(bronze, tables.landed_digests(spark, path), store), path, BRONZE)
    return (
        tables.read_bronze(spark, path, BRONZE).groupBy("source_endpoint", "movie_id")
        .agg(F.count("*").alias("documents"))
    )


def land_routed(spark, folder):
    """Responses of which some list pages were cut short: what was landed, and what was rejected for which reason."""
    page = F.get_json_object("value", "$.page").cast("int")
    cut = (F.col("source_endpoint") == "discover") & (page % CUT_EVERY == CUT_AT)
    shortened = F.left("value", F.length("value") - CUT_BY)
    responses = catalogue.responses(spark, folder).withColumn("value", F.when(cut, shortened).otherwise(F.col("value")))
    source = fresh_path(spark, "responses")
    documents.save_responses(responses, source)
    landing = documents.land_routed(
        documents.read_documents(spark, source, "lines", LANDED), BATCH, fresh_path(spark, "landing")
    )
    rows = landing.rows.groupBy("source_endpoint").agg(F.count("*").alias("n"), F.count("movie_id").alias("with_id"))
    rejects = landing.rejects.groupBy("source_endpoint", "reason").agg(F.count("*").alias("n"))
    seen = spark.createDataFrame([(k, n) for k, n in landing.counts.items()], "reason string, n bigint")
    nothing = F.lit(None).cast("bigint").alias("with_id")
    return reduce(DataFrame.unionByName, [
        rows.select("source_endpoint", F.lit("landed").alias("reason"), "n", "with_id"),
        rejects.select("source_endpoint", "reason", "n", nothing),
        seen.select(F.lit("all").alias("source_endpoint"), "reason", "n", nothing),
    ])


def written_counts(spark, folder):
    return _lake(spark, folder).row_counts()


def layer_counts(spark, folder):
    lake = _lake(spark, folder)
    return quality.layer_counts({"raw_movies": lake.bronze, **lake.silver_tables(), **lake.gold_tables()})


def endpoint_counts(spark, folder):
    return quality.endpoint_counts(_lake(spark, folder).bronze)


def dup_profile(spark, folder):
    return quality.appearances(_lake(spark, folder).bronze)


def dedup_profile(spark, folder):
    lake = _lake(spark, folder)
    return quality.dedup_profile(lake.staged, lake.silver("movies"))


def quarantine(spark, folder):
    return quality.quarantine(_lake(spark, folder).bronze)


def dq_issue_log(spark, folder):
    return quality.issue_log(_lake(spark, folder).bronze)


# --- silver


def silver_parsed(spark, folder):
    fields = silver.parsed(_lake(spark, folder).bronze).where("movie_id IS NOT NULL")
    return fields.select(
        F.col("movie_id").try_cast("bigint").alias("movie_id"), "source_endpoint", "ingested_at", "title",
        "original_title", "original_language", "release_date", "budget", "revenue", "runtime", "vote_count",
        F.col("popularity").try_cast("double").alias("popularity"), "is_adult", "overview",
        F.size("genres").alias("genre_entries"),
    )


def _fields(spark, folder, *names):
    """Movie documents with just the named payload fields read."""
    return silver.parsed(_lake(spark, folder).bronze, ("id", *names)).where("movie_id IS NOT NULL")


def _cleaned(fields, **rules):
    return fields.select(
        clean.long(F.col("movie_id")).alias("movie_id"), "source_endpoint",
        *[rule.alias(name) for name, rule in rules.items()],
    )


def clean_sentinels(spark, folder):
    return _cleaned(
        _fields(spark, folder, "budget", "revenue", "runtime"),
        budget=clean.sentinel_zero(clean.long(F.col("budget"))),
        revenue=clean.sentinel_zero(clean.long(F.col("revenue"))),
        runtime=clean.sentinel_zero(clean.integer(F.col("runtime"))),
    )


def clean_types(spark, folder):
    return _cleaned(
        _fields(spark, folder, "vote_count", "popularity", "adult"),
        vote_count=clean.integer(F.col("vote_count")),
        popularity=clean.double(F.col("popularity")),
        is_adult=clean.boolean(F.col("is_adult")),
        is_adult_or_false=clean.boolean(F.col("is_adult"), default=False),
    )


def clean_dates(spark, folder):
    released = clean.date(F.col("release_date"))
    return _cleaned(
        _fields(spark, folder, "release_date"), release_date=released, release_year=F.year(released)
    )


def clean_ratings(spark, folder):
    votes = clean.integer(F.col("vote_count"))
    return _cleaned(
        _fields(spark, folder, "vote_average", "vote_count"),
        vote_average=clean.rating(clean.double(F.col("vote_average")), votes),
        vote_count=votes,
    )


def clean_text(spark, folder):
    return _cleaned(
        _fields(spark, folder, "title", "original_title", "original_language", "overview"),
        title=clean.strip(F.col("title")),
        original_title=clean.strip(F.col("original_title")),
        original_language=clean.code(F.col("original_language")),
        overview_is_empty=clean.is_blank(F.col("overview")),
    )


def completeness_score(spark, folder):
    return silver.staged(_lake(spark, folder).bronze).select("movie_id", "source_endpoint", "completeness_score")


def silver_movies(spark, folder):
    return silver.movies(silver.staged(_lake(spark, folder).bronze))


def silver_movies_sqlpolicy(spark, folder):
    return silver.movies(_lake(spark, folder).staged, "recency")


def silver_movies_sql(spark, folder):
    return silver_sql.movies(_lake(spark, folder).bronze)


def silver_genres(spark, folder):
    return silver.genres(_lake(spark, folder).bronze)


def silver_movie_genres(spark, folder):
    return silver.movie_genres(_lake(spark, folder).staged)


def silver_movie_genres_sql(spark, folder):
    return silver_sql.movie_genres(_lake(spark, folder).bronze)


def silver_movie_companies(spark, folder):
    return silver.movie_companies(_lake(spark, folder).staged)


def silver_movie_companies_sql(spark, folder):
    return silver_sql.movie_companies(_lake(spark, folder).bronze)


def silver_movie_languages(spark, folder):
    return silver.movie_languages(_lake(spark, folder).staged)


def silver_movie_cast(spark, folder):
    return silver.movie_cast(_lake(spark, folder).bronze)


def silver_movie_cast_sql(spark, folder):
    return silver_sql.movie_cast(_lake(spark, folder).bronze)


def silver_roundtrip(spark, folder):
    lake = _lake(spark, folder)
    name = f"{lake.namespace('silver')}.movies_roundtrip"
    rows = silver.movies(lake.staged)
    tables.replace_table(rows, name, SILVER["movies"])
    return tables.refill_table(rows, name)


def silver_refresh(spark, folder):
    """Silver after three batches, each merged into what was there."""
    return _growing(spark, folder).silver("movies")


def refresh_check(spark, folder):
    """Every silver table after three batches against one build over everything."""
    growing = _growing(spark, folder)
    counts = growing.row_counts()
    counted = spark.createDataFrame([(t, counts.get(t, 0)) for t in SILVER], "table_name string, row_count bigint")
    rows = reconcile.row_reconciliation(_lake(spark, folder).silver_tables(), growing.silver_tables())
    return rows.join(counted, "table_name")


def stable_keys(spark, folder):
    """Surrogate keys after three batches: those of the first come first, and none has changed."""
    return _growing(spark, folder).keys("movie")


def refreshed_kpi(spark, folder):
    """The genre and year KPI over the star schema with keys that stay."""
    star = _growing(spark, folder).gold_tables()
    rows = (
        star["bridge_movie_genre"].join(star["dim_genre"], "genre_key").join(star["fact_movie"], "movie_key")
        .join(star["dim_date"], "date_key")
    )
    return rows.groupBy("calendar_year", "genre_name").agg(
        F.count("*").alias("movie_count"), F.round(F.avg("vote_average"), m.DIGITS).alias("average_rating"),
        F.sum("revenue").alias("total_revenue"),
    )


def enforced_write(spark, folder):
    """Staged documents and genre pairs written under their tables' constraints: what each rule kept out, what got in."""
    lake = _lake(spark, folder)
    limits = {f"{n}_length": F.length(n) <= size for n, size in TEXT_LIMITS["movies"].items()}
    movies = enforce.write_enforced(
        lake.staged.drop("genre_ids", "company_names", "language_names"),
        enforce.Constraints(
            not_null=("movie_id",), key=("movie_id",), order=tuple(preference("priority")),
            checks={**limits, "runtime_positive": F.col("runtime") > 0},
        ),
        fresh_path(spark, "movies"),
    )
    pairs = enforce.write_enforced(
        lake.silver("movie_genres"),
        enforce.Constraints(
            not_null=("movie_id", "genre_id"), key=("movie_id", "genre_id"),
            references={"genre_id": (lake.silver("genres"), "genre_id"), "movie_id": (lake.silver("movies"), "movie_id")},
        ),
        fresh_path(spark, "movie_genres"),
    )
    parts = []
    for name, done in (("movies", movies), ("movie_genres", pairs)):
        rejected = done.rejects.select(F.explode("broken").alias("rule"), "occurrences").groupBy("rule")
        accepted = done.accepted.agg(F.count("*").alias("n")).select(F.lit("accepted").alias("rule"), "n")
        rows = rejected.agg(F.sum("occurrences").alias("n")).unionByName(accepted)
        parts.append(rows.select(F.lit(name).alias("table_name"), "rule", "n"))
    return reduce(DataFrame.unionByName, parts)


def _sql_path(spark, folder):
    return silver_sql.all_tables(_lake(spark, folder).bronze, store)


def reconcile_counts(spark, folder):
    lake = _lake(spark, folder)
    return reconcile.count_reconciliation(lake.silver_tables(), _sql_path(spark, folder))


def reconcile_rows(spark, folder):
    """Both paths under the same policy."""
    lake = _lake(spark, folder)
    left = {**lake.silver_tables(), "movies": silver.movies(lake.staged, "recency")}
    return reconcile.row_reconciliation(left, _sql_path(spark, folder))


def reconcile_fields(spark, folder):
    """Each path under its own policy."""
    lake = _lake(spark, folder)
    return reconcile.field_reconciliation(lake.silver("movies"), silver_sql.movies(lake.bronze), "movie_id")


def rebuild_check(spark, folder):
    """Silver and gold built anew from bronze against the tables already there."""
    lake = _lake(spark, folder)
    anew = lake.rebuilt()
    old = {**lake.silver_tables(), **lake.gold_tables()}
    new = {**anew.silver_tables(), **anew.gold_tables()}
    return reconcile.row_reconciliation(old, new).join(reconcile.row_counts(new), "table_name")


# --- gold


def dim_date(spark, folder):
    return gold.dim_date(_lake(spark, folder).silver("movies"))


def dim_language(spark, folder):
    return gold.dim_language(_lake(spark, folder).silver("movies"), store)


def dim_genre(spark, folder):
    return gold.dim_genre(_lake(spark, folder).silver("genres"), store)


def dim_movie(spark, folder):
    return gold.dim_movie(gold.keyed_movies(_lake(spark, folder).silver("movies"), store))


def fact_movie(spark, folder):
    lake = _lake(spark, folder)
    return gold.fact_movie(lake.keyed_movies, lake.gold("dim_language"))


def bridge_movie_genre(spark, folder):
    lake = _lake(spark, folder)
    return gold.bridge_movie_genre(
        lake.silver("movie_genres"), lake.gold("dim_movie"), lake.gold("dim_genre")
    )


def _rounded_kpi(df: DataFrame) -> DataFrame:
    return df.withColumn("average_rating", F.round("average_rating", m.DIGITS))


def kpi_by_genre_year(spark, folder):
    return _rounded_kpi(_lake(spark, folder).kpi_view("kpi_by_genre_year"))


def chain_kpi_by_genre_year(spark, folder):
    """From files to the report: landing, bronze, silver, gold and the KPI view."""
    files = _landing_folder(spark, folder)
    lake = Lake(spark, lambda: documents.land(spark, files, BATCH, "lines", LANDED))
    return _rounded_kpi(lake.kpi_view("kpi_by_genre_year"))


def kpi_studio_performance(spark, folder):
    return _rounded_kpi(_lake(spark, folder).kpi_view("kpi_studio_performance"))


def dq_report(spark, folder):
    lake = _lake(spark, folder)
    return quality.report(lake.bronze, lake.silver_tables(), lake.gold_tables())


def outliers(spark, folder):
    return quality.outliers(_lake(spark, folder).silver("movies"))


# --- reports


def overview_kpis(spark, folder):
    lake = _lake(spark, folder)
    return reports.overview_kpis(lake.gold("fact_movie"), lake.bronze, lake.as_of())


def overview_sliced(spark, folder):
    star = _star(spark, folder, "fact_movie", "dim_date", "bridge_movie_genre", "dim_genre")
    return reports.overview_sliced(*star, SLICE_YEARS, SLICE_GENRES)


def _cells(spark, folder):
    """The slicer mart, written once per session."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _marts:
        star = _star(spark, folder, "fact_movie", "dim_date", "bridge_movie_genre", "dim_genre", "dim_language")
        _marts[key] = store(mart.slicer_cells(*star))
    return _marts[key]


def overview_from_mart(spark, folder):
    """The sliced headline figures without the fact."""
    return mart.overview(_cells(spark, folder), SLICE_YEARS, SLICE_GENRES)


def slicer_totals(spark, folder):
    return mart.slicer_totals(_cells(spark, folder))


def distinct_people(spark, folder):
    """People of every year, genre and both, exactly, and whether united sketches come close enough."""
    lake = _lake(spark, folder)
    star = _star(spark, folder, "fact_movie", "dim_movie", "dim_date", "bridge_movie_genre", "dim_genre")
    return mart.people_check(lake.silver("movie_cast"), *star)


def runtime_quantiles(spark, folder):
    """Exact quartiles of the runtime, and whether sketches kept per year come close enough."""
    movies = _lake(spark, folder).silver("movies")
    kept = mart.quantile_check(movies, "runtime", "release_year", QUARTILES)
    exact = exact_quantiles(movies, "runtime", QUARTILES)
    names = F.inline(F.array(*[F.struct(F.lit(q).alias("quantile"), F.col(q).alias("exact")) for q in QUARTILES]))
    return exact.select(names).join(kept, "quantile")


def movie_lookup(spark, folder):
    """The pages of the movies a report shows, looked up in a clustered table."""
    fact, dim_movie = _star(spark, folder, "fact_movie", "dim_movie")
    pages = dim_movie.join(fact.drop("runtime"), "movie_key").select(
        "movie_id", "title", "release_year", "runtime", "budget", "revenue", "vote_average"
    )
    clustered = tables.write_clustered(pages, fresh_path(spark, "pages"), "movie_id", files=8, group_rows=1_000)
    shown = [r["movie_id"] for r in reports.top_roi(fact, dim_movie).select("movie_id").collect()]
    return tables.lookup(clustered, "movie_id", shown)


def drill_through(spark, folder):
    star = _star(spark, folder, "fact_movie", "dim_date", "bridge_movie_genre", "dim_genre", "dim_movie")
    return reports.drill_through(*star, DRILL_GENRE, DRILL_YEAR)


def trend_by_year(spark, folder):
    return reports.trend_by_year(*_star(spark, folder, "fact_movie", "dim_date"))


def revenue_yoy(spark, folder):
    return reports.revenue_yoy(*_star(spark, folder, "fact_movie", "dim_date"))


def genre_performance(spark, folder):
    return reports.genre_performance(*_star(spark, folder, "fact_movie", "bridge_movie_genre", "dim_genre"))


def genre_hit_rate(spark, folder):
    return reports.genre_hit_rate(*_star(spark, folder, "fact_movie", "bridge_movie_genre", "dim_genre"))


def budget_revenue_corr(spark, folder):
    return reports.budget_revenue(*_star(spark, folder, "fact_movie"))


def budget_bands(spark, folder):
    return reports.budget_bands(*_star(spark, folder, "fact_movie"))


def top_roi(spark, folder):
    return reports.top_roi(*_star(spark, folder, "fact_movie", "dim_movie"))


def bottom_roi(spark, folder):
    return reports.bottom_roi(*_star(spark, folder, "fact_movie", "dim_movie"))


def top_rated(spark, folder):
    return reports.top_rated(*_star(spark, folder, "fact_movie", "dim_movie"))


def top_studios(spark, folder):
    return _rounded_kpi(reports.top_studios(_lake(spark, folder).kpi_view("kpi_studio_performance")))


def top_movies_per_genre(spark, folder):
    star = _star(spark, folder, "fact_movie", "bridge_movie_genre", "dim_genre", "dim_movie")
    return reports.top_movies_per_genre(*star)


def movie_explorer(spark, folder):
    star = _star(spark, folder, "fact_movie", "dim_movie", "bridge_movie_genre", "dim_genre")
    return reports.movie_explorer(*star)


def performer_profile(spark, folder):
    star = _star(spark, folder, "fact_movie", "bridge_movie_genre", "dim_genre", "dim_language")
    return reports.performer_profile(*star)


_QUERIES = (
    bronze_land, bronze_incremental, land_json_documents, bronze_by_endpoint, discover_ids, missing_details, bronze_roundtrip,
    bronze_dedup_append, layer_counts, endpoint_counts, dup_profile, dedup_profile, quarantine, dq_issue_log,
    silver_parsed, clean_sentinels, clean_types, clean_dates, clean_ratings, clean_text, completeness_score,
    silver_movies, silver_movies_sqlpolicy, silver_movies_sql, silver_genres, silver_movie_genres,
    silver_movie_genres_sql, silver_movie_companies, silver_movie_companies_sql, silver_movie_languages,
    silver_movie_cast, silver_movie_cast_sql, silver_roundtrip, reconcile_counts, reconcile_rows,
    reconcile_fields, rebuild_check, dim_date, dim_language, dim_genre, dim_movie, fact_movie,
    bridge_movie_genre, kpi_by_genre_year, chain_kpi_by_genre_year, kpi_studio_performance, dq_report, outliers, overview_kpis,
    overview_sliced, drill_through, trend_by_year, revenue_yoy, genre_performance, genre_hit_rate,
    budget_revenue_corr, budget_bands, top_roi, bottom_roi, top_rated, top_studios, top_movies_per_genre,
    movie_explorer, performer_profile,
    land_routed, written_counts, silver_refresh, refresh_check, stable_keys, refreshed_kpi, enforced_write,
    overview_from_mart, slicer_totals, distinct_people, runtime_quantiles, movie_lookup,
)


def entry(spark: SparkSession) -> DataFrame:
    """Genre and year KPI, from raw documents through every layer."""
    return kpi_by_genre_year(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {query.__name__: query for query in _QUERIES}
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle_statements.statements()
    if llm_queries is not None:
        found |= llm_queries.oracle_sql()
    return found
