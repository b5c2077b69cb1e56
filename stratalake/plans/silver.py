"""Silver by DataFrame plans: parse once, clean, deduplicate, unfold the nested arrays.

``staged`` reads the JSON text a single time and leaves typed columns and arrays; every other silver
table but the cast is a projection of it, so on a written staging table each of them reads only its
own columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean
from ..functions.parsing import CREDITS_PAYLOAD, LOOKUP_PAYLOAD, MOVIE_PAYLOAD, present, read_payload, text
from ..operators.dedup import keep_first, preference
from ..schemas import DIRECTOR_JOB, LAST_TOP_BILLED_ORDER, MOVIE_ENDPOINTS, SILVER, conform
from ..sources.tables import by_endpoint

MOVIE_PAYLOAD_FIELDS = tuple(MOVIE_PAYLOAD.fieldNames())


def parsed(bronze: DataFrame, fields: tuple[str, ...] = MOVIE_PAYLOAD_FIELDS) -> DataFrame:
    """Movie payloads as text columns and arrays under their table names, before any cleaning.

    Naming fewer fields lets the parser skip the others.
    """
    schema = T.StructType([f for f in MOVIE_PAYLOAD.fields if f.name in fields])
    found = read_payload(
        by_endpoint(bronze, *MOVIE_ENDPOINTS), schema,
        F.xxhash64("payload").alias("payload_hash"), "ingested_at", "source_endpoint",
    )
    return found.withColumnsRenamed({"id": "movie_id", "adult": "is_adult"})


def cleaned(fields: DataFrame, adult_default: bool | None = None) -> DataFrame:
    """Typed and cleaned columns, the completeness score, and the nested arrays; one row per document.

    Payloads that are no JSON or have no id are left out (``quality.quarantine`` has them).
    """
    c = F.col
    movie_id = clean.long(c("movie_id"))
    release_date = clean.date(c("release_date"))
    budget = clean.sentinel_zero(clean.long(c("budget")))
    revenue = clean.sentinel_zero(clean.long(c("revenue")))
    runtime = clean.sentinel_zero(clean.integer(c("runtime")))
    votes = clean.integer(c("vote_count"))
    return fields.where(movie_id.isNotNull()).select(
        movie_id.alias("movie_id"),
        clean.strip(c("title")).alias("title"),
        clean.strip(c("original_title")).alias("original_title"),
        clean.code(c("original_language")).alias("original_language"),
        release_date.alias("release_date"),
        F.year(release_date).alias("release_year"),
        budget.alias("budget"),
        revenue.alias("revenue"),
        runtime.alias("runtime"),
        clean.rating(clean.double(c("vote_average")), votes).alias("vote_average"),
        votes.alias("vote_count"),
        clean.double(c("popularity")).alias("popularity"),
        clean.boolean(c("is_adult"), adult_default).alias("is_adult"),
        clean.is_blank(c("overview")).alias("overview_is_empty"),
        clean.presence_score(
            budget, revenue, runtime, c("genres"), c("production_companies"), c("spoken_languages")
        ).alias("completeness_score"),
        _items("genres", lambda item: clean.long(text(item, "id"))).alias("genre_ids"),
        _items("production_companies", lambda item: text(item, "name")).alias("company_names"),
        _items("spoken_languages", lambda item: text(item, "name")).alias("language_names"),
        "payload_hash",
        "ingested_at",
        "source_endpoint",
    )


def _items(field: str, value) -> Column:
    """Distinct values of one field of a nested array; NULL elements are dropped."""
    return F.array_distinct(F.transform(present(F.col(field)), value))


def staged(bronze: DataFrame, adult_default: bool | None = None) -> DataFrame:
    return cleaned(parsed(bronze), adult_default)


def movies(stage: DataFrame, policy: str = "priority") -> DataFrame:
    """One row per movie: its most complete record. The nested arrays stay out of the shuffle, and so does the year, which
    the date tells."""
    narrow = stage.drop("genre_ids", "company_names", "language_names", "release_year")
    first = keep_first(narrow, "movie_id", preference(policy)).withColumn("release_year", F.year("release_date"))
    return conform(first, SILVER["movies"])


def winners(stage: DataFrame, policy: str = "priority") -> DataFrame:
    """The most complete record per movie with its nested arrays."""
    return keep_first(stage, "movie_id", preference(policy))


def _bridge(stage: DataFrame, items: str, name: str) -> DataFrame:
    """Distinct movie/item pairs. Taken from ``winners`` it stands on the chosen records only."""
    pairs = stage.where("source_endpoint = 'details'").select("movie_id", F.explode(items).alias(name))
    return pairs.distinct()


def movie_genres(stage: DataFrame) -> DataFrame:
    return conform(_bridge(stage, "genre_ids", "genre_id"), SILVER["movie_genres"])


def movie_companies(stage: DataFrame) -> DataFrame:
    return conform(_bridge(stage, "company_names", "company_name"), SILVER["movie_companies"])


def movie_languages(stage: DataFrame) -> DataFrame:
    return conform(_bridge(stage, "language_names", "language_name"), SILVER["movie_languages"])


def latest_genres(bronze: DataFrame) -> DataFrame:
    """Genre names by id with the time of their lookup; the latest lookup wins."""
    lookups = read_payload(by_endpoint(bronze, "genres"), LOOKUP_PAYLOAD, "ingested_at")
    items = lookups.select("ingested_at", F.explode(present(F.col("genres"))).alias("g"))
    named = items.select(
        clean.long(text(F.col("g"), "id")).alias("genre_id"),
        text(F.col("g"), "name").alias("genre_name"),
        "ingested_at",
    ).where("genre_id IS NOT NULL")
    return latest_names(named)


def latest_names(named: DataFrame) -> DataFrame:
    """The latest name of every genre; of names looked up at the same time the greatest."""
    latest = F.max(F.struct("ingested_at", "genre_name")).alias("latest")
    return named.groupBy("genre_id").agg(latest).select("genre_id", "latest.genre_name", "latest.ingested_at")


def genres(bronze: DataFrame) -> DataFrame:
    return conform(latest_genres(bronze), SILVER["genres"])


def movie_cast(bronze: DataFrame) -> DataFrame:
    """Top-billed cast and directors, each distinct; both arrays are unfolded in one pass."""
    credits = read_payload(by_endpoint(bronze, "credits"), CREDITS_PAYLOAD)
    order = lambda p: clean.integer(text(p, "order"))
    billed = F.transform(
        F.filter(present(F.col("cast")), lambda p: order(p) <= LAST_TOP_BILLED_ORDER),
        lambda p: _role(text(p, "name"), "Cast", text(p, "character"), order(p)),
    )
    directors = F.transform(
        F.filter(present(F.col("crew")), lambda p: text(p, "job") == DIRECTOR_JOB),
        lambda p: _role(text(p, "name"), "Director", F.lit(None).cast("string"), F.lit(None).cast("int")),
    )
    nobody = F.array().cast(
        "array<struct<person_name:string,role_type:string,character_name:string,cast_order:int>>"
    )
    people = F.concat(F.coalesce(billed, nobody), F.coalesce(directors, nobody))
    rows = credits.select(
        clean.long(F.col("id")).alias("movie_id"), F.explode(people).alias("p")
    ).where("movie_id IS NOT NULL").select("movie_id", "p.*")
    return conform(rows.distinct(), SILVER["movie_cast"])


def _role(person: Column, role: str, character: Column, order: Column) -> Column:
    return F.struct(
        person.alias("person_name"),
        F.lit(role).alias("role_type"),
        character.alias("character_name"),
        order.alias("cast_order"),
    )
