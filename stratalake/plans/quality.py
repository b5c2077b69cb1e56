"""Profiling, data-quality rules, outliers and the quarantine."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from ..operators.quantile import exact_quantiles
from ..operators.reconcile import row_counts, union_all
from ..schemas import MOVIE_ENDPOINTS, TEXT_LIMITS
from ..sources.tables import by_endpoint

layer_counts = row_counts


def endpoint_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_endpoint").agg(F.count("*").alias("record_count")).orderBy("source_endpoint")


def appearances(bronze: DataFrame) -> DataFrame:
    """Movies with more than one bronze record, most frequent first."""
    return (
        bronze.where("movie_id IS NOT NULL").groupBy("movie_id").agg(F.count("*").alias("appearances"))
        .where("appearances > 1").orderBy(F.desc("appearances"), "movie_id")
    )


def dedup_profile(stage: DataFrame, movies: DataFrame) -> DataFrame:
    """Rows and distinct ids before and after deduplication."""
    return union_all([
        df.agg(F.count("*").alias("row_count"), F.count_distinct("movie_id").alias("unique_movies"))
        .select(F.lit(step).alias("step"), "row_count", "unique_movies")
        for step, df in (("before", stage), ("after", movies))
    ])


def _unpivot(counted: DataFrame, label: str, total: str) -> DataFrame:
    """One output row per column of a one-row frame."""
    entries = F.array(*[F.struct(F.lit(n).alias(label), F.col(n).alias(total)) for n in counted.columns])
    return counted.select(F.inline(entries))


def _violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Count the rows breaking each rule, all in one pass."""
    counted = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return _unpivot(counted, "rule", "violations")


def _duplicates(df: DataFrame, key: list[str], rule: str) -> DataFrame:
    groups = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
    return groups.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def _orphans(df: DataFrame, parent: DataFrame, key: str, rule: str) -> DataFrame:
    """Rows of a bridge whose key the dimension lacks. Keys are counted first, so a key shared by
    very many rows meets the dimension as one row."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    lost = per_key.join(parent.select(key).distinct(), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )


#: Films are not older; a stray year would make the calendar dimension long.
FIRST_YEAR = 1870


def report(bronze: DataFrame, silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> DataFrame:
    """One row per rule with its number of violations; zero everywhere means the layers are sound.

    ``silver_genre_unknown`` may be above zero: silver keeps ids the lookup lacks, the gold bridge
    does not. So may the rules on NULL items of bridges, where a document names an element without a name.
    All conditions on rows of a table are counted in one pass over it.
    """
    movies, fact = silver["movies"], gold["fact_movie"]
    c = F.col
    unknown = c("budget").isNull() | c("revenue").isNull()
    null = lambda *names: reduce(or_, [c(name).isNull() for name in names])
    rules = {
        "movies": {
            "movies_zero_budget": c("budget") == 0,
            "movies_zero_revenue": c("revenue") == 0,
            "movies_zero_runtime": c("runtime") == 0,
            "movies_rating_without_votes": (c("vote_count") == 0) & c("vote_average").isNotNull(),
            "movies_null_id": null("movie_id"),
        },
        "genres": {"genres_null_id": null("genre_id")},
        "movie_genres": {"movie_genres_null_id": null("genre_id")},
        "movie_companies": {"movie_companies_null_name": null("company_name")},
        "movie_languages": {"movie_languages_null_name": null("language_name")},
        "movie_cast": {"movie_cast_null_name": null("person_name")},
    }
    for table, limits in TEXT_LIMITS.items():
        rules[table] |= {f"{table}_{name}_too_long": F.length(name) > size for name, size in limits.items()}
    parts = [
        _violations(bronze, {
            "bronze_null_endpoint": null("source_endpoint"),
            "bronze_null_ingested_at": null("ingested_at"),
            "bronze_null_payload": null("payload"),
        }),
        *[_violations(silver[table], checks) for table, checks in rules.items()],
        _violations(fact, {
            "fact_null_key": c("movie_key").isNull(),
            "fact_profit_not_null_safe": c("profit").isNull() != unknown,
            "fact_roi_not_null_safe": c("roi").isNull() != unknown,
        }),
        _violations(gold["dim_date"], {
            "dim_date_null_key": null("date_key", "full_date"),
            "dim_date_before_film": c("calendar_year") < FIRST_YEAR,
        }),
        _violations(gold["dim_language"], {"dim_language_null_key": null("language_key")}),
        _violations(gold["dim_genre"], {"dim_genre_null_key": null("genre_key")}),
        _violations(gold["bridge_movie_genre"], {"bridge_null_key": null("movie_key", "genre_key")}),
        _duplicates(movies, ["movie_id"], "movies_duplicate_id"),
        _duplicates(silver["genres"], ["genre_id"], "genres_duplicate_id"),
        _duplicates(fact, ["movie_key"], "fact_duplicate_key"),
        _duplicates(gold["dim_movie"], ["movie_key"], "dim_movie_duplicate_key"),
        _duplicates(gold["dim_movie"], ["movie_id"], "dim_movie_duplicate_movie"),
        _duplicates(gold["dim_date"], ["date_key"], "dim_date_duplicate_key"),
        _duplicates(gold["dim_date"], ["full_date"], "dim_date_duplicate_date"),
        _duplicates(gold["dim_language"], ["language_key"], "dim_language_duplicate_key"),
        _duplicates(gold["dim_genre"], ["genre_key"], "dim_genre_duplicate_key"),
        _duplicates(gold["dim_language"], ["language_code"], "dim_language_duplicate_code"),
        _duplicates(gold["dim_genre"], ["genre_id"], "dim_genre_duplicate_id"),
        _duplicates(gold["bridge_movie_genre"], ["movie_key", "genre_key"], "bridge_duplicate_pair"),
        _orphans(silver["movie_genres"], movies, "movie_id", "silver_genre_of_unknown_movie"),
        _orphans(silver["movie_genres"], silver["genres"], "genre_id", "silver_genre_unknown"),
        _orphans(silver["movie_companies"], movies, "movie_id", "silver_company_of_unknown_movie"),
        _orphans(gold["bridge_movie_genre"], gold["dim_movie"], "movie_key", "bridge_movie_unknown"),
        _orphans(gold["bridge_movie_genre"], gold["dim_genre"], "genre_key", "bridge_genre_unknown"),
    ]
    return union_all(parts)


def issue_log(bronze: DataFrame) -> DataFrame:
    """How often each known problem occurs in the bronze movie documents.

    Reads the payload as VARIANT, which still tells a number sent as text from a number.
    """
    docs = _readable(bronze)
    get = lambda field: F.try_variant_get("doc", f"$.{field}", "string")
    as_text = lambda field: F.schema_of_variant(F.try_variant_get("doc", f"$.{field}", "variant")) == "STRING"
    array = lambda field: F.try_variant_get("doc", f"$.{field}", "array<variant>")
    fields = docs.select(
        "doc",
        clean.long(get("id")).alias("movie_id"),
        clean.long(get("budget")).alias("budget"),
        clean.long(get("revenue")).alias("revenue"),
        clean.integer(get("runtime")).alias("runtime"),
        get("release_date").alias("release_date"),
        clean.integer(get("vote_count")).alias("vote_count"),
        clean.double(get("vote_average")).alias("vote_average"),
        get("title").alias("title"),
        get("original_language").alias("language"),
        get("overview").alias("overview"),
        (as_text("budget") | as_text("revenue") | as_text("runtime")).alias("number_as_text"),
        F.size(array("genres")).alias("genre_entries"),
    )
    c = F.col
    movie = c("movie_id").isNotNull()
    checks = {
        "zero_budget": c("budget") == 0,
        "zero_revenue": c("revenue") == 0,
        "zero_runtime": c("runtime") == 0,
        "missing_date": movie & (F.coalesce(c("release_date"), F.lit("")) == ""),
        "invalid_date": (c("release_date") != "") & clean.date(c("release_date")).isNull(),
        "nested_genres": c("genre_entries") > 0,
        "number_as_text": c("number_as_text"),
        "rating_without_votes": (c("vote_count") == 0) & c("vote_average").isNotNull(),
        "untrimmed_title": c("title") != clean.strip(c("title")),
        "unclean_language": c("language") != clean.code(c("language")),
        "empty_overview": movie & clean.is_blank(c("overview")),
        "revenue_below_budget": (c("budget") > 0) & (c("revenue") > 0) & (c("revenue") < c("budget")),
        "unreadable_payload": c("doc").isNull(),
        "missing_id": c("doc").isNotNull() & c("movie_id").isNull(),
    }
    # Counted per movie first, which also tells the repeats; both steps combine before their shuffle.
    per_movie = fields.groupBy("movie_id").agg(
        F.count("*").alias("n"), *[F.count_if(condition).alias(name) for name, condition in checks.items()]
    )
    repeats = F.when(movie, F.col("n") - 1).otherwise(F.lit(0))
    totals = per_movie.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks],
        F.coalesce(F.sum(repeats), F.lit(0)).alias("repeated_movie"),
    )
    return _unpivot(totals, "issue", "occurrences")


def _readable(bronze: DataFrame) -> DataFrame:
    """Movie documents with their payload as VARIANT, NULL where it is no JSON. Made by a generator, so
    that conditions on it do not parse it again."""
    doc = F.explode(F.array(F.try_parse_json("payload"))).alias("doc")
    return by_endpoint(bronze, *MOVIE_ENDPOINTS).select("source_endpoint", "ingested_at", "payload", doc)


def quarantine(bronze: DataFrame) -> DataFrame:
    """Movie documents that never reach silver, with the reason."""
    docs = _readable(bronze)
    movie_id = clean.long(F.try_variant_get("doc", "$.id", "string"))
    reason = F.when(F.col("doc").isNull(), "unreadable").when(movie_id.isNull(), "no movie id")
    return docs.withColumn("reason", reason).where("reason IS NOT NULL").select(
        "source_endpoint", "reason", "ingested_at", "payload"
    )


def outliers(movies: DataFrame) -> DataFrame:
    """Movies flagged for a runtime outside the quartile fences or a revenue below the budget.

    Flagged, not dropped. The exact fences are one struct in a scalar subquery, worked out once.
    """
    q = exact_quantiles(movies, "runtime", {"q1": 0.25, "q3": 0.75})
    margin = 1.5 * (F.col("q3") - F.col("q1"))
    fences = q.select(
        F.struct((F.col("q1") - margin).alias("low"), (F.col("q3") + margin).alias("high"))
    ).scalar()
    runtime = F.col("runtime")
    flagged = movies.select(
        "movie_id",
        "runtime",
        "budget",
        "revenue",
        F.coalesce(~runtime.between(fences["low"], fences["high"]), F.lit(False)).alias("odd_runtime"),
        F.coalesce(F.col("revenue") < F.col("budget"), F.lit(False)).alias("below_budget"),
    )
    return flagged.where("odd_runtime OR below_budget")

