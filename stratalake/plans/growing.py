"""A lake that takes batches: silver is merged, keys stay, and a batch shows in all tables at once.

A refresh parses the rows of its batch and nothing else. Winners are compared with the stored winners of the same
buckets, bridges are united with the stored pairs, names of genres with the stored ones, and only those buckets are
written, beside the old. Movies, languages and genres that are new get keys after the last one given. At last one
record file makes bronze, silver and keys of the batch count together (``sources.published``); a refresh that dies
before leaves the lake as it was, and can be run again.

Refreshed step by step, silver equals what a rebuild over all of bronze gives: the preference among records is a total
order, so the best of the best is the best, and distinct pairs and latest names can be united in any grouping.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keep_first, preference
from ..operators.merge import extend_keys, merge_buckets
from ..schemas import BRONZE, GOLD, SILVER, conform
from ..sources import published
from ..sources.published import Record
from ..sources.workspace import packed
from . import gold, silver

#: What a winner has to keep so that later records can be compared with it.
RANKED = T.StructType([
    *SILVER["movies"].fields, T.StructField("completeness_score", T.IntegerType()),
    T.StructField("source_endpoint", T.StringType()), T.StructField("payload_hash", T.LongType()),
])
NAMED = T.StructType([*SILVER["genres"].fields, T.StructField("ingested_at", T.TimestampNTZType())])
KEYS = {"movie": ("movie_id", "movie_key"), "language": ("language_code", "language_key"), "genre": ("genre_id", "genre_key")}
BRIDGES = ("movie_genres", "movie_companies", "movie_languages", "movie_cast")


class GrowingLake:
    """Bronze, silver and keys below a root, refreshed batch by batch.

    ``buckets`` is the number of buckets by movie; a batch rewrites those its movies fall into, so choose it so that
    a bucket is some files' worth. It belongs to the root and must not change.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, policy: str = "priority"):
        self.spark, self.root, self.buckets, self.policy = spark, root, buckets, policy

    def _records(self) -> list[Record]:
        return published.records(self.spark, self.root)

    # --- writing

    def refresh(self, batch: DataFrame) -> None:
        """Take the bronze rows of a batch into every layer."""
        batch = conform(batch, BRONZE)
        found = self._records()
        version = published.next_version(found)
        folder = published.new_folder("raw_movies", partitioned=True)
        rows = published.write_counted(batch, f"{self.root}/{folder}", ("source_endpoint",))
        new = [Record("raw_movies", version, version, folder, rows)]
        if rows:
            landed = published.read(self.spark, self.root, new, BRONZE, partitioned=True)
            new += self._merged(found, version, landed)
        published.publish(self.spark, self.root, new)

    def _merged(self, found: list[Record], version: int, landed: DataFrame) -> list[Record]:
        stage = packed(silver.staged(landed))
        merge = partial(merge_buckets, self.spark, self.root, found, version)
        order = preference(self.policy)
        winners = packed(conform(keep_first(stage, "movie_id", order), RANKED))
        pairs = {
            "movie_genres": silver.movie_genres(stage), "movie_companies": silver.movie_companies(stage),
            "movie_languages": silver.movie_languages(stage), "movie_cast": silver.movie_cast(landed),
        }
        names = packed(conform(silver.latest_genres(landed), NAMED))
        best = partial(keep_first, key=[published.SLOT, "movie_id"], order=order)
        changes = merge("movies", winners, "movie_id", self.buckets, best)
        for table in BRIDGES:
            changes += merge(table, packed(pairs[table]), "movie_id", self.buckets, DataFrame.distinct)
        changes += merge("genres", names, "genre_id", 1, silver.latest_names)
        key = partial(extend_keys, self.spark, self.root, found, version)
        changes += key("movie_keys", winners.select("movie_id"), "movie_id", "movie_key", self.buckets, packed)
        languages = winners.select(F.col("original_language").alias("language_code"))
        changes += key("language_keys", languages, "language_code", "language_key", 1, packed)
        changes += key("genre_keys", names.select("genre_id"), "genre_id", "genre_key", 1, packed)
        return changes

    # --- reading

    def bronze(self) -> DataFrame:
        chosen = published.appended(self._records(), "raw_movies")
        return published.read(self.spark, self.root, chosen, BRONZE, partitioned=True)

    def stored(self, table: str, schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        """The current rows of a merged table, or of some of its buckets."""
        return published.read(self.spark, self.root, published.current(self._records(), table, buckets), schema)

    def silver(self, name: str) -> DataFrame:
        schema = {"movies": RANKED, "genres": NAMED}.get(name, SILVER[name])
        return conform(self.stored(name, schema), SILVER[name])

    def silver_tables(self) -> dict[str, DataFrame]:
        return {name: self.silver(name) for name in SILVER}

    def keys(self, of: str) -> DataFrame:
        """Names with the surrogate keys given to them so far."""
        name, key = KEYS[of]
        kind = T.StringType() if of == "language" else T.LongType()
        schema = T.StructType([T.StructField(key, T.LongType()), T.StructField(name, kind)])
        return published.read(self.spark, self.root, published.appended(self._records(), f"{of}_keys"), schema)

    def gold_tables(self) -> dict[str, DataFrame]:
        """The star schema under keys that later batches keep."""
        movies, genres = self.silver("movies"), self.silver("genres")
        keyed = movies.join(self.keys("movie"), "movie_id")
        # A language that no winner has any more keeps its key and its row.
        dim_language = conform(self.keys("language"), GOLD["dim_language"])
        dim_genre = conform(genres.join(self.keys("genre"), "genre_id"), GOLD["dim_genre"])
        dim_movie = gold.dim_movie(keyed)
        return {
            "dim_date": gold.dim_date(movies), "dim_language": dim_language, "dim_genre": dim_genre, "dim_movie": dim_movie,
            "fact_movie": gold.fact_movie(keyed, dim_language),
            "bridge_movie_genre": gold.bridge_movie_genre(self.silver("movie_genres"), dim_movie, dim_genre),
        }

    def row_counts(self) -> dict[str, int]:
        """Rows of every table as they were counted while being written; no table is read."""
        found = self._records()
        replaced = {name: published.current(found, name) for name in SILVER}
        added = {name: published.appended(found, name) for name in ("raw_movies", *[f"{of}_keys" for of in KEYS])}
        return {name: sum(r.row_count for r in chosen) for name, chosen in {**replaced, **added}.items()}
