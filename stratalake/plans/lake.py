"""The layered tables of one catalogue, each built from the layer above and written once."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import cached_property
from typing import ClassVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE, GOLD, SILVER, conform
from ..session import spread
from ..sources import catalogue, published, tables
from ..sources.workspace import fresh_path, packed, store
from . import gold, silver


class Lake:
    """Bronze, silver and gold namespaces below the shared folder.

    ``table("gold.fact_movie")`` builds what is missing on the way and returns the written table.
    Written tables cut the lineage, survive lost executors, and have known sizes, so Catalyst
    broadcasts a dimension only while its files are below the threshold.

    Rows are counted while they are written (``row_counts``). A lake with a name keeps every build of a table in a folder
    of its own and records the folder once it is complete (``sources.published``): a build that died is never opened,
    and ``rewrite`` leaves the old rows readable until the new ones are there.
    """

    _open: ClassVar[dict[tuple[str, str], Lake]] = {}

    def __init__(
        self, spark: SparkSession, bronze: Callable[[], DataFrame], root: str | None = None, name: str | None = None
    ):
        """A new lake, or with ``root`` and ``name`` the one that may already be there.

        Namespaces are ``bronze_<name>``, ``silver_<name>`` and ``gold_<name>``. Tables found below the root are used
        as they are, in a session with a lasting catalogue as in one without.
        """
        if (root is None) != (name is None):
            raise ValueError("a lake to be opened again needs a root and a name")
        self.spark = spark
        spread(spark)
        self._id = name or uuid.uuid4().hex[:12]
        self._lasting, self._root = root is not None, root or fresh_path(spark, "lake")
        self._source: Lake | None = None
        self._written: set[str] = set()
        self._counts: dict[str, int] = {}
        self._as_of: datetime | None = None
        self._namespaces: set[str] = set()
        self._builders: dict[str, tuple[Callable[[], DataFrame], object, tuple[str, ...]]] = {
            "bronze.raw_movies": (bronze, BRONZE, ("source_endpoint",)),
            "silver.staged": (lambda: silver.staged(self.bronze), None, ()),
            "silver.movies": (lambda: silver.movies(self.staged), SILVER["movies"], ()),
            "silver.genres": (lambda: silver.genres(self.bronze), SILVER["genres"], ()),
            "silver.movie_genres": (lambda: silver.movie_genres(self.staged), SILVER["movie_genres"], ()),
            "silver.movie_companies": (
                lambda: silver.movie_companies(self.staged), SILVER["movie_companies"], ()),
            "silver.movie_languages": (
                lambda: silver.movie_languages(self.staged), SILVER["movie_languages"], ()),
            "silver.movie_cast": (lambda: silver.movie_cast(self.bronze), SILVER["movie_cast"], ()),
            "gold.dim_date": (lambda: gold.dim_date(self.silver("movies")), GOLD["dim_date"], ()),
            "gold.dim_language": (
                lambda: gold.dim_language(self.silver("movies"), store), GOLD["dim_language"], ()),
            "gold.dim_genre": (lambda: gold.dim_genre(self.silver("genres"), store), GOLD["dim_genre"], ()),
            "gold.dim_movie": (lambda: gold.dim_movie(self.keyed_movies), GOLD["dim_movie"], ()),
            "gold.fact_movie": (
                lambda: gold.fact_movie(self.keyed_movies, self.gold("dim_language")),
                GOLD["fact_movie"], ()),
            "gold.bridge_movie_genre": (
                lambda: gold.bridge_movie_genre(
                    self.silver("movie_genres"), self.gold("dim_movie"), self.gold("dim_genre")),
                GOLD["bridge_movie_genre"], ()),
        }

    @classmethod
    def from_tables(cls, spark: SparkSession, folder: str) -> Lake:
        """The lake over the documents derived from the tables in a folder; one per session and folder."""
        owner = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if owner not in cls._open:
            cls._open[owner] = cls(spark, lambda: catalogue.bronze(spark, folder))
        return cls._open[owner]

    def rebuilt(self) -> Lake:
        """Empty silver and gold over the same bronze table."""
        anew = Lake(self.spark, lambda: self.bronze)
        anew._source = self
        return anew

    def drop(self, *layers: str) -> None:
        """Remove the tables of the given layers, or of all; what is asked for again is built anew."""
        for layer in layers or ("gold", "silver", "bronze"):
            if self._lasting or layer in self._namespaces:
                # The namespace goes with its folder: all builds of an earlier session and their records.
                self.spark.sql(f"DROP DATABASE {self.namespace(layer)} CASCADE")
                self._namespaces.discard(layer)
        self._written = {n for n in self._written if n.partition(".")[0] in self._namespaces}
        self.__dict__.pop("keyed_movies", None)

    def _opened(self, name: str, qualified: str) -> bool:
        """Whether a complete build of the table is there; if so, the catalogue has it under its name."""
        layer, _, short = name.partition(".")
        root = f"{self._root}/{layer}"
        found = published.current(published.records(self.spark, root), short)
        if found:
            self._enter(name, qualified, f"{root}/{found[0].folder}")
            self._counts[name] = found[0].row_count
        return bool(found)

    def _enter(self, name: str, qualified: str, path: str) -> None:
        """Let the catalogue's table have its rows in a folder."""
        if self.spark.catalog.tableExists(qualified):
            self.spark.sql(f"ALTER TABLE {qualified} SET LOCATION '{path}'")
        else:
            columns = self._builders[name][1]
            partitions = f"PARTITIONED BY ({', '.join(self._builders[name][2])})" if self._builders[name][2] else ""
            declared = f"({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in columns)})" if columns else ""
            self.spark.sql(f"CREATE TABLE {qualified} {declared} USING parquet {partitions} LOCATION '{path}'")
        if self._builders[name][2]:
            self.spark.catalog.recoverPartitions(qualified)
        self.spark.catalog.refreshTable(qualified)

    def rewrite(self, name: str) -> DataFrame:
        """Build a table of a lake with a name anew. Its old rows are read until the new ones are complete.

        The new rows go to a folder beside the old; then a record names it and the table's location is switched.
        """
        if not self._lasting:
            raise ValueError("only a lake with a name keeps its builds")
        layer, _, short = name.partition(".")
        qualified, root = f"{self.namespace(layer)}.{short}", f"{self._root}/{layer}"
        build, schema, partition_by = self._builders[name]
        df = build()
        found = published.records(self.spark, root)
        folder = published.new_folder(short)
        rows = published.write_counted(conform(df, schema or df.schema), f"{root}/{folder}", partition_by)
        published.publish(self.spark, root, [published.Record(short, published.next_version(found), 0, folder, rows)])
        self._enter(name, qualified, f"{root}/{folder}")
        self._counts[name] = rows
        return self.spark.table(qualified)

    def row_counts(self) -> DataFrame:
        """``table_name`` and ``row_count`` of bronze, silver and gold, as counted while they were written."""
        names = ["bronze.raw_movies", *[f"silver.{t}" for t in SILVER], *[f"gold.{t}" for t in GOLD]]
        for name in names:
            self.table(name)
        source = self._source or self
        counts = [(n.partition(".")[2], (source if n.startswith("bronze.") else self)._counts[n]) for n in names]
        return self.spark.createDataFrame(counts, "table_name string, row_count bigint")

    def namespace(self, layer: str) -> str:
        name = f"{layer}_{self._id}"
        if layer not in self._namespaces:
            tables.create_namespace(self.spark, name, f"{self._root}/{layer}")
            self._namespaces.add(layer)
        return name

    def table(self, name: str) -> DataFrame:
        layer, _, short = name.partition(".")
        if layer == "bronze" and self._source is not None:
            return self._source.table(name)
        qualified = f"{self.namespace(layer)}.{short}"
        if name not in self._written and not (self._lasting and self._opened(name, qualified)):
            if self._lasting:
                self.rewrite(name)
            else:
                build, schema, partition_by = self._builders[name]
                df, counted = build(), Observation()
                latest = [F.max("ingested_at").alias("as_of")] if layer == "bronze" else []
                df = conform(df, schema or df.schema).observe(counted, F.count(F.lit(1)).alias("row_count"), *latest)
                tables.replace_table(df, qualified, df.schema, partition_by)
                self._counts[name] = counted.get["row_count"]
                self._as_of = counted.get.get("as_of", self._as_of)
        self._written.add(name)
        return self.spark.table(qualified)

    @property
    def bronze(self) -> DataFrame:
        return self.table("bronze.raw_movies")

    def as_of(self) -> Column:
        """When anything was last ingested: as seen while bronze was written, or else from bronze itself."""
        bronze, lake = self.bronze, self._source or self
        if lake._as_of is None:
            return bronze.agg(F.max("ingested_at")).scalar()
        return F.lit(lake._as_of).cast("timestamp_ntz")

    @property
    def staged(self) -> DataFrame:
        return self.table("silver.staged")

    @cached_property
    def keyed_movies(self) -> DataFrame:
        """Keys over rows that ``dense_key`` has stored; writing them as a table again would gain nothing."""
        return gold.keyed_movies(self.silver("movies"), packed)

    def silver(self, name: str) -> DataFrame:
        return self.table(f"silver.{name}")

    def gold(self, name: str) -> DataFrame:
        return self.table(f"gold.{name}")

    def silver_tables(self) -> dict[str, DataFrame]:
        return {name: self.silver(name) for name in SILVER}

    def gold_tables(self) -> dict[str, DataFrame]:
        return {name: self.gold(name) for name in GOLD}

    def kpi_view(self, name: str) -> DataFrame:
        """(Re)create a persisted KPI view over the written tables; it is evaluated when read."""
        for needed in ("dim_date", "dim_genre", "dim_movie", "fact_movie", "bridge_movie_genre"):
            self.gold(needed)
        self.silver("movie_companies")
        names = {"gold": self.namespace("gold"), "silver": self.namespace("silver")}
        view = f"{names['gold']}.{name}"
        if name not in self._written:
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {gold.KPI_VIEWS[name].format(**names)}")
            self._written.add(name)
        return self.spark.table(view)
