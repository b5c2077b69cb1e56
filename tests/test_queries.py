"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import re
import shutil
from datetime import datetime

import pytest
from conftest import rows_of

import __spark_entry__ as registry
from stratalake.plans import silver
from stratalake.plans.lake import Lake
from stratalake.schemas import BRONZE
from stratalake.sources import workspace
from tools import check

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return check.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(OWN) <= set(registry.oracle_sql())


# The operators of the optional part have tests of their own.
OWN = [q.__name__ for q in registry._QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, oracle, name):
    rows, problem = check.compare(spark, oracle, FOLDER, name)
    assert problem == ""
    assert rows > 0


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark):
    return Lake.from_tables(spark, FOLDER)


# These write or stream on the way; the plan they return only reads the result.
EAGER = {"bronze_incremental", "land_json_documents", "bronze_roundtrip", "bronze_dedup_append", "silver_roundtrip"}


@pytest.mark.parametrize("name", sorted(set(OWN) - EAGER))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = _plan(registry.queries()[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "PythonUDF", "MapInPandas"):
        assert unwanted not in plan


def test_deduplication_prunes_before_its_only_shuffle(lake):
    plan = _plan(silver.movies(lake.staged))
    assert plan.count("Exchange ") == 1
    partial = plan.index("row_number(), 1, Partial")
    assert plan.index("row_number(), 1, Final") < plan.index("Exchange ") < partial
    assert "genre_ids" not in plan


def test_payload_is_parsed_once(lake):
    for df in (silver.staged(lake.bronze), silver.movie_cast(lake.bronze), silver.genres(lake.bronze)):
        assert _plan(df).count("from_json") == 1


def test_endpoint_filter_reaches_the_partitions(lake):
    plan = _plan(silver.movie_cast(lake.bronze))
    assert re.search(r"PartitionFilters: \[[^\]]*source_endpoint#\d+ = credits", plan)


def test_bridges_read_their_own_column_only(lake):
    """The endpoint is a constant column of nearly every staging file, so the pushed filter skips the
    row groups of the list endpoints by their statistics."""
    plan = _plan(silver.movie_genres(lake.staged))
    assert re.search(r"ReadSchema: struct<movie_id:bigint,genre_ids:array<bigint>,source_endpoint:string>", plan)
    assert "EqualTo(source_endpoint,details)" in plan


def test_facts_need_no_shuffle(lake):
    plan = _plan(registry.gold.fact_movie(lake.keyed_movies, lake.gold("dim_language")))
    rows = plan.split("BroadcastExchange")[0]
    assert "Exchange hashpartitioning" not in rows


def test_rebuild_from_bronze_only(lake):
    anew = lake.rebuilt()
    for name in ("movies", "movie_cast"):
        assert rows_of(anew.silver(name)) == rows_of(lake.silver(name))
    assert rows_of(anew.gold("fact_movie")) == rows_of(lake.gold("fact_movie"))


def test_rebuilding_does_not_copy_bronze(lake):
    anew = lake.rebuilt()
    assert anew.bronze.inputFiles() == lake.bronze.inputFiles()


def test_a_lake_is_opened_again(spark, tmp_path):
    rows = [(i, datetime(2024, 1, i), '{"id": %d, "title": "t"}' % i, e) for i in (1, 2) for e in ("details", "popular")]
    made = []

    def bronze():
        made.append(1)
        return spark.createDataFrame(rows, BRONZE)

    first = Lake(spark, bronze, str(tmp_path), "again")
    want = rows_of(first.gold("fact_movie"))
    files = lambda: {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    before = files()
    again = Lake(spark, bronze, str(tmp_path), "again")
    assert rows_of(again.gold("fact_movie")) == want and rows_of(again.bronze, "movie_id") == [(1,), (1,), (2,), (2,)]
    assert files() == before and len(made) == 1
    again.drop("gold")
    assert not list((tmp_path / "gold").rglob("*.parquet")) and list((tmp_path / "silver").rglob("*.parquet"))
    assert rows_of(again.gold("fact_movie")) == want and len(made) == 1


def test_tables_of_an_earlier_session_are_entered(spark, tmp_path):
    rows = [(1, datetime(2024, 1, 1), '{"id": 1, "title": "t"}', "details")]
    first = Lake(spark, lambda: spark.createDataFrame(rows, BRONZE), str(tmp_path / "a"), "early")
    movies = rows_of(first.silver("movies"))
    shutil.copytree(tmp_path / "a", tmp_path / "b")

    def missing():
        raise AssertionError("bronze is there")

    later = Lake(spark, missing, str(tmp_path / "b"), "later")
    assert rows_of(later.silver("movies")) == movies and rows_of(later.bronze, "movie_id") == [(1,)]


def test_sql_cast_reads_bronze_once(lake):
    assert _plan(registry.silver_sql.movie_cast(lake.bronze)).count("FileScan") == 1


def test_shared_folder():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({f"spark.{k.replace('_', '.')}": v for k, v in values.items()})

    assert workspace.shared_folder(Session(checkpoint_dir="s3://shared/x/")) == "s3://shared/x"
    # Unnamed, it lies in the warehouse, whatever the master.
    assert workspace.shared_folder(Session(sql_warehouse_dir="s3://w")) == "s3://w/stages"
