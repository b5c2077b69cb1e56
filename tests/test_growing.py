"""Batches merged into a lake, keys that stay, and records of what is complete."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.operators import merge
from stratalake.plans import growing
from stratalake.plans.growing import GrowingLake
from stratalake.plans.lake import Lake
from stratalake.schemas import BRONZE, SILVER
from stratalake.sources import published

DAY = [datetime(2024, 1, d) for d in range(1, 10)]


def details(i, at, **fields):
    doc = {"id": i, "title": f"t{i}", "original_language": "en", "genres": [{"id": 1}], "release_date": "2020-01-05", **fields}
    return (i, at, json.dumps(doc), "details")


def lookup(at, *genres):
    return (None, at, json.dumps({"genres": [{"id": i, "name": n} for i, n in genres]}), "genres")


@pytest.fixture
def lake(spark, tmp_path):
    return GrowingLake(spark, str(tmp_path / "lake"), buckets=8)


def bronze_of(spark, rows):
    return spark.createDataFrame(rows, BRONZE)


BATCHES = [
    [details(1, DAY[0], budget=5), details(2, DAY[0]), lookup(DAY[0], (1, "old"), (2, "b")),
     (1, DAY[0], '{"id": 1, "cast": [{"name": "p", "order": 1}], "crew": []}', "credits")],
    [],
    # A worse record of 1 that came later, a better one of 2, a new movie, no JSON, and a record without id.
    [details(1, DAY[3]), details(2, DAY[1], budget=7, revenue=9, original_language="fr"), details(3, DAY[1], genres=[{"id": 2}, {"id": 9}]),
     (None, DAY[1], "<html>", "details"), (None, DAY[1], "{}", "popular"), lookup(DAY[4], (1, "new"))],
    # An older lookup that came late, everything of the first batch once more, and other pairs of a known movie.
    [lookup(DAY[2], (1, "between"), (5, "e")), details(1, DAY[0], budget=5), details(1, DAY[5], genres=[{"id": 2}]),
     (1, DAY[6], '{"id": 1, "cast": [{"name": "q", "order": 2}], "crew": [{"name": "d", "job": "Director"}]}', "credits")],
]


@pytest.mark.parametrize("policy", ["priority", "recency"])
def test_batches_equal_a_rebuild(spark, tmp_path, policy):
    lake = GrowingLake(spark, str(tmp_path / "lake"), buckets=8, policy=policy)
    for batch in BATCHES:
        lake.refresh(bronze_of(spark, batch))
    whole = Lake(spark, lambda: bronze_of(spark, sum(BATCHES, [])))
    for name, table in lake.silver_tables().items():
        want = growing.silver.movies(whole.staged, policy) if name == "movies" else whole.silver(name)
        assert rows_of(table) == rows_of(want), name
    assert rows_of(lake.bronze(), *BRONZE.fieldNames()) == rows_of(whole.bronze, *BRONZE.fieldNames())
    counted = lake.row_counts()
    assert counted["raw_movies"] == len(sum(BATCHES, [])) and all(
        counted[n] == t.count() for n, t in lake.silver_tables().items())


def test_keys_stay(spark, lake):
    seen = {of: [] for of in growing.KEYS}
    for batch in BATCHES:
        lake.refresh(bronze_of(spark, batch))
        for of in seen:
            seen[of].append({n: k for k, n in rows_of(lake.keys(of))})
    for of, steps in seen.items():
        for before, after in zip(steps, steps[1:], strict=False):
            assert all(after[name] == key for name, key in before.items()), of
        assert sorted(steps[-1].values()) == list(range(1, len(steps[-1]) + 1))
    assert seen["movie"][-1] == {1: 1, 2: 2, 3: 3} and seen["genre"][-1] == {1: 1, 2: 2, 5: 3}
    # A language keeps its key though no winner has it any more would be fine too; here one came in later.
    assert seen["language"][-1] == {"EN": 1, "FR": 2}
    star = lake.gold_tables()
    assert rows_of(star["dim_movie"], "movie_key", "movie_id") == [(1, 1), (2, 2), (3, 3)]
    assert rows_of(star["dim_genre"]) == [(1, 1, "new"), (2, 2, "b"), (3, 5, "e")]
    assert rows_of(star["bridge_movie_genre"]) == [(1, 1), (1, 2), (2, 1), (3, 2)]
    assert rows_of(star["fact_movie"], "movie_key", "language_key", "revenue") == [(1, 1, None), (2, 2, 9), (3, 1, None)]


def test_untouched_buckets_are_neither_read_nor_written(spark, lake):
    lake.refresh(bronze_of(spark, [details(i, DAY[0]) for i in range(200)]))
    before = {r.part: r for r in published.current(lake._records(), "movies")}
    assert len(before) == 8
    batch = bronze_of(spark, [details(7, DAY[1], budget=3)])
    bucket = spark.range(1).select(published.bucket_of(F.lit(7).cast("bigint"), 8)).first()[0]
    touched = merge.touched_buckets(batch, "movie_id", 8)
    assert touched == [bucket]
    read = lake.stored("movies", growing.RANKED, touched)
    assert read.inputFiles() and all(f"/bucket={bucket}/" in f for f in read.inputFiles())
    lake.refresh(batch)
    after = {r.part: r for r in published.current(lake._records(), "movies")}
    assert {p for p in after if after[p] != before[p]} == {bucket}
    assert after[bucket].row_count == before[bucket].row_count
    assert rows_of(lake.silver("movies").where("budget = 3"), "movie_id") == [(7,)]
    # Keys: nothing new, so nothing is written.
    assert lake.row_counts()["movie_keys"] == 200
    assert len({r.version for r in lake._records() if r.table_name == "movie_keys"}) == 1


def test_a_refresh_that_dies_leaves_the_lake_as_it_was(spark, lake, monkeypatch):
    lake.refresh(bronze_of(spark, BATCHES[0]))
    before = {n: rows_of(t) for n, t in lake.silver_tables().items()}
    keys = rows_of(lake.keys("movie"))

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(growing, "extend_keys", dies)
        with pytest.raises(RuntimeError, match="lost"):
            lake.refresh(bronze_of(spark, BATCHES[2]))
    assert {n: rows_of(t) for n, t in lake.silver_tables().items()} == before and rows_of(lake.keys("movie")) == keys
    assert lake.bronze().count() == len(BATCHES[0])
    # Run again, it shows as a whole, and another session that opens the root sees the same.
    lake.refresh(bronze_of(spark, BATCHES[2]))
    again = GrowingLake(spark, lake.root, lake.buckets)
    assert again.silver("movies").count() == 3 and again.bronze().count() == len(BATCHES[0]) + len(BATCHES[2])


def test_an_empty_lake(spark, lake):
    assert lake.bronze().count() == 0 and all(t.count() == 0 for t in lake.silver_tables().values())
    assert set(lake.row_counts().values()) == {0} and lake.keys("movie").count() == 0
    lake.refresh(bronze_of(spark, []))
    assert lake.silver("movies").schema == SILVER["movies"] or lake.silver("movies").count() == 0
    assert set(lake.row_counts().values()) == {0}


# --- complete builds


def dying(spark, rows):
    """Rows of which the last can't be computed: some tasks have written their files when the job fails."""
    good = spark.createDataFrame(rows, SILVER["genres"]).repartition(2)
    bad = spark.range(1).select(F.raise_error(F.lit("lost")).cast("bigint").alias("genre_id"), F.lit("x").alias("genre_name"))
    return good.unionByName(bad)


def test_old_rows_are_readable_until_the_new_are_complete(spark, tmp_path):
    rows = [lookup(DAY[0], (1, "a"))]
    lake = Lake(spark, lambda: bronze_of(spark, rows), str(tmp_path), "switched")
    assert rows_of(lake.silver("genres")) == [(1, "a")]
    table = f"{lake.namespace('silver')}.genres"
    build, schema, parts = lake._builders["silver.genres"]
    lake._builders["silver.genres"] = (lambda: dying(spark, [(5, "new")] * 10), schema, parts)
    with pytest.raises(Exception, match="lost"):
        lake.rewrite("silver.genres")
    assert rows_of(spark.table(table)) == [(1, "a")]
    # Nor does a later session take the broken build for the table.
    later = Lake(spark, lambda: bronze_of(spark, rows), str(tmp_path), "later")
    assert rows_of(later.silver("genres")) == [(1, "a")]
    lake._builders["silver.genres"] = (lambda: spark.createDataFrame([(2, "b"), (3, "c")], schema), schema, parts)
    assert rows_of(lake.rewrite("silver.genres")) == rows_of(spark.table(table)) == [(2, "b"), (3, "c")]
    assert rows_of(Lake(spark, lambda: None, str(tmp_path), "last").silver("genres")) == [(2, "b"), (3, "c")]


def test_a_half_written_build_is_not_opened(spark, tmp_path):
    """Files without a record, as a build leaves them that dies while it moves its files, are no table."""
    part = spark.createDataFrame([(1, "half")], SILVER["genres"])
    part.write.parquet(str(tmp_path / "silver" / "genres"))
    part.write.parquet(str(tmp_path / "silver" / "genres" / "0123"))
    lake = Lake(spark, lambda: bronze_of(spark, [lookup(DAY[0], (1, "a"), (2, "b"))]), str(tmp_path), "half")
    assert rows_of(lake.silver("genres")) == [(1, "a"), (2, "b")]


def test_unnamed_lakes_keep_no_builds(spark):
    with pytest.raises(ValueError, match="name"):
        Lake(spark, lambda: None).rewrite("silver.genres")


def test_rows_are_counted_while_written(spark, tmp_path):
    rows = sum(BATCHES, [])
    for lake in (Lake(spark, lambda: bronze_of(spark, rows)), Lake(spark, lambda: bronze_of(spark, rows), str(tmp_path), "counted"),
                 Lake(spark, lambda: None, str(tmp_path), "counted")):
        tables = {"raw_movies": lake.bronze, **lake.silver_tables(), **lake.gold_tables()}
        assert rows_of(lake.row_counts()) == sorted((n, t.count()) for n, t in tables.items())
        # The last batch has the latest time; a reopened lake looks it up.
        assert spark.range(1).select(lake.as_of()).first()[0] == DAY[6]
    assert rows_of(lake.rebuilt().row_counts()) == rows_of(lake.row_counts())
