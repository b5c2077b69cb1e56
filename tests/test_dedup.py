from __future__ import annotations

from datetime import datetime

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.operators.dedup import preference
from stratalake.plans import silver, silver_sql

OLD, NEW = datetime(2024, 1, 1), datetime(2024, 1, 2)
FULL = {"id": 1, "title": "full", "budget": 5, "genres": []}
BARE = {"id": 1, "title": "bare"}


def _titles(df):
    return rows_of(df, "title")


@pytest.mark.parametrize("policy", ["priority", "recency"])
def test_most_complete_wins_over_newer(bronze, policy):
    rows = bronze(("trending", FULL, OLD), ("details", BARE, NEW))
    assert _titles(silver.movies(silver.staged(rows), policy)) == [("full",)]
    assert _titles(silver_sql.movies(rows, policy)) == [("full",)]


def test_policies_differ_on_equal_scores(bronze):
    rows = bronze(("discover", {"id": 1, "title": "discover"}, OLD), ("trending", {"id": 1, "title": "trending"}, NEW))
    assert _titles(silver.movies(silver.staged(rows), "priority")) == [("discover",)]
    assert _titles(silver.movies(silver.staged(rows), "recency")) == [("trending",)]
    assert _titles(silver_sql.movies(rows, "priority")) == [("discover",)]
    assert _titles(silver_sql.movies(rows, "recency")) == [("trending",)]


@pytest.mark.parametrize("order", [("details", "discover", "popular", "trending")])
def test_endpoint_ranking(bronze, order):
    for better, worse in zip(order, order[1:]):
        rows = bronze((worse, {"id": 1, "title": worse}), (better, {"id": 1, "title": better}))
        assert _titles(silver.movies(silver.staged(rows))) == [(better,)]


def test_unknown_policy():
    with pytest.raises(ValueError, match="unknown policy"):
        preference("newest")


def test_winner_does_not_depend_on_row_order(bronze):
    """Full ties are broken by the payload, whatever the order and the partitioning."""
    docs = [("details", {"id": i % 7, "title": f"t{i}"}) for i in range(200)]
    rows = bronze(*docs)
    expected = rows_of(silver.movies(silver.staged(rows)))
    for seed, parts in ((1, 1), (2, 3), (3, 17)):
        shuffled = rows.orderBy(F.rand(seed)).repartition(parts)
        assert rows_of(silver.movies(silver.staged(shuffled))) == expected
        assert rows_of(silver_sql.movies(shuffled, "priority")) == expected


def test_hot_movie_against_brute_force(spark):
    """One movie holds most of the copies; the result equals a plain reduction in Python."""
    n = 20_000
    stage_rows = spark.range(n).select(
        F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 500).cast("bigint").alias("movie_id"),
        (F.col("id") * 7 % 11).cast("int").alias("completeness_score"),
        F.lit("details").alias("source_endpoint"),
        F.timestamp_seconds(F.col("id") * 13 % 101).cast("timestamp_ntz").alias("ingested_at"),
        F.xxhash64("id").alias("payload_hash"),
        F.col("id").alias("row"),
    )
    from stratalake.operators.dedup import keep_first

    got = dict(rows_of(keep_first(stage_rows, "movie_id", preference("priority")), "movie_id", "row"))
    best: dict = {}
    for r in stage_rows.collect():
        rank = (r.completeness_score, r.ingested_at, -r.payload_hash)
        if r.movie_id not in best or rank > best[r.movie_id][0]:
            best[r.movie_id] = (rank, r.row)
    assert got == {k: v[1] for k, v in best.items()}
