from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from stratalake.operators.keys import dense_key
from stratalake.operators.quantile import exact_quantiles
from stratalake.operators.spine import date_key, date_spine
from stratalake.plans import gold
from stratalake.schemas import SILVER
from stratalake.sources.workspace import store

AT = datetime(2024, 1, 1)


@pytest.fixture
def movies(spark):
    def make(*rows):
        names = SILVER["movies"].fieldNames()
        blank = dict.fromkeys(names) | {"ingested_at": AT}
        return spark.createDataFrame([tuple((blank | row)[n] for n in names) for row in rows], SILVER["movies"])

    return make


@pytest.mark.parametrize("n", [1, 7, 5000])
def test_dense_key_equals_global_row_number(spark, n):
    df = spark.range(n).select((F.col("id") * 7919 % 100_003).alias("k"), F.col("id").alias("v"))
    got = dense_key(df.repartition(13), ["k"], "key", store)
    expected = df.withColumn("key", F.row_number().over(Window.orderBy("k"))).select("key", "k", "v")
    assert got.columns == ["key", "k", "v"]
    assert rows_of(got) == rows_of(expected)


def test_dense_key_of_nothing(spark):
    assert dense_key(spark.range(0).select(F.col("id").alias("k")), ["k"], "key", store).count() == 0


def test_dense_key_by_text_and_id(spark):
    df = spark.createDataFrame([("b", 1), ("a", 9), ("b", 0), ("B", 5)], "name string, id bigint")
    assert rows_of(dense_key(df, ["name", "id"], "key", store)) == [
        (1, "B", 5), (2, "a", 9), (3, "b", 0), (4, "b", 1)
    ]


def test_date_spine_covers_gaps_and_leap_days(spark, movies):
    rows = movies({"movie_id": 1, "release_date": date(2020, 2, 27)}, {"movie_id": 2},
                  {"movie_id": 3, "release_date": date(2020, 3, 2)})
    days = rows_of(gold.dim_date(rows))
    assert [d[0] for d in days] == [20200227, 20200228, 20200229, 20200301, 20200302]
    assert days[-1] == (20200302, date(2020, 3, 2), 2020, 1, 3, "March")
    assert date_spine(rows.where("release_date IS NULL"), "release_date").count() == 0


def test_languages_and_genres_are_numbered_in_order(spark, movies):
    rows = movies(*[{"movie_id": i, "original_language": c} for i, c in enumerate(["FR", "EN", None, "FR", "DE"])])
    assert rows_of(gold.dim_language(rows, store)) == [(1, "DE"), (2, "EN"), (3, "FR")]
    genres = spark.createDataFrame([(28, "War"), (3, "Action")], SILVER["genres"])
    assert rows_of(gold.dim_genre(genres, store)) == [(1, 3, "Action"), (2, 28, "War")]


def _fact(movies):
    keyed = gold.keyed_movies(movies, store)
    return keyed, gold.fact_movie(keyed, gold.dim_language(movies, store))


@pytest.mark.parametrize(
    ("budget", "revenue", "profit", "roi"),
    [(4, 10, 6, 1.5), (None, 6, None, None), (8, None, None, None), (None, None, None, None), (10, 5, -5, -0.5),
     (0, 5, 5, None)],
)
def test_profit_and_roi_are_null_safe(movies, budget, revenue, profit, roi):
    _, fact = _fact(movies({"movie_id": 1, "budget": budget, "revenue": revenue}))
    assert rows_of(fact, "profit", "roi") == [(profit, roi)]


def test_fact_keeps_movies_without_date_or_language(movies):
    rows = movies({"movie_id": 7}, {"movie_id": 3, "original_language": "EN", "release_date": date(2021, 5, 6)})
    _, fact = _fact(rows)
    assert rows_of(fact, "movie_key", "date_key", "language_key") == [(1, 20210506, 1), (2, None, None)]


def test_arithmetic_date_key_equals_the_join(movies):
    rows = movies(*[{"movie_id": i, "release_date": date(2019 + i % 4, 1 + i % 12, 1 + i % 28)} for i in range(200)])
    dim = gold.dim_date(rows)
    joined = rows.join(dim, rows.release_date == dim.full_date, "left")
    assert joined.where(~F.col("date_key").eqNullSafe(date_key("release_date"))).count() == 0


def test_bridge_drops_orphans(spark, movies):
    rows = movies({"movie_id": 1}, {"movie_id": 2})
    keyed, _ = _fact(rows)
    genres = gold.dim_genre(spark.createDataFrame([(5, "x")], SILVER["genres"]), store)
    pairs = spark.createDataFrame([(1, 5), (1, 99), (3, 5), (2, 5), (2, None)], SILVER["movie_genres"])
    assert rows_of(gold.bridge_movie_genre(pairs, gold.dim_movie(keyed), genres)) == [(1, 1), (2, 1)]


def test_studio_names_may_be_merged_by_collation(spark, movies):
    rows = movies({"movie_id": 1, "revenue": 5}, {"movie_id": 2, "revenue": 7})
    keyed, fact = _fact(rows)
    companies = spark.createDataFrame([(1, "Acme"), (2, "ACME")], SILVER["movie_companies"])
    exact = gold.studio_performance(companies, gold.dim_movie(keyed), fact)
    assert rows_of(exact, "company_name", "movie_count", "total_revenue") == [("ACME", 1, 7), ("Acme", 1, 5)]
    merged = gold.studio_performance(companies, gold.dim_movie(keyed), fact, "UTF8_LCASE")
    assert rows_of(merged, "movie_count", "total_revenue") == [(2, 12)]


@pytest.mark.parametrize(
    "values",
    [[1], [5, 5, 5, 5], [1, 2], list(range(101)), [None, 3, None, 9, 4],
     [-(2**31), 2**31 - 1, 0, 65_535, 65_536, -65_536, -65_537, -1, 1],
     [(i * 2_654_435_761) % 2**31 - 2**30 for i in range(3000)], [7] * 900 + [200_000] * 100],
)
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    probabilities = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.99, "f": 1.0}
    got = exact_quantiles(df, "x", probabilities).first().asDict()
    expected = df.agg(*[F.percentile("x", p).alias(n) for n, p in probabilities.items()]).first().asDict()
    assert got == pytest.approx(expected)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(spark.createDataFrame([(None,)], "x int"), "x", {"m": 0.5}).first().m is None
