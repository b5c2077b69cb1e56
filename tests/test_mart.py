"""Slices from the mart against the fact, sketches against exact answers, lookups that read little."""

from __future__ import annotations

import itertools

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from stratalake.plans import mart, reports
from stratalake.plans.lake import Lake
from stratalake.sources import tables
from stratalake.sources.workspace import store

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark):
    return Lake.from_tables(spark, FOLDER)


@pytest.fixture(scope="module")
def cells(lake):
    star = [lake.gold(n) for n in ("fact_movie", "dim_date", "bridge_movie_genre", "dim_genre", "dim_language")]
    return store(mart.slicer_cells(*star))


YEARS = [None, (1992, 1992), (1993, 1996), (1800, 1801)]
GENRES = [None, ["ECONOMY"], ["ECONOMY", "PROMO", "SMALL"], ["NONE"], []]


@pytest.mark.parametrize(("years", "genres"), list(itertools.product(YEARS, GENRES)))
def test_any_slice_equals_the_fact(lake, cells, years, genres):
    star = [lake.gold(n) for n in ("fact_movie", "dim_date", "bridge_movie_genre", "dim_genre")]
    want = reports.overview_sliced(*star, years, genres).first().asDict()
    found = mart.overview(cells, years, genres).first().asDict()
    assert found.keys() == want.keys()
    for name, value in want.items():
        assert found[name] == (value if value is None else pytest.approx(value, abs=1.5e-6)), name


def test_languages_are_sliced_too(lake, cells):
    codes = rows_of(lake.gold("dim_language"), "language_code")[:2]
    fact = lake.gold("fact_movie").join(lake.gold("dim_language"), "language_key")
    want = fact.where(F.col("language_code").isin(*[c for c, in codes])).count()
    assert mart.overview(cells, languages=[c for c, in codes]).first().movie_count == want


def test_cells_do_not_overlap(lake, cells):
    assert cells.agg(F.sum("movies")).first()[0] == lake.gold("fact_movie").count()
    totals = mart.slicer_totals(cells).groupBy("sliced_by").agg(F.sum("movie_count").alias("n"))
    n = dict(rows_of(totals))
    movies = lake.gold("fact_movie").count()
    assert n["all"] == n["calendar_year"] == n["calendar_year+language_code"] == movies
    assert n["genre_name"] == n["calendar_year+genre_name"] == lake.gold("bridge_movie_genre").count() > movies


def test_the_mart_does_not_read_the_fact(cells):
    plan = mart.overview(cells, (1993, 1996), ["PROMO"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_sketches_of_new_movies_are_united(spark):
    movies = spark.range(4_000).select(
        (F.col("id") % 500).cast("int").alias("runtime"), (F.col("id") % 4).cast("int").alias("release_year"))
    quarters = {"q1": 0.25, "q3": 0.75}
    old = store(mart.quantile_sketches(movies.where("release_year < 3"), "runtime", "release_year"))
    new = mart.quantile_sketches(movies.where("release_year = 3"), "runtime", "release_year")
    found = mart.quantiles(old.unionByName(new), quarters).first()
    assert abs(found.q1 - 125) <= 500 * mart.RANK_ERROR and abs(found.q3 - 375) <= 500 * mart.RANK_ERROR
    assert rows_of(mart.quantile_check(movies, "runtime", "release_year", quarters), "quantile", "within_bound") == [
        ("q1", True), ("q3", True)]
    nothing = mart.quantiles(mart.quantile_sketches(movies.limit(0), "runtime", "release_year"), quarters)
    assert tuple(nothing.first()) == (None, None)


def test_a_lookup_reads_few_rows(spark, tmp_path):
    n = 200_000
    rows = spark.range(n).select((F.col("id") * 7).alias("movie_id"), F.concat(F.lit("title "), F.col("id")).alias("title"))
    path = str(tmp_path / "pages")
    clustered = tables.write_clustered(rows.repartition(8), path, "movie_id", files=4, group_rows=5_000)
    found = tables.lookup(clustered, "movie_id", [7 * 1_234, 7 * 150_001, 3, -1])
    assert sorted(r.title for r in found.collect()) == ["title 1234", "title 150001"]
    assert scanned(found) <= 4 * 5_000
    # A value inside every file's range that nothing has: only the Bloom filter can tell.
    absent = tables.lookup(clustered, "movie_id", [7 * 100_000 + 3])
    assert absent.collect() == [] and scanned(absent) == 0
    assert rows_of(tables.lookup(clustered, "movie_id", [])) == []


def scanned(df):
    """Rows that the scan of an executed frame has put out."""
    plan = df._jdf.queryExecution().executedPlan()
    if "AdaptiveSparkPlan" in plan.nodeName():
        plan = plan.executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_key_of_very_many_rows_is_spread(spark, tmp_path):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).cast("bigint").alias("movie_id"), "id")
    clustered = tables.write_clustered(rows, str(tmp_path / "hot"), "movie_id", files=6)
    per_file = clustered.where("movie_id = 5").groupBy(F.input_file_name()).count()
    assert per_file.count() > 1
    assert tables.lookup(clustered, "movie_id", [5]).count() == rows.where("movie_id = 5").count()
