"""What joins, merges and scans move, on rows made here."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from stratalake import session
from stratalake.operators import enforce
from stratalake.operators.dedup import keep_first, preference
from stratalake.plans import gold
from stratalake.plans.growing import RANKED
from stratalake.schemas import SILVER
from stratalake.sources import catalogue, published

DAY = datetime(1996, 5, 1)
TABLES = {
    "nation": ("n_nationkey int, n_name string", [(1, "PERU"), (2, "CHINA")]),
    "customer": ("c_custkey bigint, c_nationkey int", [(1, 1), (2, None)]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "S1", 2), (2, "S2", None)]),
    "part": ("p_partkey bigint, p_brand string, p_type string", [(1, "b", "PROMO"), (2, "b", None)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp,"
        " o_orderpriority string",
        [
            (1, 1, "O", 10.5, DAY, "3-LOW"), (2, 2, "O", 10.5, DAY, "3-LOW"), (2, 2, "O", 10.5, DAY, "3-LOW"),
            (None, 1, "O", 10.5, DAY, "3-LOW"), (4, None, None, None, None, None), (5, 1, "P", 1.0, DAY, "5-LOW"),
        ],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_tax double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [
            (1, 1, 1, 1, 9.0, 0.1, "R", "O", DAY), (1, 2, 2, 2, 10.0, 0.0, "N", "F", DAY),
            (1, 9, 9, 7, None, None, None, None, None), (None, 1, 1, 1, 1.0, 0.1, "R", "O", DAY), (5, 1, 1, 1, 1.0, 0.1, "R", "O", DAY),
        ],
    ),
    "pages": ("html string", []),
    "events": ("props string", []),
}


def written(spark, folder):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_documents_of_movies(spark, tmp_path):
    """Movies without a key, without line items and twice, and line items that lack their part, supplier or values."""
    rows = catalogue.bronze(spark, written(spark, tmp_path)).where("source_endpoint IN ('details', 'credits')").collect()
    got = {}
    for r in rows:
        got.setdefault((r["source_endpoint"], r["movie_id"]), []).append((r["ingested_at"], json.loads(r["payload"])))
    assert {key: len(docs) for key, docs in got.items()} == {
        (e, key): n for e in ("details", "credits") for key, n in ((1, 3), (2, 2), (None, 1))
    }
    bare = [doc for key in (2, None) for _, doc in got["details", key]]
    assert all(doc["genres"] == [] and doc["spoken_languages"] == [] for doc in bare)
    assert {at for key in (2, None) for at, _ in got["credits", key]} == {datetime(2024, 1, 1)}
    by_slot = {doc["genres"][1]["name"]: (at, doc) for at, doc in got["details", 1]}
    assert by_slot["slot 1"][1]["genres"] == [
        {"id": 4, "name": "PROMO"}, {"id": 1, "name": "slot 1"}, {"id": 4, "name": "PROMO"}]
    assert [c.get("name") for c in by_slot["slot 1"][1]["production_companies"]] == ["S1", "CHINA Pictures", "S1"]
    assert by_slot["slot 1"][1]["runtime"] == "1" and "runtime" not in by_slot["slot 2"][1] and "runtime" not in by_slot["slot 7"][1]
    assert by_slot["slot 2"][1]["genres"][2] is None and by_slot["slot 7"][0] is None
    people = {doc["cast"][0]["name"]: doc for _, doc in got["credits", 1]}
    assert [p["job"] for p in people["Person 1"]["crew"]] == ["Director", "Writer"]
    assert [p["job"] for p in people["Person 2"]["crew"]] == ["Producer", "director"]
    assert people["Person 1"]["cast"][0]["order"] == 0 and people["Person 1"]["cast"][1]["order"] == 1
    assert "order" not in people["Person 2"]["cast"][0] and people["Person 2"]["cast"][1]["order"] == 2
    assert "order" not in people["Person 9"]["cast"][0] and "order" not in people["Person 9"]["cast"][1]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_move_orders_before_texts_are_made(spark, tmp_path):
    """Where nothing is broadcast, both joins with line items deal out plain columns of orders, once."""
    folder, broadcast = written(spark, tmp_path), "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        df = catalogue.bronze(spark, folder)
        assert "hashpartitioning(o_orderkey" in plan_of(df) and "hashpartitioning(id" not in plan_of(df)
        df.collect()
        assert "ReusedExchange" in plan_of(df)
    finally:
        spark.conf.set(broadcast, before)


def test_a_merge_deals_rows_out_once(spark):
    rows = published.in_slots(spark.createDataFrame([], RANKED), ("movie_id", 8))
    best = keep_first(rows, [published.SLOT, "movie_id"], preference("priority"))
    pairs = published.in_slots(spark.createDataFrame([], SILVER["movie_genres"]), ("movie_id", 8)).distinct()
    assert [plan_of(df).count("Exchange ") for df in (best, pairs)] == [1, 1]


def test_slots_are_parts_of_buckets(spark):
    slots = published.in_slots(spark.range(1000).toDF("movie_id"), ("movie_id", 8))
    split = slots.select(published.SLOT, published.bucket_of(F.col("movie_id"), 8).alias("bucket")).distinct().collect()
    assert len(split) == 8 * published.SLOTS and all(s % 8 == b for s, b in split)


def test_keyed_movies_leave_out_what_neither_dimension_nor_fact_has(spark):
    assert "ingested_at" not in gold.keyed_movies(spark.createDataFrame([], SILVER["movies"]), lambda df: df).columns


def test_scans_have_several_splits_a_core(spark):
    before = spark.conf.get(session.MIN_SPLITS, None)
    try:
        spark.conf.unset(session.MIN_SPLITS)
        session.spread(spark)
        assert int(spark.conf.get(session.MIN_SPLITS)) == 3 * spark.sparkContext.defaultParallelism
        spark.conf.set(session.MIN_SPLITS, "5")
        session.spread(spark)
        assert spark.conf.get(session.MIN_SPLITS) == "5"
    finally:
        if before is None:
            spark.conf.unset(session.MIN_SPLITS)
        else:
            spark.conf.set(session.MIN_SPLITS, before)


def test_enforcing_a_key_deals_rows_out_once(spark, monkeypatch):
    """Usual keys meet in one exchange; keys with many rows, null among them, give the same verdicts."""
    rows = spark.createDataFrame(
        [(k % 3 or None, k % 7, "x" if k % 2 else None) for k in range(60)], "id bigint, rank int, name string"
    )
    rules = enforce.Constraints(not_null=("id",), key=("id",), order=(F.col("rank").asc(),), checks={"named": F.col("name").isNotNull()})
    usual = enforce.judged(rows, rules)
    light = plan_of(usual).split("Union")[1].split("BroadcastExchange")[0]
    assert light.count("Exchange hashpartitioning") == 1
    monkeypatch.setattr(enforce, "MANY", 5)
    many = enforce.judged(rows, rules)
    show = lambda df: sorted(map(str, df.collect()))
    assert show(usual) == show(many)
    # By hand: each id has its lowest rank with a name accepted once; everything else is a reject.
    accepted = {(r["id"], r["rank"], r["occurrences"]) for r in usual.where("verdict = 'accepted'").collect()}
    assert accepted == {(1, 0, 1), (2, 0, 1)}
    assert usual.agg(F.sum("occurrences")).first()[0] == 60
