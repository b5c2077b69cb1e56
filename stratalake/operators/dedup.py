"""Keep the most complete record per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.clean import ranked
from ..schemas import ENDPOINT_PRIORITY

POLICIES = ("priority", "recency")


def preference(policy: str) -> list[Column]:
    """Sort order that puts the preferred record of a movie first.

    ``priority`` ranks by score, then source endpoint, then time; ``recency`` leaves the endpoint
    out. The payload hash makes the order total, so the winner does not depend on row order.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}, expected one of {POLICIES}")
    endpoint = ranked(F.col("source_endpoint"), ENDPOINT_PRIORITY)
    ranks = [F.col("completeness_score"), *([endpoint] if policy == "priority" else []), F.col("ingested_at")]
    return [*[r.desc() for r in ranks], F.col("payload_hash").asc()]


def keep_first(
    df: DataFrame, key: str | list[str], order: list[Column], n: int = 1, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows per key in the given order, with their place in a column ``rank`` if named.

    ``row_number() <= n`` plans a WindowGroupLimit on both sides of the shuffle: each map task
    sends at most ``n`` rows per key, so a key holding most of the copies stays cheap.
    """
    place = rank or "_rank"
    window = Window.partitionBy(key).orderBy(*order)
    first = df.withColumn(place, F.row_number().over(window)).where(F.col(place) <= n)
    return first if rank else first.drop(place)
