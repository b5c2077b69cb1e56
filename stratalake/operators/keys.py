"""Dense surrogate keys: 1..n in sort order, without sorting everything in one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# monotonically_increasing_id() = partition number << 33 | position in the partition.
_POSITION_BITS = 33


def dense_key(
    df: DataFrame, order: list[str], key: str, store: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Number the rows 1..n by ``order`` (which must be unique) into a new first column ``key``.

    Range partition, sort inside the partitions, remember each row's partition and position, and add
    the number of rows in the partitions before it. ``store`` writes the positioned rows to a shared
    table and reads them back: sampled range bounds may differ when a lost stage is run again, the
    written positions cannot.
    """
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = store(marked)
    part = F.shiftright("_place", _POSITION_BITS).alias("_part")
    # One row per range partition, so this never exceeds the shuffle partition count.
    sizes = placed.groupBy(part).agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_before") + position + 1).alias(key), *df.columns)
    )
