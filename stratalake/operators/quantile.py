"""Exact quantiles of an integer column with bounded buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_LOW_BITS = 16


def exact_quantiles(df: DataFrame, column: str, probabilities: dict[str, float]) -> DataFrame:
    """One row with a DOUBLE column per named probability, linearly interpolated; NULLs are skipped.

    ``percentile`` keeps every distinct value in one buffer. Here an INT column is counted by its high
    16 bits first (at most 65,536 groups), which tells the few groups that hold the wanted positions;
    only those are counted by value (again at most 65,536 each). Both counts combine on the map side.
    """
    values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("int").alias("v"))
    values = values.withColumn("hi", F.shiftright("v", _LOW_BITS))
    upto = Window.orderBy("hi").rowsBetween(Window.unboundedPreceding, 0)
    coarse = (
        values.groupBy("hi").agg(F.count("*").alias("n"))
        .select(
            "hi", "n",
            F.sum("n").over(upto).alias("upto"),
            F.sum("n").over(Window.partitionBy()).alias("total"),
        )
        .withColumn("before", F.col("upto") - F.col("n"))
    )
    # Zero-based positions around each quantile: floor and ceiling of p * (total - 1).
    wanted = F.array(*[
        F.struct(
            F.lit(name).alias("name"),
            F.lit(side).alias("side"),
            (F.lit(float(p)) * (F.col("total") - 1)).alias("at"),
            rounded(F.lit(float(p)) * (F.col("total") - 1)).cast("bigint").alias("pos"),
        )
        for name, p in probabilities.items()
        for side, rounded in (("lo", F.floor), ("hi", F.ceil))
    ])
    hits = coarse.select(
        "hi", "before",
        F.explode(F.filter(wanted, lambda w: (w.pos >= F.col("before")) & (w.pos < F.col("upto")))).alias("w"),
    )
    # hits has two rows per probability at most.
    within = Window.partitionBy("hi").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    fine = (
        values.join(F.broadcast(hits.select("hi").distinct()), "hi", "left_semi")
        .groupBy("hi", "v").agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(within))
    )
    found = (
        fine.join(F.broadcast(hits), "hi")
        .where(
            (F.col("w.pos") < F.col("before") + F.col("upto"))
            & (F.col("w.pos") >= F.col("before") + F.col("upto") - F.col("n"))
        )
        .select("w.name", "w.side", "w.at", "v")
    )
    aggs = []
    for name in probabilities:
        lo = F.max(F.when((F.col("name") == name) & (F.col("side") == "lo"), F.col("v").cast("double")))
        hi = F.max(F.when((F.col("name") == name) & (F.col("side") == "hi"), F.col("v").cast("double")))
        at = F.max(F.when(F.col("name") == name, F.col("at")))
        aggs.append((lo + (hi - lo) * (at - F.floor(at))).alias(name))
    return found.agg(*aggs)
