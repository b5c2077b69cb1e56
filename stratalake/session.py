"""Session settings the plans count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

MIN_SPLITS = "spark.sql.files.minPartitionNum"
#: Splits a core gets in a scan of files that are large enough.
SPLITS_A_CORE = 3


def configured(master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """A builder with adaptive execution (coalescing, skew splitting) and UTC.

    On a cluster leave ``master`` to the submit command, set ``spark.checkpoint.dir`` there, and give
    ``shuffle_partitions`` generously (total shuffle bytes / 128 MB): adaptive execution merges what is
    too small, but it cannot split a shuffle that is not skewed and merely too coarse. Memory is left to the caller.
    """
    builder = (
        SparkSession.builder.appName("stratalake")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # More than the endpoints there are: a partitioned write then keeps its files open instead of
        # sorting whole documents by endpoint first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Several splits per core even out documents that compress differently.
        builder = builder.config("spark.sql.files.minPartitionNum", str(2 * shuffle_partitions))
    return builder


def spread(spark: SparkSession) -> None:
    """Let scans have several splits a core, in a session that says nothing of its own about them.

    Splits are measured in compressed bytes, of which documents have few for the work they are: by default a scan has
    about one split a core, and all cores wait for the longest.
    """
    if spark.conf.get(MIN_SPLITS, None) is None:
        spark.conf.set(MIN_SPLITS, str(SPLITS_A_CORE * spark.sparkContext.defaultParallelism))
