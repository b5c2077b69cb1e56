"""Where written tables go: the folder all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Folders a task writes into at the same time; rows of further ones are sorted by folder first.
OPEN_FOLDERS = 32


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or one in the warehouse, which executors share as well."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stages"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write the rows and read them back: cuts the lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = fresh_path(spark, "stage")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def packed(df: DataFrame) -> DataFrame:
    """``store`` for frames as large as a layer: smaller files for a little more work."""
    return store(df, "zstd")


@contextmanager
def unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Writes into few folders keep a file open for each, where Spark would sort whole documents by folder first.

    A session that has its own number of open files keeps it.
    """
    before = int(spark.conf.get(OPEN_WRITERS))
    if before <= 0:
        spark.conf.set(OPEN_WRITERS, str(OPEN_FOLDERS))
    try:
        yield
    finally:
        if before <= 0:
            spark.conf.set(OPEN_WRITERS, str(before))
