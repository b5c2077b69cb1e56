"""Which folders hold a table: records that readers go by.

A writer puts rows into a folder of its own and then adds a record that names it. Records are rows of a small Parquet
table; all records of one step are one file, whose commit is the moment at which the step shows, for every table it
touched at once. A write that dies before leaves a folder that no record names, and the rows of before stay readable.
One writer at a time is assumed. Folders are named relative to the root, so a lake can be copied as a whole.

A table has parts: buckets of its key, batches, or just part 0. Of a part that is replaced the newest record counts, of
one that is appended to all do. Records carry the rows counted while they were written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform
from .tables import WRITE_OPTIONS
from .workspace import unsorted_writes

RECORDS = "published"
_RECORD = "table_name STRING, version BIGINT, part INT, folder STRING, row_count BIGINT"


class Record(NamedTuple):
    table_name: str
    version: int
    part: int
    folder: str
    row_count: int


def write_counted(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write the rows to a new folder and return their number, which is observed on the way to the files.

    The observation sits in the stage that writes, whose tasks are each counted once however often they are tried.
    """
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("row_count")).write.options(**WRITE_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_writes(df.sparkSession):
        writer.parquet(path)
    return counted.get["row_count"]


def new_folder(table: str, partitioned: bool = False) -> str:
    """A folder, relative to the root, that nothing has used yet.

    Folders of partitioned rows are partitions of the table's folder themselves, so that several can be read as one.
    """
    return f"{table}/{'step=' if partitioned else ''}{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, records: Iterable[Record]) -> None:
    """Make the records count, all at once."""
    rows = [tuple(r) for r in records]
    if rows:
        spark.createDataFrame(rows, _RECORD).coalesce(1).write.mode("append").parquet(f"{root}/{RECORDS}")


def records(spark: SparkSession, root: str) -> list[Record]:
    """All records below a root, oldest first. There is one per table, part and step, never one per row."""
    try:
        found = spark.read.schema(_RECORD).parquet(f"{root}/{RECORDS}").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((Record(*r) for r in found), key=lambda r: (r.version, r.table_name, r.part))


def next_version(found: list[Record]) -> int:
    return max((r.version for r in found), default=0) + 1


def appended(found: list[Record], table: str, parts: Iterable[int] | None = None) -> list[Record]:
    """The records of a table to which parts are added."""
    wanted = None if parts is None else set(parts)
    return [r for r in found if r.table_name == table and (wanted is None or r.part in wanted)]


def current(found: list[Record], table: str, parts: Iterable[int] | None = None) -> list[Record]:
    """The newest record of each part of a table whose parts are replaced."""
    return list({r.part: r for r in appended(found, table, parts)}.values())


def read(
    spark: SparkSession, root: str, chosen: list[Record], schema: T.StructType, partitioned: bool = False
) -> DataFrame:
    """The rows of the recorded folders of one table, and no other file."""
    filled = [r for r in chosen if r.row_count]
    if not filled:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if partitioned:
        reader = reader.option("basePath", f"{root}/{filled[0].table_name}")
    return conform(reader.parquet(*sorted({f"{root}/{r.folder}" for r in filled})), schema)


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


#: A bucket is gathered in that many slots, so that it is no single task.
SLOTS, SLOT = 8, "_slot"


def in_slots(df: DataFrame, buckets: tuple[str, int]) -> DataFrame:
    """Rows gathered by a part of their key's bucket, which a column ``SLOT`` names.

    What is then grouped by the slot and the key needs no further exchange, nor does writing by bucket.
    """
    key, number = buckets
    return df.withColumn(SLOT, bucket_of(F.col(key), SLOTS * number)).repartition(SLOT)


def write_buckets(
    df: DataFrame, root: str, table: str, version: int, buckets: tuple[str, int], touched: Iterable[int]
) -> list[Record]:
    """Write rows by the bucket of their key, ``(column, number)``, and return the records of the touched buckets.

    Rows that are in slots already stay where they are. For others, rebalancing splits a bucket that holds much and merges
    little ones into few files. Rows per bucket are counted from the files' footers: the bucket is named by the folder,
    so no column is read.
    """
    spark, (key, number) = df.sparkSession, buckets
    folder = new_folder(table)
    marked = df.withColumn("bucket", bucket_of(F.col(key), number))
    marked = marked.drop(SLOT) if SLOT in df.columns else marked.hint("rebalance", "bucket")
    written = write_counted(marked, f"{root}/{folder}", ("bucket",))
    counts = {}
    if written:
        per_bucket = spark.read.schema(marked.schema).parquet(f"{root}/{folder}").groupBy("bucket")
        counts = {r["bucket"]: r["n"] for r in per_bucket.agg(F.count("*").alias("n")).collect()}
    return [Record(table, version, b, f"{folder}/bucket={b}", counts.get(b, 0)) for b in sorted(touched)]
