"""Writing and reading the layered tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import conform
from .workspace import unsorted_writes

# A reader splits files by their compressed bytes, and copies of a document compress to almost nothing:
# without a bound on the rows, one split could hold most of the text there is to parse.
WRITE_OPTIONS = {"compression": "zstd", "maxRecordsPerFile": "250000"}

def create_namespace(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")


def replace_table(
    df: DataFrame, name: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Drop and recreate a table from a frame that must have the declared columns and types."""
    writer = conform(df, schema).write.mode("overwrite").format("parquet").options(**WRITE_OPTIONS)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with unsorted_writes(df.sparkSession):
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def refill_table(df: DataFrame, name: str) -> DataFrame:
    """Empty an existing table and fill it again, keeping its definition."""
    spark = df.sparkSession
    conform(df, spark.table(name).schema).write.insertInto(name, overwrite=True)
    return spark.table(name)


# A folder that a stream has written is read through the stream's own log and shows nothing else. So a
# bronze table has one folder for batches and one for streams, and readers take both.
BATCH_FOLDER, STREAM_FOLDER = "batch", "stream"
DIGEST = "digest"


def with_digest(df: DataFrame) -> DataFrame:
    """Bronze rows with a SHA-256 over endpoint, id and payload, by which a document is known.

    It is stored beside the row, so that nobody has to read old payloads to recognise a document. Rows that have
    their digest keep it.
    """
    if DIGEST in df.columns:
        return df
    movie_id: Column = F.coalesce(F.col("movie_id").cast("string"), F.lit(""))
    return df.withColumn(DIGEST, F.sha2(F.concat_ws("\n", "source_endpoint", movie_id, "payload"), 256))


def _digested(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The table's columns and the digest, which is worked out only where the rows do not carry it."""
    return conform(with_digest(df), T.StructType([*schema.fields, T.StructField(DIGEST, T.StringType())]))


def append_bronze(df: DataFrame, path: str, schema: T.StructType) -> None:
    writer = _digested(df, schema).write.mode("append").options(**WRITE_OPTIONS)
    with unsorted_writes(df.sparkSession):
        writer.partitionBy("source_endpoint").parquet(f"{path}/{BATCH_FOLDER}")


def overwrite_bronze(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Replace the endpoints found in the frame; the folders of other endpoints stay.

    Rows that a stream has landed can't be replaced this way, and a table with any is refused.
    """
    if _part(df.sparkSession, path, STREAM_FOLDER, schema) is not None:
        raise ValueError(f"{path} holds rows landed by a stream; land the endpoint into another table")
    with unsorted_writes(df.sparkSession):
        (
            _digested(df, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .options(**WRITE_OPTIONS).partitionBy("source_endpoint").parquet(f"{path}/{BATCH_FOLDER}")
        )


def _part(spark: SparkSession, path: str, folder: str, schema: T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(f"{path}/{folder}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    parts = [_part(spark, path, folder, schema) for folder in (BATCH_FOLDER, STREAM_FOLDER)]
    found = [part for part in parts if part is not None] or [spark.createDataFrame([], schema)]
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def read_bronze(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows of a bronze table, however they were landed; none where there is no table yet."""
    return _parts(spark, path, schema)


def landed_digests(spark: SparkSession, path: str) -> DataFrame:
    """``digest`` and endpoint of the documents in a bronze table; reads no payload."""
    return _parts(spark, path, T.StructType().add(DIGEST, T.StringType()).add("source_endpoint", T.StringType()))


#: Rows of a row group in a clustered table: a lookup reads one or two of them.
GROUP_ROWS = 50_000


def write_clustered(df: DataFrame, path: str, key: str, files: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Write rows so that few of them are read to find those of given keys.

    Files hold ranges of the key and are sorted by it, so statistics leave out all but the fitting row groups, and a
    Bloom filter on the key leaves out those that only might have fitted. A key of very many rows makes a long range; it
    is spread over files by the hash of the whole row.
    """
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files))
    (
        df.repartitionByRange(files, F.col(key), spread).sortWithinPartitions(key).write.option("compression", "zstd")
        .option("parquet.block.row.count.limit", str(group_rows)).option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(group_rows)).parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(clustered: DataFrame, key: str, values: list) -> DataFrame:
    """The rows of the given keys; the list is part of the pushed filter, so keep it to what a report page shows."""
    return clustered.where(F.col(key).isin(*values)) if values else clustered.where(F.lit(False))


def by_endpoint(bronze: DataFrame, *endpoints: str) -> DataFrame:
    """Bronze rows of the given endpoints; on a partitioned table only their folders are read."""
    return bronze.where(F.col("source_endpoint").isin(*endpoints))


def unseen_documents(batch: DataFrame, known: DataFrame, store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of a batch whose document is not among the ``known`` digests yet, each once.

    Payloads are not moved to tell documents apart. At an endpoint that has landed nothing yet all documents are new, and
    only those whose hash of the digest occurs again, be it by chance, have to be folded. They and the documents of the other
    endpoints are compared by their digests, and only then are the payloads of what is new looked at; copies fold on
    the map side. The rows carry their digest.
    """
    marked = with_digest(batch).where(F.col(DIGEST).isNotNull())
    landed = [r[0] for r in known.select("source_endpoint").distinct().collect() if r[0] is not None]
    before = F.coalesce(F.col("source_endpoint").isin(*landed), F.lit(False))
    first = marked.where(~before).withColumn("_mark", F.xxhash64(DIGEST))
    again = store(first.groupBy("_mark").agg(F.count("*").alias("n")).where("n > 1").select("_mark"))
    lone = first.join(again, "_mark", "left_anti")
    rest = marked.where(before).unionByName(first.join(again, "_mark", "left_semi").drop("_mark"))
    digests = rest.select("source_endpoint", DIGEST).distinct()
    fresh = store(digests.join(known, ["source_endpoint", DIGEST], "left_anti"))
    new = rest.join(fresh.select(DIGEST), DIGEST, "left_semi").dropDuplicates([DIGEST])
    columns = [*batch.columns, *([] if DIGEST in batch.columns else [DIGEST])]
    return lone.select(*columns).unionByName(new.select(*columns))
