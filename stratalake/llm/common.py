"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())

#: Rows handled at a time inside a Python task, and bytes handed over to it at a time.
ROWS_AT_ONCE, BATCH_BYTES = 1024, 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` is several times as fast as ``translate`` and does the same where each character is one byte.
    """
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated a single time however often they are used.

    Spark folds a plain projection into every expression above it, also below a lambda; not so a generator.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


def in_small_batches(df: DataFrame) -> DataFrame:
    """The same rows, of which the session hands at most ``BATCH_BYTES`` to a Python task at a time.

    A batch is held by the executor and by the task, and neither gives the memory back soon. A setting of the
    session's own stays.
    """
    conf = df.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is None:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def map_rows(
    df: DataFrame, make: Callable[[], Callable[..., Iterator[tuple]]], schema: str, binary: tuple[str, ...] = ()
) -> DataFrame:
    """Rows made from rows inside the tasks; ``make`` is called once per task.

    ``make()`` returns a function of one list per column of ``df`` (a slice of the rows) that yields output
    rows. Columns named in ``binary`` are handed over as UTF-8 bytes. Memory is bounded by a slice.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                lists = []
                for name, column in zip(names, part.columns, strict=True):
                    if name in binary:
                        column = column.cast(pa.large_binary() if column.type == pa.large_string() else pa.binary())
                    lists.append(column.to_pylist())
                rows = list(step(*lists))
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=f.type) for c, f in zip(columns, out, strict=True)], schema=out
                    )

    return in_small_batches(df).mapInArrow(run, schema)


def keep_rows(df: DataFrame, make: Callable[[], Callable[..., list[bool]]], columns: tuple[str, ...]) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which ``make()(lists of the named columns)`` is true."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = make()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                yield part.filter(pa.array(keep(*[part.column(c).to_pylist() for c in columns]), pa.bool_()))

    return in_small_batches(df).mapInArrow(run, df.schema)
