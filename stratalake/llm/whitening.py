"""Whitening of embeddings with MLlib's distributed block matrices.

Rows are numbered, centred by the exact column means and indexed into blocks of a ``BlockMatrix``. The transposed
matrix times the matrix is the scatter, a matrix of dimension by dimension whose partial products are formed in as
many tasks as there are shuffle partitions, not in one. Its eigenvectors are worked out locally; divided by the roots
of their eigenvalues they are the whitening matrix, and the centred matrix times that one projects all rows.

Entries are the integers ``floor(scale * c) + shift``, so sums and squared deviations are exact. Numbering takes no
shuffle: rows are stored with their place, and places become numbers by the sizes of the partitions before.

Rows whose vector is null, empty, or holds a null or non-finite entry are left out, as is an entry whose scaled value
is beyond ``LARGEST``. The dimension is the commonest length, the greater one on a tie; rows of another length are left
out. A component without variance (an eigenvalue of at most ``FLAT`` of the trace) is whitened to 0, and
``identity_error`` covers the others. Fewer dimensions than components give fewer components. A deviation beyond what a
long holds is null. Repeated rows each count and ids may repeat or be null. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import in_small_batches

LARGEST = 1 << 40
FLAT = 1e-12
#: Rows of a block: with 64 dimensions a block takes 2 MB.
BLOCK_ROWS = 4096

# monotonically_increasing_id() = partition number << 33 | position in the partition.
_POSITION_BITS = 33


class Fit(NamedTuple):
    n: int
    sums: list[int]  # per dimension
    components: np.ndarray  # dimension x component, unit eigenvectors
    values: np.ndarray  # eigenvalues, falling
    trace: float


def numbered(rows: DataFrame, scale: int, shift: int, vector: str = "embedding") -> DataFrame:
    """``place`` (0, 1, ...), ``vec_id`` and the integer vector ``x`` of the rows that are kept."""
    entry = lambda c: F.floor(F.lit(float(scale)) * c.cast("double")) + F.lit(shift).cast("bigint")
    fit = F.coalesce(F.forall(vector, lambda c: F.abs(c.cast("double") * float(scale)) <= float(LARGEST)), F.lit(False))
    kept = rows.where((F.size(vector) > 0) & fit).select("vec_id", F.transform(vector, entry).alias("x"))
    lengths = kept.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("length")).limit(1).first()
    kept = kept.where(F.size("x") == (common["length"] if common else 0))
    placed = store(kept.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", _POSITION_BITS)
    # One row per partition written.
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, total = {}, 0
    for r in sizes:
        before[r["part"]], total = total, total + r["n"]
    starts = placed.sparkSession.createDataFrame(list(before.items()), "_part bigint, _before bigint")
    position = F.col("_place").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return placed.withColumn("_part", part).join(F.broadcast(starts), "_part").select(
        (F.col("_before") + position).alias("place"), "vec_id", "x"
    )


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension; a task hands on one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["x"])
                part = x.sum(axis=0)
                n, sums = n + len(x), part if sums is None else sums + part
        if sums is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["n", "sums"]
            )

    parts = in_small_batches(rows.select("x")).mapInArrow(run, "n bigint, sums array<bigint>")
    places = parts.select("n", F.posexplode("sums").alias("place", "sum")).groupBy("place")
    found = places.agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum")).orderBy("place").collect()
    return (found[0]["n"], [int(r["sum"]) for r in found]) if found else (0, [])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def centred_blocks(rows: DataFrame, n: int, sums: list[int]) -> BlockMatrix:
    """The rows minus their mean as distributed blocks."""
    # What is left of the mean after its floor is taken off as well, so that no digits are lost to large entries.
    floors = F.array(*[F.lit(s // n).cast("bigint") for s in sums])
    rests = F.array(*[F.lit((s % n) / n) for s in sums])
    centred = F.zip_with(F.zip_with("x", floors, lambda x, m: (x - m).cast("double")), rests, lambda x, r: x - r)
    vectors = rows.select("place", array_to_vector(centred).alias("vector"))
    indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "vector"), n, len(sums))
    return indexed.toBlockMatrix(BLOCK_ROWS, len(sums))


def scatter(blocks: BlockMatrix, tasks: int) -> np.ndarray:
    """Transposed matrix times matrix; the middle dimension is split, or one task would take all blocks."""
    splits = max(1, min(tasks, -(-blocks.numRows() // BLOCK_ROWS)))
    transposed = blocks.transpose()
    product = transposed._java_matrix_wrapper.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, blocks.numCols(), blocks.numCols()).toLocalMatrix().toArray()


def fit(blocks: BlockMatrix, n: int, sums: list[int], components: int, tasks: int) -> Fit:
    covariance = scatter(blocks, tasks) / n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    return Fit(n, sums, vectors[:, order], values[order], float(np.trace(covariance)))


def whitening_matrix(model: Fit) -> np.ndarray:
    """Columns are components over the roots of their eigenvalues, zero where there is no variance."""
    wide = model.values > FLAT * model.trace
    return np.where(wide, model.components / np.sqrt(np.where(wide, model.values, 1.0)), 0.0)


def project(spark: SparkSession, blocks: BlockMatrix, matrix: np.ndarray) -> DataFrame:
    """``place`` and the projected row as the array ``y``."""
    rows, columns = matrix.shape
    local = DenseMatrix(rows, columns, matrix.ravel(order="F").tolist())
    right = BlockMatrix(spark.sparkContext.parallelize([((0, 0), local)], 1), rows, columns, rows, columns)
    projected = blocks.multiply(right).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", projected._java_matrix_wrapper._java_model)
    vectors = MLUtils.convertVectorColumnsToML(found, "vector")
    return vectors.select(F.col("index").alias("place"), vector_to_array("vector").alias("y"))


def deviations(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``place, vec_id`` and the exact sum of ``(n * x - S) ** 2`` over the dimensions, in whole numbers."""
    floors, rests = np.array([s // n for s in sums], np.int64), [s % n for s in sums]
    exact = sum(r * r for r in rests)
    high, low = np.array([r >> 20 for r in rests], np.int64), np.array([r & 0xFFFFF for r in rests], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch["x"]) - floors if batch.num_rows else np.zeros((0, len(sums)), np.int64)
            # n * x - S = n * y - rest. Large entries go by Python's integers.
            if y.size and np.abs(y).max() >= 1 << 20:
                y = y.astype(object)
            squares, mixed = (y * y).sum(axis=1).tolist(), zip((y * high).sum(axis=1).tolist(), (y * low).sum(axis=1).tolist(), strict=True)
            found = [n * n * s - 2 * n * ((a << 20) + b) + exact for s, (a, b) in zip(squares, mixed, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["place"], batch["vec_id"], pa.array([d if d < 1 << 63 else None for d in found], pa.int64())],
                names=["place", "vec_id", "deviation"],
            )

    return in_small_batches(rows.select("place", "vec_id", "x")).mapInArrow(run, "place bigint, vec_id bigint, deviation bigint")


def identity_error(projected: DataFrame, model: Fit) -> float:
    """Largest absolute entry of the projections' covariance minus the identity, in one pass."""
    wide = np.flatnonzero(model.values > FLAT * model.trace).tolist()
    pairs = [(i, j) for i in wide for j in wide if i <= j]
    if not pairs:
        return 0.0
    found = projected.select(*[F.col("y")[i].alias(f"y{i}") for i in wide]).agg(
        *[F.covar_pop(f"y{i}", f"y{j}").alias(f"{i}_{j}") for i, j in pairs]
    ).first()
    return max(abs(found[f"{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    rows: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000, vector: str = "embedding"
) -> DataFrame:
    """One row per kept row and component: ``vec_id, component, n, deviation, whitened, explained, identity_error``."""
    spark = rows.sparkSession
    kept = store(numbered(rows, scale, shift, vector))
    n, sums = column_sums(kept)
    if not n:
        return spark.createDataFrame(
            [], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double,"
            " identity_error double",
        )
    blocks = centred_blocks(kept, n, sums)
    model = fit(blocks, n, sums, components, int(spark.conf.get("spark.sql.shuffle.partitions")))
    projected = store(project(spark, blocks, whitening_matrix(model)))
    error = identity_error(projected, model)
    shares = (model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))).tolist()
    wide = deviations(kept, n, sums).join(projected, "place")
    return wide.select(
        "vec_id", "deviation", F.posexplode("y").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(F.array(*[F.lit(s) for s in shares]), F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
