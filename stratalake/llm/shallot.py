"""Exact k-means over integer vectors with shallot search.

A vector becomes the integers ``floor(scale * x)``. Lloyd's rounds are run as written, with integer centroids, exact
integer distances and the smaller number on a tie; what is saved are distances that can't matter. With every vector
stay its centroid, the second nearest one, an upper bound of the distance to the first and a lower bound of the
distance to all others. Moved centroids loosen the bounds. A vector whose upper bound stays below the lower one, or
below half the way to the nearest other centroid, keeps its centroid without a distance. For the rest the distance to
its own centroid is worked out, then that to the remembered second; the search starts from the closer of both, takes
that one's neighbours in the order of their distance from it, and ends as soon as a neighbour is farther away than
the distance to the start plus the second smallest distance found so far, a ball that shrinks with every find.
Bounds are doubles, widened by a margin; the distances that decide are integers.

A round is one pass over a stored table of vectors with their bounds, and one over its sums: a task hands on at most
one row of sums per centroid. Only centroids reach the driver.

Rows whose vector is null, has another length or a null or non-finite entry are left out, and so are those with an
entry beyond ``LARGEST`` after scaling, whose distances a long might not hold. With fewer vectors than centroids
wanted there is one centroid per vector. Repeated rows each count, ids may repeat, a null id counts as empty text, and
equal hashes are ordered by vector. An empty table gives no row. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.workspace import store
from .common import in_small_batches

#: Sums of 64 squared differences of such entries fit a long.
LARGEST = 1 << 27
STATE = "vec_id bigint, v array<bigint>, own int, second int, upper double, lower double"
_OUT = pa.schema([
    ("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("own", pa.int32()), ("second", pa.int32()),
    ("upper", pa.float64()), ("lower", pa.float64()),
])


class Move(NamedTuple):
    """Centroids with what a round has to know of them."""

    centroids: np.ndarray  # centroid x dimension, integers
    near: np.ndarray  # per centroid all others, nearest first
    gaps: np.ndarray  # their distances
    moved: np.ndarray  # how far each centroid has moved in the last round
    others_moved: np.ndarray  # how far any of the others has


def integers(rows: DataFrame, scale: int, dimensions: int, vector: str = "embedding") -> DataFrame:
    """``vec_id`` and the scaled vector ``v`` of the rows that are kept."""
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fit = F.coalesce(F.forall(vector, lambda x: F.abs(x.cast("double") * float(scale)) <= float(LARGEST)), F.lit(False))
    return rows.where((F.size(vector) == dimensions) & fit).select("vec_id", scaled.alias("v"))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> np.ndarray:
    """The vectors whose salted ids have the smallest hashes, in that order."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(name, 256), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in first], np.int64)


def _lengths(differences: np.ndarray) -> np.ndarray:
    return np.sqrt((differences.astype(np.float64) ** 2).sum(axis=-1))


def move(centroids: np.ndarray, before: np.ndarray | None = None) -> Move:
    k = len(centroids)
    between = np.stack([_lengths(centroids - c) for c in centroids])
    np.fill_diagonal(between, -1.0)
    near = np.argsort(between, axis=1, kind="stable")[:, 1:]
    gaps = np.take_along_axis(between, near, axis=1)
    moved = _lengths(centroids - before) if before is not None else np.zeros(k)
    others = np.array([np.delete(moved, j).max(initial=0.0) for j in range(k)])
    return Move(centroids, near, gaps, moved, others)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    difference = x - c
    return np.einsum("ij,ij->i", difference, difference)


def _below(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether ``a`` is below ``b`` by more than what rounding could account for."""
    return a < b - 1e-6 - 1e-9 * np.abs(b)


def search(
    x: np.ndarray, own: np.ndarray, second: np.ndarray, upper: np.ndarray, lower: np.ndarray, at: Move
) -> tuple[tuple[np.ndarray, ...], int]:
    """Centroid, second centroid and bounds of every vector after a move, and the number of distances needed."""
    own, second = own.copy(), second.copy()
    upper, lower = upper + at.moved[own], np.maximum(lower - at.others_moved[own], 0.0)
    if at.near.shape[1] == 0:  # a single centroid
        return (own, second, upper, lower), 0
    free = at.gaps[:, 0] / 2
    rows = np.flatnonzero(~_below(upper, np.maximum(lower, free[own])))
    needed = len(rows)
    d_own = _squares(x[rows], at.centroids[own[rows]])
    upper[rows] = np.sqrt(d_own)
    open_ = ~_below(upper[rows], np.maximum(lower[rows], free[own[rows]]))
    rows, d_own = rows[open_], d_own[open_]
    y, a, b = x[rows], own[rows], second[rows]
    d_second = _squares(y, at.centroids[b])
    needed += len(rows)
    # Start from the closer of the two; a tie goes to the smaller number.
    turn = (d_second < d_own) | ((d_second == d_own) & (b < a))
    best, best_d = np.where(turn, b, a), np.where(turn, d_second, d_own)
    next_, next_d = np.where(turn, a, b), np.where(turn, d_own, d_second)
    start, start_length, known = best.copy(), np.sqrt(best_d), next_.copy()
    left = np.arange(len(rows))
    for place in range(at.near.shape[1]):
        # The ball: nothing farther from the start can come before the second nearest found so far.
        reach = start_length[left] + np.sqrt(next_d[left])
        left = left[~_below(reach, at.gaps[start[left], place])]
        if not len(left):
            break
        found = at.near[start[left], place]
        new = found != known[left]
        who, found = left[new], found[new]
        d = _squares(y[who], at.centroids[found])
        needed += len(who)
        first = (d < best_d[who]) | ((d == best_d[who]) & (found < best[who]))
        between = ~first & ((d < next_d[who]) | ((d == next_d[who]) & (found < next_[who])))
        up, mid = who[first], who[between]
        next_[up], next_d[up] = best[up], best_d[up]
        best[up], best_d[up] = found[first], d[first]
        next_[mid], next_d[mid] = found[between], d[between]
    own[rows], second[rows] = best, next_
    upper[rows], lower[rows] = np.sqrt(best_d), np.sqrt(next_d)
    return (own, second, upper, lower), needed


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def assign(state: DataFrame, at: Move) -> DataFrame:
    """The state of all vectors after a move of the centroids."""
    dimensions = at.centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch["v"], dimensions)
                bounds = [batch[name].to_numpy() for name in ("own", "second", "upper", "lower")]
                found, _ = search(x, *bounds, at)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], batch["v"], *[pa.array(a, f.type) for a, f in zip(found, list(_OUT)[2:], strict=True)]],
                    schema=_OUT,
                )

    return in_small_batches(state).mapInArrow(run, STATE)


def means(state: DataFrame, before: np.ndarray) -> np.ndarray:
    """Floored means of the clusters; a centroid without vectors stays."""
    k, dimensions = before.shape
    schema = pa.schema([("own", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64)
        for batch in batches:
            if batch.num_rows:
                own, x = batch["own"].to_numpy(), _matrix(batch["v"], dimensions)
                order = np.argsort(own, kind="stable")
                there, starts = np.unique(own[order], return_index=True)
                sums[there] += np.add.reduceat(x[order], starts, axis=0)
                counts += np.bincount(own, minlength=k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), schema.field("sums").type)],
            schema=schema,
        )

    parts = in_small_batches(state.select("own", "v")).mapInArrow(run, "own int, n bigint, sums array<bigint>")
    places = parts.select("own", "n", F.posexplode("sums").alias("place", "sum"))
    # One row per centroid and dimension.
    totals = places.groupBy("own", "place").agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect()
    after = before.copy()
    for r in totals:
        after[r["own"], r["place"]] = r["sum"] // r["n"]
    return after


def cluster(
    rows: DataFrame, k: int, rounds: int, scale: int, dimensions: int, salt: str, vector: str = "embedding"
) -> tuple[DataFrame, np.ndarray]:
    """The last state of every kept vector, a stored table, and the centroids it was assigned to."""
    kept = store(integers(rows, scale, dimensions, vector))
    centroids = first_centroids(kept, k, salt)
    unknown = [F.lit(0).alias("own"), F.lit(min(1, max(len(centroids) - 1, 0))).alias("second")]
    bounds = [F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower")]
    state = kept.select("vec_id", "v", *unknown, *bounds)
    if not len(centroids):
        return state, centroids.reshape(0, dimensions)
    before = None
    for _ in range(rounds):
        state = store(assign(state, move(centroids, before)))
        before, centroids = centroids, means(state, centroids)
    return store(assign(state, move(centroids, before))), centroids


def distance_to(centroids: np.ndarray) -> Column:
    """Exact squared distance of ``v`` to the centroid named in ``own``."""
    table = F.array(*[F.array(*[F.lit(int(x)).cast("bigint") for x in c]) for c in centroids])
    gaps = F.zip_with("v", F.get(table, F.col("own")), lambda x, c: (x - c) * (x - c))
    return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, gap: total + gap)


def report(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``, the sums of distances over cluster and table, and the centroid's digest."""
    from hashlib import sha256

    if not len(centroids):
        centroids = np.zeros((1, 1), np.int64)
    found = store(state.select("vec_id", F.col("own").alias("cluster"), distance_to(centroids).alias("distance")))
    # One row per centroid, so the window holds few rows and the broadcast is bounded by their number.
    inertia = found.groupBy("cluster").agg(F.try_sum("distance").alias("cluster_inertia")).withColumn(
        "inertia", F.try_sum("cluster_inertia").over(Window.partitionBy())
    )
    digests = F.array(*[F.lit(sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centroids])
    return found.join(F.broadcast(inertia), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.get(digests, F.col("cluster")).alias("centroid_sha256")
    )
