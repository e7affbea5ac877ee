"""Centroid clustering of vectors in exact integers, by incremental dot products.

A vector's components become integers, floor(scale * x).  Its dot product with
every centroid is stored beside it.  When the centroids move, only the
components that changed count: each dot product grows by the change times the
vector at those components, and the nearest centroid follows from
|x|^2 - 2 x.c + |c|^2 without a distance being computed anew.  Centroids
start from zero, so the first products come by the same step.

A round is one pass over the stored vectors, which writes them with their new
dot products and cluster, and one aggregation of the cluster sums, pre-summed
by task; the driver holds k centroids and nothing of the vectors.  The table
of the round before is removed once the next one is written.  Rounds after
which no centroid moves are skipped, as they change nothing.

Defined results: null vectors, vectors of another length or with a null or
non-finite component, and vectors with a component beyond ``LARGEST`` after
scaling (whose squared distance may not fit a long) are left out; ties between
centroids go to the smaller number; the first centroids are the vectors of the
smallest hashes of their ids (equal ids: smaller components first), null ids
last; fewer vectors than k give as many centroids; repeated rows are separate
vectors; an empty table gives an empty result; columns beyond the two named
ones are ignored, whatever their names; there are no texts, and a very long
vector is left out by its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import drop_path
from .common import batch_rows, new_folder, prepare

#: Largest magnitude of an integer component: 64 squared differences fit a long.
LARGEST = 1 << 27
#: Vectors in one Arrow batch.
VECTOR_ROWS = 8192

_STATE = "id long, x array<int>, norm long, dots array<long>, cluster int, distance long"


def integer_vectors(vectors: DataFrame, dimensions: int, scale: int, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, x array<int>): the vectors that take part, in integers."""
    values = F.col(embedding).cast("array<double>")
    scaled = F.transform(values, lambda v: F.floor(v * F.lit(float(scale)))).cast("array<int>")

    def usable(v):
        return F.coalesce(F.abs(v) < F.lit((LARGEST + 1) / scale), F.lit(False))  # false for NaN: it is the largest

    whole = F.coalesce(F.size(values) == dimensions, F.lit(False))
    return (vectors.select(F.col(vec_id).cast("long").alias("id"), F.when(whole, F.when(F.forall(values, usable), scaled)).alias("x"))
                   .where("x is not null"))


def first_centroids(points: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the k smallest hashes of "seed:id"."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [list(r["x"]) for r in points.orderBy(key.asc_nulls_last(), "x").limit(k).collect()]


def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(-1, width)


def _move_task(dimensions: int, before: np.ndarray, now: np.ndarray):
    """Bring dot products from the centroids ``before`` to ``now`` and assign again."""
    k = len(now)
    changed = [np.flatnonzero(now[c] != before[c]) for c in range(k)]
    norms = (now * now).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            x = _matrix(batch.column("x"), dimensions, np.int64)
            fresh = "dots" not in batch.schema.names
            norm = (x * x).sum(axis=1) if fresh else batch.column("norm").to_numpy()
            dots = np.zeros((n, k), np.int64) if fresh else _matrix(batch.column("dots"), k, np.int64).copy()
            for c in range(k):
                if len(changed[c]):
                    dots[:, c] += x[:, changed[c]] @ (now[c] - before[c])[changed[c]]
            distances = norm[:, None] - 2 * dots + norms
            cluster = distances.argmin(axis=1)  # the first of equal ones
            ends = np.arange(n + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(ends * dimensions, pa.array(x.ravel().astype(np.int32))), pa.array(norm),
                 pa.ListArray.from_arrays(ends * k, pa.array(dots.ravel())), pa.array(cluster.astype(np.int32)),
                 pa.array(distances[np.arange(n), cluster])],
                ["id", "x", "norm", "dots", "cluster", "distance"])
    return run


def _move(points: DataFrame, dimensions: int, before: np.ndarray, now: np.ndarray) -> tuple[DataFrame, str]:
    spark = points.sparkSession
    path = new_folder(spark, "vectors")
    with batch_rows(spark, VECTOR_ROWS):
        points.mapInArrow(_move_task(dimensions, before, now), _STATE).write.parquet(path)
    return spark.read.schema(_STATE).parquet(path), path


def _means(state: DataFrame, dimensions: int, centroids: np.ndarray) -> np.ndarray:
    """Componentwise floor of the mean of each cluster; empty ones stay."""
    sums = [F.sum(F.col("x")[d].cast("long")).alias(f"s{d}") for d in range(dimensions)]
    moved = centroids.copy()
    for row in state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # k rows
        moved[row["cluster"]] = [row[f"s{d}"] // row["n"] for d in range(dimensions)]
    return moved


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, dimensions: int = 64, scale: int = 1024, seed: str = "3",
            vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, list[list[int]]]:
    """((id, x, norm, dots, cluster, distance) of every vector that takes part, the final centroids)."""
    spark = prepare(vectors.sparkSession)
    points = integer_vectors(vectors, dimensions, scale, vec_id, embedding)
    start = first_centroids(points, k, seed)
    if not start:
        return spark.createDataFrame([], _STATE), []
    now = np.array(start, np.int64)
    state, path = _move(points, dimensions, np.zeros_like(now), now)
    for _ in range(rounds):
        before, now = now, _means(state, dimensions, now)
        if (before == now).all():
            break
        last = path
        state, path = _move(state, dimensions, before, now)
        drop_path(spark, last)
    return state, now.tolist()


def report(state: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """By vector: its cluster, squared distance, the sum of these over its cluster and
    over all (null beyond a long), and the hash of its centroid."""
    spark = state.sparkSession
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r["cluster"]: int(r["s"]) for r in state.groupBy("cluster").agg(total.alias("s")).collect()}  # k rows

    def fits(value):
        return value if value < 1 << 63 else None

    rows = [(c, fits(sums[c]), fits(sum(sums.values())), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
            for c, x in enumerate(centroids) if c in sums]
    sides = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(sides), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
