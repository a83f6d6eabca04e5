"""Centroid clustering of vectors in whole numbers, with Orchard search for the nearest centroid.

1. A vector counts if it has exactly ``dims`` components, none null, NaN or infinite. Each component x
   becomes the integer floor(scale * x), so that sums, means and distances are exact and don't depend on
   how rows are dealt to tasks. Other rows are left out of the result.
2. The first centroids are the ``k`` vectors with the least SHA-256 of ``seed:id`` in hexadecimal
   (fewer if there are fewer vectors; ties by components; a null id comes last).
3. A round assigns every vector to its nearest centroid (squared Euclidean distance, of equal ones
   the smaller number) and moves every centroid that has vectors to floor(sum / count) of each component. After
   ``rounds`` of them vectors are assigned once more.

The nearest centroid is found by Orchard's search: every centroid has a list of all centroids by distance
from it. A vector reads the list of the best centroid so far; whenever a closer one turns up, it goes on at the head of
that one's list, skipping those already visited, and stops at the first entry that lies strictly beyond
twice the distance to the best. By the triangle inequality no entry behind can be closer, nor as close.
All vectors of a block take their next step together.

Vectors never move between tasks: a task sends one row of sums per centroid and round, and ``k * dims`` numbers reach
the driver, whatever the input. The lists (``k * k`` numbers, ``k`` at most 4,096) go to every task.
A component beyond what 64-bit distances hold raises. Repeated rows count as often as they stand there.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ledgerloom.llm.common import fresh_name, lists, map_arrow, ship, shuffles_removed, stage

MOST_CENTROIDS = 4096
BLOCK_ROWS = 4096
NEW = ("cluster", "distance", "cluster_inertia", "inertia", "centroid")


@dataclass(frozen=True)
class Settings:
    k: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    seed: str = "1"

    def __post_init__(self) -> None:
        if not 1 <= self.k <= MOST_CENTROIDS:
            raise ValueError(f"k must lie in 1 to {MOST_CENTROIDS}")


def whole_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vectors count, and these vectors in whole numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(sizes == dims)
    values = pc.list_flatten(column.take(pa.array(rows))).cast(pa.float64())
    values = values.fill_null(np.nan).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(values).all(axis=1)
    rows, values = rows[finite], np.floor(values[finite] * scale)
    # four times the largest squared distance must fit in 64 bits
    most = isqrt((1 << 63) // (16 * dims)) - 1
    if len(values) and np.abs(values).max() > most:
        raise ValueError(f"a component times {scale} lies beyond {most}: distances would not fit in 64 bits")
    return rows, values.astype(np.int64)


class Orchard:
    """Centroids with a list of their neighbours, nearest first, for each of them."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        gaps = np.stack([np.square(centroids - c).sum(axis=1) for c in centroids])
        self.neighbours = np.argsort(gaps, axis=1, kind="stable")
        self.gaps = np.take_along_axis(gaps, self.neighbours, axis=1)
        self.compared = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each vector."""
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, np.int64)
        distance = np.square(vectors - self.centroids[0]).sum(axis=1)
        place = np.zeros(n, np.int64)
        visited = np.zeros((n, k), bool)
        visited[:, 0] = True
        active = np.arange(n)
        while len(active):
            of = best[active], place[active]
            near = self.gaps[of] <= 4 * distance[active]
            active, entry = active[near], self.neighbours[of][near]
            place[active] += 1
            new = ~visited[active, entry]
            rows, found = active[new], entry[new]
            visited[rows, found] = True
            own = np.square(vectors[rows] - self.centroids[found]).sum(axis=1)
            self.compared += len(rows)
            closer = (own < distance[rows]) | ((own == distance[rows]) & (found < best[rows]))
            rows = rows[closer]
            best[rows], distance[rows], place[rows] = found[closer], own[closer], 0
            active = active[place[active] < k]
        return best, distance


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(n: int):
    return (slice(at, min(n, at + BLOCK_ROWS)) for at in range(0, n, BLOCK_ROWS))


def _first_centroids(vectors: DataFrame, key: str, vector: str, settings: Settings) -> np.ndarray:
    ranked = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col(key).cast("string")), 256)
    rows = (
        vectors.select(ranked.alias("rank"), F.col(vector).alias("vector"))
        .orderBy(F.col("rank").asc_nulls_last(), "vector")
        .limit(settings.k)
        .collect()
    )
    return np.array([r["vector"] for r in rows], np.int64).reshape(-1, settings.dims)


def _moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round. One row of sums for each task and centroid is shuffled."""
    k, dims = centroids.shape

    def sums(batches):
        orchard = Orchard(centroids)
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            own = _matrix(batch.column(0), dims)
            for block in _blocks(len(own)):
                nearest, _ = orchard.nearest(own[block])
                np.add.at(total, nearest, own[block])
                count += np.bincount(nearest, minlength=k)
        held = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held, pa.int32()),
                pa.array(count[held]),
                lists(pa.array(total[held].reshape(-1)), np.full(len(held), dims)),
            ],
            ["cluster", "n", "sums"],
        )

    ship(vectors.sparkSession)
    rows = vectors.mapInArrow(sums, "cluster int, n long, sums array<long>")
    wide = "decimal(38,0)"
    added = (
        rows.select("cluster", "n", F.posexplode("sums").alias("dim", "sum"))
        .groupBy("cluster", "dim")
        .agg(F.sum(F.col("sum").cast(wide)).alias("sum"), F.sum(F.col("n").cast(wide)).alias("n"))
    )
    moved = centroids.copy()
    with shuffles_removed(vectors.sparkSession):
        for r in added.collect():  # k * dims rows at most
            moved[r["cluster"], r["dim"]] = int(r["sum"]) // int(r["n"])
    return moved


def cluster_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings = Settings()
) -> DataFrame:
    """The rows of ``df`` whose vectors count, with ``cluster``, ``distance`` (squared), ``cluster_inertia`` and
    ``inertia`` (its sum over the cluster and over all) and ``centroid`` (array of its final components).

    Columns of these names are replaced. Without any vector that counts the result is empty.
    """
    k, dims, scale = settings.k, settings.dims, settings.scale
    spark = df.sparkSession
    whole, key = fresh_name(df, "whole_vector"), fresh_name(df, "vector_key")
    fields = [f for f in df.schema.fields if f.name.lower() not in NEW]
    carried = [f.name for f in fields]
    source = df.select(*carried, df[vector_col].alias(whole), df[id_col].alias(key))

    def counted(batch: pa.RecordBatch):
        rows, values = whole_vectors(batch.column(len(carried)), dims, scale)
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(take) for c in range(len(carried))],
                lists(pa.array(values.reshape(-1)), np.full(len(rows), dims)),
                batch.column(len(carried) + 1).take(take),
            ],
            batch.schema.names,
        )

    schema = StructType(
        [*fields, StructField(whole, ArrayType(LongType())), StructField(key, df.schema[id_col].dataType)]
    )
    vectors = stage(map_arrow(source, counted, schema), "whole-vectors")
    centroids = _first_centroids(vectors, key, whole, settings)
    if len(centroids):
        for _ in range(settings.rounds):
            centroids = _moved(vectors.select(whole), centroids)

    def assigned(batch: pa.RecordBatch):
        orchard = Orchard(centroids)
        own = _matrix(batch.column(len(carried)), dims)
        found = [orchard.nearest(own[block]) for block in _blocks(len(own))]
        clusters, distances = (np.concatenate([np.zeros(0, np.int64), *[f[i] for f in found]]) for i in (0, 1))
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in range(len(carried))], pa.array(clusters.astype(np.int32)), pa.array(distances)],
            [*carried, "cluster", "distance"],
        )

    placed = StructType([*fields, StructField("cluster", IntegerType()), StructField("distance", LongType())])
    rows = stage(map_arrow(vectors.select(*carried, whole), assigned, placed), "clusters")
    by_cluster = rows.groupBy("cluster").agg(F.sum("distance").alias("own")).collect()  # k rows at most
    inertia = sum(r["own"] for r in by_cluster)
    facts = spark.createDataFrame(
        [(r["cluster"], r["own"], inertia, centroids[r["cluster"]].tolist()) for r in by_cluster],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return rows.join(F.broadcast(facts), "cluster").select(*carried, *NEW)
