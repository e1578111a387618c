"""Clusters around centroids, with distances from scalar lookup tables.

Vectors are scaled to whole numbers and stored in blocks: for every dimension
the integer values that occur in the block, and for every vector the place of
its value among them.  In each round a task tabulates, for each dimension,
the squared difference of every occurring value and every centroid; distances
are then table gathers and sums, exact in integers.  The next centroids come
from how often each value occurs in each cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm.integer_vectors import BLOCK, as_long, matrix, whole_vectors
from demandloom.sources.io import settle


def blocks(rows: DataFrame, dims: int) -> DataFrame:
    """(ids, starts, seen, places): blocks of at most BLOCK vectors (vec_id, q).

    ``seen`` holds the values that occur, dimension after dimension, each from
    its place in ``starts``; ``places`` is a matrix (dimension, vector) of
    two-byte places among the values of the dimension.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, BLOCK):
                part = batch.slice(s, BLOCK)
                x = np.ascontiguousarray(matrix(part.column("q"), dims).T)
                found = [np.unique(row, return_inverse=True) for row in x]
                starts = np.cumsum([0, *[len(v) for v, _ in found]]).astype(np.int32)
                seen = np.concatenate([v for v, _ in found])
                places = np.stack([p for _, p in found]).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("vec_id")),
                        pa.array([starts], pa.list_(pa.int32())),
                        pa.array([seen], pa.list_(pa.int64())),
                        pa.array([places.tobytes()], pa.binary()),
                    ],
                    ["ids", "starts", "seen", "places"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"ids array<{kind}>, starts array<int>, seen array<bigint>, places binary")


class Block:
    """One stored block, opened."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.ids = batch.column("ids")[i].values
        self.starts = batch.column("starts")[i].values.to_numpy()
        self.seen = batch.column("seen")[i].values.to_numpy()
        self.places = np.frombuffer(batch.column("places")[i].as_py(), np.uint16).reshape(len(self.starts) - 1, len(self.ids))

    def values(self, d: int) -> np.ndarray:
        return self.seen[self.starts[d] : self.starts[d + 1]]

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each vector's nearest centroid, the smaller one at ties, and the squared distance."""
        total = np.zeros((len(self.ids), len(centroids)), np.int64)
        for d in range(len(self.places)):
            table = (self.values(d)[:, None] - centroids[None, :, d]) ** 2
            total += table[self.places[d]]
        best = total.argmin(1)
        return best, total[np.arange(len(best)), best]

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster, from counts of (cluster, value)."""
        out = np.empty((k, len(self.places)), np.int64)
        for d in range(len(self.places)):
            v = self.values(d)
            counts = np.bincount(cluster * len(v) + self.places[d], minlength=k * len(v)).reshape(k, len(v))
            out[:, d] = counts @ v
        return out


def moved(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: componentwise floor(sum / count); those without vectors stay.

    A task sends one row for each of its clusters; what reaches the driver is
    one number for each centroid and dimension.
    """
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                cluster, _ = block.nearest(centroids)
                counts += np.bincount(cluster, minlength=k)
                sums += block.sums(cluster, k)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used], pa.int64()), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            ["cluster", "n", "sums"],
        )

    parts = stored.mapInArrow(run, "cluster int, n long, sums array<bigint>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("d", "s")).groupBy("cluster", "d")
    totals = each.agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = centroids.copy()
    for r in totals:
        out[r["cluster"], r["d"]] = int(r["s"]) // int(r["n"])
    return out


def assigned(stored: DataFrame, centroids: np.ndarray, id_type: T.DataType) -> DataFrame:
    """(vec_id, cluster, distance) of every stored vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch, i)
                cluster, distance = block.nearest(centroids)
                yield pa.RecordBatch.from_arrays(
                    [block.ids, pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "cluster", "distance"]
                )

    return stored.mapInArrow(run, f"vec_id {id_type.simpleString()}, cluster int, distance long")


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes; rows of one id by vector, null ids last."""
    place = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256).asc_nulls_last()
    return np.array([r["q"] for r in rows.orderBy(place, "q").limit(k).select("q").collect()], np.int64)


def centroid_clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Kept are vectors of exactly ``dims`` finite components; null vectors, other
    lengths and null, NaN or infinite components are left out.  Scaled
    components beyond LARGEST count as LARGEST.  Rows that share a vec_id, and
    repeated rows, are one vector each; a null vec_id is kept and is chosen as
    a first centroid last.  With fewer than ``k`` vectors each is a centroid.
    Equal distances go to the smaller number.  A sum that does not fit a long
    is null.  Other columns are not read.  An empty table gives no rows.

    The driver holds ``k`` centroids and their statistics, nothing else.
    """
    rows = whole_vectors(vectors, scale, "vec_id").where(F.size("q") == dims)
    id_type = rows.schema["vec_id"].dataType
    centroids = first_centroids(rows, k)
    spark = vectors.sparkSession
    per_cluster = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return assigned(blocks(rows, dims), np.zeros((1, dims), np.int64), id_type).join(spark.createDataFrame([], per_cluster), "cluster").select(
            "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
        )
    stored = settle(blocks(rows, dims), "blocks")
    for _ in range(rounds):
        centroids = moved(stored, centroids)
    out = settle(assigned(stored, centroids, id_type), "clusters")
    inertia = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    everything = as_long(sum(inertia.values()))
    marks = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    stats = spark.createDataFrame([(c, as_long(s), everything, marks[c]) for c, s in inertia.items()], per_cluster)
    # at most k rows
    return out.join(F.broadcast(stats), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
