"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Unit vectors are rotated to principal axes, so that the leading dimensions
hold most of a product.  They are cut into tiles of bounded size along their
leading coordinates.  Tiles are written once and read by the tasks that
compare them, so no vector is shuffled.  For two tiles, one product over the
leading coordinates and the norm of what is left bounds all cosines; only
pairs whose bound reaches the threshold are decided, in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.llm.common import components, only
from demandloom.sources.io import settle

THRESHOLD = 0.95

#: Vectors of a tile and its bytes at most, leading axes that a tile is cut along, rows the axes are fitted on, dimensions of the bound.
TILE, TILE_BYTES, AXES, SAMPLE, LEAD = 4096, 1 << 20, 3, 20_000, 16

#: Tiles' worth of vectors that a task cuts at a time; rows of a tile that are compared at once; pairs that are gathered at once; links that wait to be summed up.
BUFFER, STRIP, GATHERED, PENDING = 16, 64, 8192, 1_000_000

#: Of a cosine in double precision, and of a bound in single precision.
SLACK, ROUGH = 1e-9, 1e-5


def kind_of(vectors: DataFrame) -> type:
    return np.float32 if vectors.schema["embedding"].dataType.elementType == T.FloatType() else np.float64


def of_length(vectors: DataFrame, dims: int) -> DataFrame:
    """(vec_id, embedding) of the rows with ``dims`` components, in single precision if they are given so, else in double."""
    single = kind_of(vectors) == np.float32
    rows = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") == dims))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))


def usable(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, vectors) of finite, not all zero components; the rest are left out."""
    x = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    good = np.isfinite(x).all(1) & (x != 0).any(1)
    return batch.column("vec_id").to_numpy(zero_copy_only=False)[good], x[good]


def units(x: np.ndarray) -> np.ndarray:
    """Rows in double precision of length one; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(rows: DataFrame, n: int, dims: int, sample: int = SAMPLE) -> np.ndarray:
    """Orthogonal axes by falling variance, fitted on about ``sample`` of the ``n`` rows by hash; any axes give the same links."""
    some = rows.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)) < sample).limit(sample).toArrow()
    x = np.concatenate([np.zeros((0, dims)), *[units(usable(b, dims)[1]) for b in some.to_batches() if b.num_rows]])
    return np.ascontiguousarray(np.linalg.eigh(x.T @ x)[1][:, ::-1])


def bounds_of(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading rotated coordinates and the norm of the others: the product of two such rows is no less than the cosine."""
    lead = unit @ axes[:, :LEAD]
    return np.column_stack([lead, np.sqrt(np.maximum(0, 1 - (lead * lead).sum(1)))]).astype(np.float32)


def cut(lead: np.ndarray, tile: int) -> list[np.ndarray]:
    """Row numbers of tiles: halves along the widest axis, until they are small enough."""
    done, todo = [], [np.arange(len(lead))]
    while todo:
        at = todo.pop()
        if len(at) <= tile:
            done.append(at)
            continue
        part = lead[at]
        widest = np.argmax(part.max(0) - part.min(0))
        # as many whole tiles on either side as there can be
        half = -(-len(at) // tile) // 2 * tile
        order = np.argpartition(part[:, widest], half)
        todo += [at[order[half:]], at[order[:half]]]
    return done


def tiles(rows: DataFrame, dims: int, axes: np.ndarray, tile: int) -> DataFrame:
    """(name, ids, data, lo0, hi0, ...): vectors of like leading coordinates as one block of bytes, and the box that holds them."""
    kind = kind_of(rows)
    tile = max(1, min(tile, TILE_BYTES // (dims * kind().itemsize)))
    sides = min(AXES, dims)
    columns = [f"{side}{k}" for k in range(sides) for side in ("lo", "hi")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, made, ids, data = TaskContext.get().partitionId(), 0, [], []

        def blocks() -> Iterator[pa.RecordBatch]:
            nonlocal made
            i, x = np.concatenate(ids), np.concatenate(data)
            lead = units(x) @ axes[:, :sides]
            for rows in cut(lead, tile):
                box = lead[rows]
                sizes = [v for k in range(sides) for v in (box[:, k].min(), box[:, k].max())]
                made += 1
                yield pa.RecordBatch.from_pydict({
                    "name": pa.array([at << 32 | made], pa.int64()), "ids": pa.array([i[rows].astype(np.int64).tobytes()], pa.binary()),
                    "data": pa.array([x[rows].astype(kind).tobytes()], pa.binary()), **{c: pa.array([v], pa.float64()) for c, v in zip(columns, sizes)},
                })

        for b in batches:
            i, x = usable(b, dims)
            if len(i):
                ids.append(i)
                data.append(x)
            if sum(map(len, ids)) >= BUFFER * tile:
                yield from blocks()
                ids, data = [], []
        if ids:
            yield from blocks()

    return rows.mapInArrow(run, "name long, ids binary, data binary" + "".join(f", {c} double" for c in columns))


def similar(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Row indices of all pairs of vectors x and y whose cosine is at least the threshold; a and b are their bounds."""
    least, across = np.float32(threshold - ROUGH), b.T.copy()
    width, few, found = len(b), [], []
    for s in range(0, len(a), STRIP):
        at = np.flatnonzero(a[s : s + STRIP] @ across >= least)
        if len(at) <= STRIP * width // 8:
            few.append(at + s * width)
            continue
        # too many are left to gather pair by pair: the strip is one product
        u, v = units(x[s : s + STRIP]), units(y)
        whole = (u @ v.T).ravel()
        at = np.flatnonzero(whole >= threshold - SLACK)
        far = whole[at] < threshold + SLACK
        far[far] = np.einsum("ij,ij->i", u[at[far] // width], v[at[far] % width]) < threshold
        found.append(at[~far] + s * width)
    few = np.concatenate([np.zeros(0, np.int64), *few])
    for s in range(0, len(few), GATHERED):
        at = few[s : s + GATHERED]
        found.append(at[np.einsum("ij,ij->i", units(x[at // width]), units(y[at % width])) >= threshold])
    at = np.concatenate([np.zeros(0, np.int64), *found])
    return at // width, at % width


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the pairs: at most one edge for each node."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        low = low[low]
        if (low == root).all():
            break
        root = low
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


class Links:
    """How many links each vector has, and a spanning forest of all; what has come is summed up whenever much waits."""

    def __init__(self):
        self.ids, self.numbers, self.ends, self.waiting = [], [], [], 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        ids, n = np.unique(np.concatenate([a, b]), return_counts=True)
        self.ids.append(ids)
        self.numbers.append(n)
        self.ends.append(forest(a, b))
        self.waiting += len(ids)
        if self.waiting > PENDING:
            self.sum_up()

    def sum_up(self) -> None:
        ids, place = np.unique(np.concatenate(self.ids), return_inverse=True)
        n = np.bincount(place, np.concatenate(self.numbers)).astype(np.int64)
        a, b = (np.concatenate(x) for x in zip(*self.ends))
        self.ids, self.numbers, self.ends, self.waiting = [ids], [n], [forest(a, b)], 0

    def batches(self) -> Iterator[pa.RecordBatch]:
        if not self.ids:
            return
        self.sum_up()
        (a, b), zeros = self.ends[0], np.zeros(len(self.ends[0][0]), np.int64)
        for ids, n, to in ((self.ids[0], self.numbers[0], pa.nulls(len(self.ids[0]), pa.int64())), (a, zeros, pa.array(b, pa.int64()))):
            yield pa.RecordBatch.from_pydict({"vec_id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()), "to": to})


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors of equal length link when their cosine in double precision is at
    least the threshold; lengths are compared one after another.  Null, zero,
    incomplete or non-finite vectors, and rows with a null vec_id, link with
    nothing; a null vec_id has a null component.  Rows that share a vec_id are
    one vector each: they link with each other if near, and share a component.
    Ties can't occur.  Other columns are not read.  An empty table gives no
    rows.

    Tiles are written once, in the precision of the input, and each task reads
    two files' share of them.  It sends, for each vector, how many links it has
    there and at most one edge of a spanning forest, never the pairs.
    """
    rows = only(vectors, "vec_id", "embedding")
    sizes = rows.where("size(embedding) > 0").groupBy(F.size("embedding").alias("n")).count().where("count > 1").orderBy("n").collect()
    found = None
    for size in sizes:
        some = _links(of_length(rows, size["n"]), size["count"], size["n"], threshold, tile)
        found = some if found is None else found.unionByName(some)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n_links"))
    labels = components(found.where("to is not null").select(F.col("vec_id").alias("a"), F.col("to").alias("b")))
    labels = labels.withColumnRenamed("id", "vec_id")
    return (
        rows.select("vec_id").join(links, "vec_id", "left").join(labels, "vec_id", "left")
        .select(
            "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component", "vec_id").alias("component_id"),
            F.coalesce(F.coalesce("component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )


def _links(rows: DataFrame, n: int, dims: int, threshold: float, tile: int) -> DataFrame:
    """(vec_id, n, to) of vectors of one length: numbers of links found in each task, and edges of spanning forests."""
    axes = principal_axes(rows, n, dims)
    left = settle(tiles(rows, dims, axes, tile), "tiles")
    right = left.withColumnsRenamed({c: f"{c}_2" for c in left.columns})
    # vectors with cosine >= t are within sqrt(2 - 2t), so the boxes are as well
    gap = sum(F.pow(F.greatest(F.col(f"lo{k}") - F.col(f"hi{k}_2"), F.col(f"lo{k}_2") - F.col(f"hi{k}"), F.lit(0.0)), F.lit(2.0)) for k in range(min(AXES, dims)))
    # either order of two tiles by turns, so that all tasks have as many
    once = (F.col("name") == F.col("name_2")) | ((F.col("name") < F.col("name_2")) == (F.pmod(F.col("name") + F.col("name_2"), F.lit(2)) == 0)) & (F.col("name") != F.col("name_2"))
    pairs = left.join(right, once & (gap <= 2 - 2 * threshold + 1e-6)).select("name", "ids", "data", "name_2", "ids_2", "data_2")
    kind = kind_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links, bounds = Links(), {}

        def bound(name: int, x: np.ndarray) -> np.ndarray:
            if name not in bounds:
                if len(bounds) >= 4 * BUFFER:
                    bounds.clear()
                bounds[name] = bounds_of(units(x), axes)
            return bounds[name]

        for batch in batches:
            for k in range(batch.num_rows):
                name, ids, data, name_2, ids_2, data_2 = (c[k] for c in batch.columns)
                x, y = (np.frombuffer(v.as_buffer(), kind).reshape(-1, dims) for v in (data, data_2))
                i, j = similar(bound(name.as_py(), x), bound(name_2.as_py(), y), x, y, threshold)
                if name == name_2:
                    i, j = i[i < j], j[i < j]
                if len(i):
                    links.add(np.frombuffer(ids.as_buffer(), np.int64)[i], np.frombuffer(ids_2.as_buffer(), np.int64)[j])
        yield from links.batches()

    return settle(pairs.mapInArrow(run, "vec_id long, n long, to long"), "links")
