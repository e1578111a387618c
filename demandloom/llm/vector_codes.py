"""Vectors as codes of few bytes: one codebook entry for each part.

A part's nearest entry is searched in memoised grid cells.  The part's coarse
cell is hashed; for a cell met first, the least and greatest distance of each
entry to the cell's box are computed, and the entries are remembered whose
least distance does not exceed the smallest greatest one.  The others are
farther than some entry from every point of the box.  Only remembered entries
are evaluated exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.integer_vectors import BLOCK, matrix, whole_vectors
from demandloom.sources.io import settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

#: Cells that cut a codebook's range in each dimension, and cells that a task remembers for each part.
CUTS, MEMORY = 8, 1 << 15

#: A label with more than one row in so many is joined through a broadcast table, which thus has at most as many rows.
HOT = 1000


class Cells:
    """The entries of one codebook that can be nearest, by grid cell.

    When more than ``memory`` cells are known all are forgotten; cells are
    then computed anew, with the same result.
    """

    def __init__(self, book: np.ndarray, memory: int = MEMORY):
        self.book, self.memory = book, memory
        self.width = max(1, int(book.max() - book.min()) // CUTS)
        odd = np.random.default_rng(book.shape[1]).integers(1, 1 << 62, book.shape[1], np.uint64)
        self.mix = odd * np.uint64(2) + np.uint64(1)
        self.forget()

    def forget(self) -> None:
        self.slots: dict[int, int] = {}
        self.cells = np.empty((0, self.book.shape[1]), np.int64)
        self.open = np.empty((0, len(self.book)), bool)

    def hashed(self, cells: np.ndarray) -> np.ndarray:
        h = (cells.view(np.uint64) * self.mix).sum(1, dtype=np.uint64)
        return h ^ (h >> np.uint64(29))

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """Which entries are not dominated across each cell's box."""
        low = (cells * self.width)[:, None, :]
        high = low + (self.width - 1)
        book = self.book[None]
        least = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(2)
        most = (np.maximum(np.abs(low - book), np.abs(high - book)) ** 2).sum(2)
        return least <= most.min(1)[:, None]

    def allowed(self, x: np.ndarray) -> np.ndarray:
        """(vector, entry) pairs to evaluate; a cell whose hash belongs to another one allows all entries."""
        cells = np.ascontiguousarray(np.floor_divide(x, self.width))
        keys, first, back = np.unique(self.hashed(cells), return_index=True, return_inverse=True)
        if len(self.slots) + len(keys) > self.memory:
            self.forget()
        new = [i for i, h in enumerate(keys.tolist()) if h not in self.slots]
        if new:
            at = cells[first[new]]
            self.slots.update(zip(keys[new].tolist(), range(len(self.cells), len(self.cells) + len(new))))
            self.cells = np.concatenate([self.cells, at])
            self.open = np.concatenate([self.open, self.candidates(at)])
        slot = np.array([self.slots[h] for h in keys.tolist()])[back]
        out = self.open[slot]
        out[(self.cells[slot] != cells).any(1)] = True
        return out

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each vector's nearest entry, the lower one at ties, and the squared distance."""
        row, entry = np.nonzero(self.allowed(x))
        distance = ((x[row] - self.book[entry]) ** 2).sum(1)
        best = np.minimum.reduceat(distance, np.searchsorted(row, np.arange(len(x))))
        hit = np.flatnonzero(distance == best[row])[::-1]
        index = np.empty(len(x), np.int64)
        index[row[hit]] = entry[hit]  # pairs are in ascending order, so the lowest entry is written last
        return index, best


def cut(batch: pa.RecordBatch, parts: int, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as (part, vector, component)."""
    for s in range(0, batch.num_rows, BLOCK):
        some = batch.slice(s, BLOCK)
        yield some, np.ascontiguousarray(matrix(some.column("q"), dims).reshape(-1, parts, dims // parts).transpose(1, 0, 2))


def trained(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round: componentwise floor(sum / count) of each entry's parts; unused entries stay.

    A task sends one row for each entry it used; what reaches the driver are
    the codebooks' own numbers.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Cells(b) for b in books]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for _, x in cut(batch, parts, parts * width):
                for p in range(parts):
                    index, _ = grids[p].nearest(x[p])
                    counts[p] += np.bincount(index, minlength=entries)
                    np.add.at(sums[p], index, x[p])
        p, e = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(counts[p, e], pa.int64()), pa.array(list(sums[p, e]), pa.list_(pa.int64()))],
            ["p", "e", "n", "sums"],
        )

    found = rows.mapInArrow(run, "p int, e int, n long, sums array<bigint>")
    each = found.select("p", "e", "n", F.posexplode("sums").alias("d", "s")).groupBy("p", "e", "d")
    out = books.copy()
    for r in each.agg(F.sum(F.col("n").cast("decimal(38,0)")).alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r["p"], r["e"], r["d"]] = int(r["s"]) // int(r["n"])
    return out


def coded(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of vectors (vec_id, label, q): two hex digits for each part."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = [Cells(b) for b in books]
        for batch in batches:
            for some, x in cut(batch, parts, parts * width):
                found = [grids[p].nearest(x[p]) for p in range(parts)]
                digits = np.stack([i for i, _ in found], 1).astype(np.uint8).tobytes().hex()
                codes = [digits[s : s + 2 * parts] for s in range(0, len(digits), 2 * parts)]
                error = np.sum([e for _, e in found], 0)
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.array(codes, pa.string()), pa.array(error, pa.int64())],
                    ["vec_id", "label", "code", "error"],
                )

    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.select("vec_id", "label", "q").mapInArrow(run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")


def with_group_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal keys, nulls together; null if it does not fit a long.

    Keys with more than one row in HOT are joined by a broadcast of at most
    HOT rows, so that no task gets all rows of a frequent key.
    """
    total = F.expr(f"try_cast(sum(cast(`{value}` as decimal(38,0))) as bigint)")
    groups = settle(rows.groupBy(F.col(key).alias("_k")).agg(total.alias(name), F.count("*").alias("_n")), "totals")
    all_rows = groups.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = F.broadcast(groups.where(F.col("_n") * HOT > all_rows).select("_k", name))
    rest = groups.where(F.col("_n") * HOT <= all_rows).select("_k", name)
    same = F.col(key).eqNullSafe(F.col("_k"))
    keep = [*[F.col(c) for c in rows.columns], F.col(name)]
    return rows.join(hot, same).select(*keep).unionByName(rows.join(hot, same, "left_anti").join(rest, same).select(*keep))


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every vector without null or non-finite components.

    Vectors are scaled to whole numbers (beyond LARGEST: LARGEST) and cut into
    ``parts`` equal parts.  Codebooks start as the parts of the ``entries``
    smallest vec_ids (rows of one id by vector, null ids last; fewer vectors
    give fewer entries).  Equal distances go to the lower index.  Vectors of
    another length than the most frequent one that can be cut (the shorter at
    ties) keep a row with a null code and error.  Repeated rows are coded one
    by one.  A null label is a label.  Other columns are not read.  An empty
    table gives no rows.  ``entries`` is at most 256.

    The driver holds the codebooks, nothing else.
    """
    every = settle(whole_vectors(vectors, scale, "vec_id", "label"), "whole")
    lengths = every.where((F.size("q") > 0) & (F.size("q") % parts == 0)).groupBy(F.size("q").alias("n")).count()
    length = lengths.orderBy(F.desc("count"), "n").first()
    if length is None:
        return every.select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("code", "string"), ("error", "long"), ("label_error", "long"), ("codebooks_sha256", "string"))])
    dims = length["n"]
    rows = every.where(F.size("q") == dims)
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "q").limit(entries).select("q").collect()
    books = np.array([r["q"] for r in first], np.int64).reshape(-1, parts, dims // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        books = trained(rows, books)
    mark = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    others = every.where(F.size("q") != dims).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    out = settle(coded(rows, books).unionByName(others), "codes")
    return with_group_total(out, "label", "error", "label_error").select("vec_id", "code", "error", "label_error", F.lit(mark).alias("codebooks_sha256"))
