"""Medians over the last rows, or over all rows so far, of a series.

A structure keeps the known values of the frame in order and takes one value
in and one out for each row, so a row costs the same whatever came before.
Partitions are sorted by series and order and read as a stream: a task holds
one frame, never a series.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator, Mapping, Sequence
from heapq import heappush, heappushpop
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.exprs import as_list


class Frame(NamedTuple):
    """The last ``rows`` rows of ``column`` (None: all so far); NULL until ``least`` values are known."""

    column: str
    rows: int | None = None
    least: int = 1


class Sliding:
    """Median of the last ``rows`` values: a sorted list that each row enters and, ``rows`` later, leaves."""

    def __init__(self, rows: int, least: int):
        self.rows, self.least = rows, least
        self.recent: deque = deque()
        self.known: list[float] = []

    def push(self, v: float | None) -> float | None:
        if len(self.recent) == self.rows:
            old = self.recent.popleft()
            if old is not None:
                del self.known[bisect_left(self.known, old)]
        self.recent.append(v)
        if v is not None:
            insort(self.known, v)
        n = len(self.known)
        if n < self.least:
            return None
        low, high = self.known[(n - 1) // 2], self.known[n // 2]
        return low + (high - low) / 2


class Growing:
    """Median of all values so far: the smaller half in one heap, the larger in another."""

    def __init__(self, least: int):
        self.least = least
        self.low: list[float] = []  # negated
        self.high: list[float] = []

    def push(self, v: float | None) -> float | None:
        if v is not None:
            if len(self.low) > len(self.high):
                heappush(self.high, -heappushpop(self.low, -v))
            else:
                heappush(self.low, -heappushpop(self.high, v))
        n = len(self.low) + len(self.high)
        if n < self.least:
            return None
        low = -self.low[0]
        return low if n % 2 else low + (self.high[0] - low) / 2


def with_medians(df: DataFrame, frames: Mapping[str, Frame], keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """``df`` with one column of medians for each frame; NULL and NaN are not known, ``least`` is at least 1."""
    keys, order = as_list(keys), as_list(order)
    names = df.columns
    inputs = {f.column: f"_m_{i}" for i, f in enumerate(frames.values())}
    given = df.withColumns({c: F.when(~F.isnan(F.col(source).cast("double")), F.col(source).cast("double")) for source, c in inputs.items()})
    # one exchange on the keys serves what else is computed per series
    rows = given.repartition(*keys).sortWithinPartitions(*keys, *order)
    schema = T.StructType([*df.schema, *[T.StructField(n, T.DoubleType()) for n in frames]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, state = None, []
        for batch in batches:
            whose = list(zip(*[batch.column(k).to_pylist() for k in keys]))
            values = [batch.column(inputs[f.column]).to_pylist() for f in frames.values()]
            out: list[list] = [[] for _ in frames]
            for i, key in enumerate(whose):
                if key != series:
                    series = key
                    state = [Growing(max(1, f.least)) if f.rows is None else Sliding(f.rows, max(1, f.least)) for f in frames.values()]
                for s, v, o in zip(state, values, out):
                    o.append(s.push(v[i]))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *[pa.array(o, pa.float64()) for o in out]], [*names, *frames])

    return rows.mapInArrow(run, schema)
