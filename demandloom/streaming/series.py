"""Lag and rolling features of a stream, right across micro-batches.

The rows of a series wait in keyed state until the watermark has passed them;
then they leave in time order with features over the rows before them, of
which the state keeps the last few.  Whatever the cut into micro-batches and
the order of arrival within the lateness, the result is that of the batch
operators over all rows.
"""

from __future__ import annotations

import math
import pickle
from collections import deque
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from demandloom.operators import windows as WN

LATENESS = "1 hour"

# The setting and the class of the state store that keyed state with timers needs.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
#: Rows of a state entry or of a frame of results at most.
CHUNK = 10_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state where keyed state with timers can; the session's setting is put back."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def _std(x: Sequence[float]) -> float | None:
    if len(x) < 2:
        return None
    mean = math.fsum(x) / len(x)
    return math.sqrt(math.fsum((v - mean) ** 2 for v in x) / (len(x) - 1))


_OVER = {"mean": lambda x: math.fsum(x) / len(x), "sum": math.fsum, "min": min, "max": max, "std": _std}


def _plain(v):
    """A value of a pandas row as state takes it."""
    if isinstance(v, np.ndarray):
        return [_plain(x) for x in v]
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return None
    return v.item() if hasattr(v, "item") else v


class SeriesFeatures(StatefulProcessor):
    """Buffers the rows of a series until the watermark passes them, and keeps its last values.

    ``columns`` are a row's columns without the keys; ``at`` (microseconds)
    orders them, ``ties`` order equal times.  One timer per series stands at
    its earliest waiting row; timers expire after all input of a micro-batch.
    """

    def __init__(self, given: Sequence[str], columns: T.StructType, keys, at: str, ties, value: str, lags: Mapping[str, int], rolls: Mapping[str, tuple[int, str]]):
        self.lags, self.rolls = dict(lags), dict(rolls)
        names = columns.fieldNames()
        # rows come with their columns in order, but not with all of their names
        self.result = [*keys, *names, *lags, *rolls]
        self.own = [list(given).index(n) for n in names]
        self.at, self.value = names.index(at), names.index(value)
        self.order = [self.at, *[names.index(c) for c in ties]]
        self.reach = max([0, *self.lags.values(), *[w - 1 for w, _ in self.rolls.values()]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # an entry holds many rows: one entry for each would cost far more than its features
        self.waiting = handle.getListState("waiting", T.StructType([T.StructField("rows", T.BinaryType())]))
        self.recent = handle.getListState("recent", T.StructType([T.StructField("value", T.DoubleType())]))

    def _millis(self, row) -> int:
        return -(-row[self.at] // 1000)

    def _packed(self, rows: list[tuple]) -> list[tuple[bytes]]:
        return [(pickle.dumps(rows[i : i + CHUNK]),) for i in range(0, len(rows), CHUNK)]

    def _place(self, row):
        return [(row[i] is not None, row[i]) for i in self.order]

    def _wake_at(self, millis: int) -> None:
        timers = list(self.handle.listTimers())
        if not timers or millis < min(timers):
            for t in timers:
                self.handle.deleteTimer(t)
            self.handle.registerTimer(millis)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for batch in rows:
            own = batch.iloc[:, self.own].astype(object).itertuples(index=False, name=None)
            new = [tuple(_plain(v) for v in r) for r in own]
            if new:
                self.waiting.appendList(self._packed(new))
                self._wake_at(min(self._millis(r) for r in new))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        rows = sorted((r for e in self.waiting.get() for r in pickle.loads(e[0])), key=self._place)
        watermark = timerValues.getCurrentWatermarkInMs()
        ready = [r for r in rows if self._millis(r) <= watermark]
        left = rows[len(ready) :]
        if left:
            self.waiting.put(self._packed(left))
            # the timer that expires now is the only one, and goes when this returns
            self.handle.registerTimer(self._millis(left[0]))
        else:
            self.waiting.clear()
        if ready:
            past = deque([r[0] for r in self.recent.get()] if self.recent.exists() else [], maxlen=self.reach)
            for i in range(0, len(ready), CHUNK):
                out = [[*key, *r, *self._features(past, r[self.value])] for r in ready[i : i + CHUNK]]
                yield pd.DataFrame(out, columns=self.result, dtype=object)
            if past:
                self.recent.put([(x,) for x in past])

    def _features(self, past: deque, v: float | None) -> list[float | None]:
        """Features of a row with value ``v`` after ``past``, which takes it in."""
        made = [past[-k] if k <= len(past) else None for k in self.lags.values()]
        if self.rolls:
            values = [*past, v]
            for w, f in self.rolls.values():
                known = [x for x in values[-w:] if x is not None]
                made.append(_OVER[f](known) if known else None)
        past.append(v)
        return made

    def close(self) -> None:
        pass


def series_features(
    rows: DataFrame,
    keys: Sequence[str],
    time: str = "timestamp",
    value: str = "sales",
    ties: Sequence[str] = (),
    lags: Sequence[int] = WN.LAGS,
    windows: Sequence[int] = WN.WINDOWS,
    functions: Sequence[str] = ("mean",),
    lateness: str = LATENESS,
) -> DataFrame:
    """``rows`` with ``{value}_lag_{k}`` and ``{value}_rolling_{w}_{f}`` of their series; the same for batch and stream.

    A stream emits a row when the watermark, the latest time seen less
    ``lateness``, has passed it; rows behind the watermark are dropped by Spark
    as in every stateful query.  Rows of one series and time are ordered by
    ``ties``.  The state of a series is what waits, and as many values as the
    longest lag or window.  Rows without a time or a key are left out.  Start the stream
    inside ``keyed_state``, as ``stream_score`` and ``run_to_parquet`` do.
    """
    if not set(functions) <= set(_OVER):
        raise ValueError(f"functions are {sorted(_OVER)}")
    keys, ties = list(keys), list(ties)
    typed = rows.withColumns({time: F.col(time).cast("timestamp"), value: F.col(value).cast("double")}).na.drop(subset=[time, *keys])
    if not rows.isStreaming:
        return WN.rolling(WN.lags(typed, value, lags, keys, [time, *ties]), value, windows, functions, keys, [time, *ties])
    rolls = {f"{value}_rolling_{w}_{f}": (w, f) for w in windows for f in functions}
    steps = {f"{value}_lag_{k}": k for k in lags}
    made = [*steps, *rolls]
    # points in time travel as numbers, so that no worker's time zone matters
    instants = [f.name for f in typed.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and f.name not in keys]
    micros = {c: F.unix_micros(F.col(c).cast("timestamp")) for c in instants}
    marked = typed.withWatermark(time, lateness).select("*", *[x.alias(f"_us_{c}") for c, x in micros.items()])
    state = T.StructType([f for f in marked.schema if f.name not in keys and f.name not in instants])
    schema = T.StructType([*[marked.schema[k] for k in keys], *state, *[T.StructField(n, T.DoubleType()) for n in made]])
    processor = SeriesFeatures(marked.columns, state, keys, f"_us_{time}", [f"_us_{c}" if c in instants else c for c in ties], value, steps, rolls)
    out = marked.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "EventTime")
    back = {c: F.timestamp_micros(f"_us_{c}").cast(typed.schema[c].dataType).alias(c) for c in instants}
    return out.select(*[back.get(c, F.col(c)) for c in rows.columns], *made)
