"""The state of a stream of series holds many rows in one entry, and results leave in bounded frames."""

import pandas as pd
from pyspark.sql import types as T

from demandloom.streaming.series import SeriesFeatures


class State:
    def __init__(self, schema=None):
        self.values = []

    def get(self):
        return iter(list(self.values))

    def exists(self):
        return bool(self.values)

    def appendList(self, values):
        self.values += values

    def put(self, values):
        self.values = list(values)

    def clear(self):
        self.values = []


class Handle:
    def __init__(self):
        self.timers = []

    def getListState(self, name, schema):
        return State()

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, t):
        self.timers.remove(t)

    def registerTimer(self, t):
        self.timers.append(t)


class Watermark:
    def getCurrentWatermarkInMs(self):
        return 21_000


def test_rows_wait_and_leave_in_chunks():
    columns = T.StructType().add("x", "double").add("at", "long")
    p = SeriesFeatures(["k", "x", "at"], columns, ["k"], "at", [], "x", {"lag": 1}, {"top": (2, "max")})
    handle = Handle()
    p.init(handle)
    n = 25_000
    rows = pd.DataFrame({"k": "a", "x": [float(i) for i in range(n)], "at": [i * 1000 for i in range(n)]})
    assert not list(p.handleInputRows(("a",), iter([rows.iloc[::-1]]), None))
    assert len(p.waiting.values) == 3 and handle.timers == [0]
    frames = list(p.handleExpiredTimer(("a",), Watermark(), None))
    assert [len(f) for f in frames] == [10_000, 10_000, 1_001]
    out = pd.concat(frames)
    assert out["x"].tolist() == [float(i) for i in range(21_001)]
    assert out["lag"].tolist()[1:] == out["x"].tolist()[:-1] and out["top"].tolist() == out["x"].tolist()
    assert len(p.waiting.values) == 1 and 21_001 in handle.timers
    assert [r[0] for r in p.recent.values] == [21_000.0]
