"""Features of a stream in several micro-batches equal those of one batch."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from demandloom.streaming import scoring as S
from demandloom.streaming.series import ROCKS, STATE_STORE, keyed_state, series_features

SCHEMA = "k string, event_id long, t timestamp, x double, seen timestamp_ntz, tags array<string>"
START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def put(spark, folder, rows, name):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{name}")
    time.sleep(0.05)  # files are taken in the order of their times


def features(df):
    return series_features(df, ["k"], "t", "x", ["event_id"], (1, 3), (2, 4), ("mean", "std", "min", "max", "sum"), "30 minutes")


def plain(rows):
    return sorted(([None if v is None else round(v, 9) if isinstance(v, float) else v for v in r] for r in rows), key=lambda r: r[1])


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def rows_of(rng, first, n, late):
    """Rows around minute ``first``, up to ``late`` minutes behind, with equal times, nulls and one very busy series."""
    out = []
    for i in range(n):
        t = START + dt.timedelta(minutes=first + i // 3 - rng.choice([0, 0, 5, late]), microseconds=rng.choice([0, 0, 1, 999_999]))
        x = None if rng.random() < 0.2 else float(rng.randrange(100))
        out.append((rng.choice("aaaab"), first * 1000 + i, t, x, t.replace(tzinfo=None), [str(i), None] if i % 2 else None))
    return out


def test_several_batches_with_late_rows_equal_one_batch(spark, tmp_path):
    rng, source = random.Random(1), str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    parts = [rows_of(rng, first, 60, 25) for first in (30, 50, 70, 90, 110)] + [[("z", 10**7, START + dt.timedelta(minutes=500), 1.0, None, None)]]
    for i, part in enumerate(parts[:3]):
        put(spark, source, part, i)
    S.run_to_parquet(features(stream(spark, source)), out, state)
    first = spark.read.parquet(out).count()
    # the query stops and starts again from its state
    for i, part in enumerate(parts[3:]):
        put(spark, source, part, 3 + i)
    S.run_to_parquet(features(stream(spark, source)), out, state)
    got = spark.read.parquet(out)
    want = features(spark.read.schema(SCHEMA).option("recursiveFileLookup", True).parquet(source)).where("k <> 'z'")
    assert 0 < first < got.count() == 300 and got.dtypes == want.dtypes
    assert plain(got.collect()) == plain(want.collect())


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    source = str(tmp_path / "in")
    at = lambda m: START + dt.timedelta(minutes=m)
    put(spark, source, [("a", 1, at(0), 1.0, None, None), ("a", 2, at(100), 2.0, None, None)], 0)
    put(spark, source, [("a", 3, at(200), 3.0, None, None), (None, 8, at(200), 3.0, None, None), ("a", 9, None, 3.0, None, None)], 1)
    put(spark, source, [("a", 4, at(10), 9.0, None, None), ("a", 5, at(150), 5.0, None, None), ("b", 6, at(400), 0.0, None, None)], 2)
    S.run_to_parquet(features(stream(spark, source)), str(tmp_path / "out"), str(tmp_path / "state"))
    got = {r.event_id: (r.x_lag_1, r.x_rolling_2_mean) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    # row 4 comes when the watermark has passed it; row 5 comes late, but in time
    assert got == {1: (None, 1.0), 2: (1.0, 1.5), 5: (2.0, 3.5), 3: (5.0, 4.0)}


def test_scores_see_rows_of_earlier_batches(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(4):
        put(spark, source, [("a", i, START + dt.timedelta(hours=i), float(i), None, None)], i)
    rows = series_features(stream(spark, source), ["k"], "t", "x", ["event_id"], (1, 2), (), (), "1 second")
    score = lambda b: b.withColumn("yhat", 2 * F.col("x_lag_1") - F.col("x_lag_2"))
    S.stream_score(rows, score, out, str(tmp_path / "state"), trigger=None).awaitTermination()
    got = spark.read.parquet(out).orderBy("event_id").collect()
    assert [r.yhat for r in got] == [None, None, 2.0] and len({r.batch_id for r in got}) > 1


def test_the_sessions_state_store_is_put_back(spark):
    before = spark.conf.get(STATE_STORE)
    with pytest.raises(RuntimeError), keyed_state(spark):
        assert spark.conf.get(STATE_STORE) == ROCKS
        raise RuntimeError
    assert spark.conf.get(STATE_STORE) == before
