import datetime as dt

from conftest import SF, to_pandas
from pyspark.sql import functions as F

from demandloom.plans.q_models import EVENTS
from demandloom.sources import io
from demandloom.sources.retail import RetailTables
from demandloom.streaming import scoring as S


def test_decode_keeps_bad_records(spark):
    good = '{"store_id":"1","product_id":"2","timestamp":"2024-01-01T00:00:00Z","sales":3.5}'
    df = spark.createDataFrame([(bytearray(good.encode()),), (bytearray(b"{broken"),), (None,)], "value binary")
    rows = io.decode_json(df).collect()
    ok = [r for r in rows if r["store_id"] == "1"]
    assert ok[0]["sales"] == 3.5 and ok[0]["timestamp"] == dt.datetime(2024, 1, 1) and ok[0]["_corrupt"] is None
    assert sum(r["_corrupt"] == "{broken" for r in rows) == 1


def test_restart_adds_nothing(spark, tmp_path):
    stream = S.stream_parquet(spark, SF, EVENTS, "events.parquet").select("event_id")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):
        S.stream_score(stream, lambda b: b, out, state, trigger=None).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").count()
    assert got.select("batch_id").distinct().count() == 1 and "processing_time" in got.columns


def test_replayed_batch_overwrites_its_folder(spark, tmp_path):
    stream = S.stream_parquet(spark, SF, EVENTS, "events.parquet").select("event_id")
    out = str(tmp_path / "out")
    # A lost checkpoint replays batch 0 into the same folder.
    for state in ("one", "two"):
        S.stream_score(stream, lambda b: b, out, str(tmp_path / state), trigger=None).awaitTermination()
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{SF}/events.parquet").count()


def test_daily_stream_equals_its_static_twin(spark, tmp_path):
    columns = ("event_type AS store_id", "ts AS timestamp", "value AS sales")
    stream = S.daily_sales(S.stream_parquet(spark, SF, EVENTS, "events.parquet").selectExpr(*columns))
    S.run_to_parquet(stream, str(tmp_path / "out"), str(tmp_path / "state"))
    got = to_pandas(spark.read.parquet(str(tmp_path / "out")).withColumn("sales", F.round("sales", 6)), "store_id", "date")
    static = S.daily_sales(spark.read.parquet(f"{SF}/events.parquet").selectExpr(*columns)).withColumn("sales", F.round("sales", 6))
    last = static.agg(F.max("date")).first()[0]
    want = to_pandas(static.where(F.col("date") < F.lit(last)), "store_id", "date")
    assert got.equals(want)


def test_scratch_path_is_in_the_shared_folder(spark):
    assert io.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_parquet_sink_partitions(spark, tmp_path):
    t = RetailTables(spark, SF)
    io.write_parquet(t.store_days, str(tmp_path / "p"), partition_by=["store_id"])
    pruned = spark.read.parquet(str(tmp_path / "p")).where("store_id = 3")
    assert "PartitionFilters: [isnotnull(store_id" in pruned._jdf.queryExecution().toString()
