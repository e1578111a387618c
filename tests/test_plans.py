"""Plans stay on the JVM, never cross join, and share exchanges."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

import __spark_entry__ as entry
from demandloom.operators import quantiles, windows
from demandloom.sources.retail import RetailTables

KEYS = ["store_id", "product_id"]
# Writes files or runs a stream while building; what remains is a plain scan.
EAGER = {"sink_stream_parquet", "stream_series_features", "stream_score_series", "stream_kafka_json", "stream_daily_sales", "stream_dedupe", "scan_csv_dates", "sink_parquet", "sink_csv"}
# Fits precede the joined state; running medians take one ordered pass over each partition; counts are searched in batches.
PYTHON = {
    "join_model_state", "backtest_cutoffs", "forecast_dates", "forecast_gbt_dates", "pooled_model_io", "score_requests_dates",
    "var_coefficients_one_lag", "var_forecast_one_lag", "granger_one_lag", "rolling", "rolling_full", "rolling_whole_table", "expanding", "optimal_inventory_poisson",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry.oracle_sql()) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in PYTHON:
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|MapInArrow", text)


def test_no_broadcast_hint_in_the_library():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1] / "demandloom"
    # the training-data operators broadcast tables of proven size, and have their own tests
    for path in [p for p in root.rglob("*.py") if "llm" not in p.parts]:
        text = path.read_text()
        for banned in ("F.broadcast(", "crossJoin(", "localCheckpoint", ".toPandas("):
            assert banned not in text, (path, banned)


def test_small_threshold_still_works_without_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("join_dims", "promotion_features", "cross_product_features", "winsorize_grouped", "economic_features"):
            df = entry.queries()[name](spark, SF)
            text = plan(df)
            assert "BroadcastHashJoin" not in text and "CartesianProduct" not in text
            assert df.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_window_bundle_shares_one_exchange(spark, tmp_path):
    t = RetailTables(spark, SF)
    t.sales.write.parquet(str(tmp_path / "sales"))
    sales = spark.read.parquet(str(tmp_path / "sales"))
    assert plan(windows.sales_velocity_features(sales)).count("Exchange") == 1
    bundle = windows.rolling(windows.lags(sales, "sales", keys=KEYS), "sales", keys=KEYS)
    text = plan(bundle)
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    t = RetailTables(spark, SF)
    t.sales.write.parquet(str(tmp_path / "sales"))
    from demandloom.operators.scaling import filter_date_range

    df = filter_date_range(spark.read.parquet(str(tmp_path / "sales")), "date", "1996-01-01", None, ["store_id"], "sales")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(date,1996-01-01)" in text and "revenue" not in text.split("ReadSchema")[1]


def test_quantiles_scan_their_input_once(spark):
    t = RetailTables(spark, SF)
    df = quantiles.exact_quantiles(t.table("lineitem"), "l_quantity", [0.5], ["l_returnflag"])
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_hot_series_shrinks_before_the_shuffle(spark):
    from demandloom.operators.aggregate import daily_series

    rows = spark.range(20000).select(F.lit(1).alias("k"), (F.col("id") % 5).alias("date"), F.lit(1.0).alias("x"))
    text = plan(daily_series(rows, "x", ["k"]))
    assert text.index("partial_sum") > text.index("Exchange")


def test_calendar_fill_needs_no_join(spark, tmp_path):
    from demandloom.operators.calendar import calendar_fill

    t = RetailTables(spark, SF)
    t.store_days.write.parquet(str(tmp_path / "days"))
    text = plan(calendar_fill(spark.read.parquet(str(tmp_path / "days")), ["store_id"]))
    assert text.count("Exchange") == 1 and "Join" not in text


def test_medians_share_the_exchange_of_the_windows(spark, tmp_path):
    t = RetailTables(spark, SF)
    t.gappy.write.parquet(str(tmp_path / "gappy"))
    text = plan(windows.rolling(spark.read.parquet(str(tmp_path / "gappy")), "sales", (7, 30), ("mean", "median"), KEYS))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1 and "MapInArrow" in text


@pytest.mark.parametrize("name, joined", [
    ("category_totals", {"part"}), ("region_totals", {"supplier", "nation", "region"}), ("store_totals", {"supplier", "nation", "region"}),
    ("top_products", {"part"}), ("top_stores", {"supplier", "nation", "region"}), ("distinct_series", {"supplier", "part"}),
])
def test_totals_read_only_what_they_need(spark, name, joined):
    text = plan(entry.queries()[name](spark, SF)).split("Initial Plan")[0]
    read = set(re.findall(rf"{SF}/(\w+)\.parquet", text))
    assert read == {"lineitem"} | joined and len(re.findall(r"FileScan parquet[^\n]*l_quantity|Location[^\n]*lineitem", text)) <= 1
