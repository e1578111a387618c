import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import to_pandas
from pyspark.sql import functions as F

from demandloom.operators import aggregate as A
from demandloom.operators import dims as D
from demandloom.operators import encode as E
from demandloom.operators import external as X


def day(s):
    return dt.date.fromisoformat(s)


def test_last_promotion_wins_and_flags_add_up(spark):
    facts = spark.createDataFrame([(day(f"1995-{m}"), 1, 5.0) for m in ("02-01", "03-03", "03-15", "03-16")] + [(day("1995-03-03"), 2, 1.0)],
                                  "date date, product_id int, sales double")
    promos = spark.createDataFrame(
        [(1, 1, "Discount", 0.1, day("1995-02-01"), day("1995-03-15")), (2, 1, "Flash Sale", 0.3, day("1995-03-01"), day("1995-03-05"))],
        "promo_seq int, product_id int, promotion_type string, discount_rate double, start_date date, end_date date")
    out = to_pandas(X.promotion_features(facts, promos), "product_id", "date")
    assert out["is_promotion"].tolist() == [1, 1, 1, 0, 0]
    assert out["discount_rate"].tolist() == [0.1, 0.3, 0.1, 0.0, 0.0]
    assert out["days_into_promotion"].tolist() == [0, 2, 42, 0, 0]
    assert out["days_to_promotion_end"].tolist() == [42, 2, 0, 0, 0]
    assert out["is_flash_sale"].tolist() == [0, 1, 0, 0, 0] and out["is_discount"].tolist() == [1, 1, 1, 0, 0]
    assert out["promo_count"].tolist() == [1, 2, 1, 0, 2]


def test_holidays_before_on_and_after(spark):
    facts = spark.createDataFrame([(day(d),) for d in ("2020-06-30", "2020-07-04", "2020-07-06", "2020-12-26")], "date date")
    hol = spark.createDataFrame([(day("2020-07-04"), "Independence Day"), (day("2020-12-25"), "Christmas Day (observed)")],
                                "date date, holiday_name string")
    out = to_pandas(X.holiday_features(facts, hol), "date")
    assert out["days_to_holiday"].tolist() == [4, 0, 172, 99]
    assert out["days_after_holiday"].tolist() == [99, 0, 2, 1]
    assert out["is_independence_day"].tolist() == [0, 1, 0, 0]
    named = to_pandas(X.holiday_name_features(facts, hol), "date")
    assert named["days_before_holiday"].tolist() == [4, 0, 172, 0]
    assert named["days_after_holiday"].tolist() == [0, 0, 2, 1]


def test_us_rules(spark):
    dates = spark.createDataFrame([(day("2021-01-01"),), (day("2021-12-31"),)], "date date")
    got = {r["holiday_name"]: r["date"].isoformat() for r in X.holiday_calendar(dates).collect()}
    assert got["Thanksgiving"] == "2021-11-25" and got["Memorial Day"] == "2021-05-31"
    assert got["Labor Day"] == "2021-09-06" and got["Martin Luther King Jr. Day"] == "2021-01-18" and len(got) == 10
    given = spark.createDataFrame([(day("2021-03-01"), "X"), (day("2022-03-01"), "Y")], "date date, holiday_name string")
    assert X.holiday_calendar(dates, holidays=given, country="CA").count() == 1


def test_asof_reaches_before_the_range_and_exact_joins_equal_dates(spark):
    facts = spark.createDataFrame([(day("2020-02-10"),), (day("2020-03-01"),), (day("2020-06-01"),)], "date date")
    eco = spark.createDataFrame([(day("2020-01-01"), 1.0), (day("2020-03-01"), 3.0)], "date date, idx double")
    assert to_pandas(X.join_economic_asof(facts, eco), "date")["idx"].tolist() == [1.0, 3.0, 3.0]
    short = facts.where("date < '2020-03-02'")
    assert to_pandas(X.join_economic_asof(short, eco), "date")["idx"].tolist()[1] == 3.0
    assert to_pandas(X.join_economic_asof(short, eco), "date")["idx"].tolist() == [1.0, 3.0]
    assert to_pandas(X.join_economic_asof(short, eco, mode="exact"), "date")["idx"].isna().tolist() == [True, False]
    assert X.is_sparse(facts, eco) and not X.is_sparse(short, eco)


def test_event_flags_with_and_without_type(spark):
    facts = spark.createDataFrame([(day("2020-01-01"),), (day("2020-01-02"),)], "date date")
    ev = spark.createDataFrame([(day("2020-01-01"), "Big Game"), (day("2020-01-01"), "Fair"), (day("2020-01-02"), "Fair")],
                               "event_date date, event_type string")
    out = to_pandas(X.event_flags(facts, ev), "date")
    assert out["is_big_game"].tolist() == [1, 0] and out["is_fair"].tolist() == [1, 1]
    assert X.event_flags(facts, ev.drop("event_type").limit(1)).agg(F.sum("is_event")).first()[0] == 1


def test_join_external_suffixes(spark):
    a = spark.createDataFrame([(day("2020-01-01"), 1)], "date date, v int")
    b = a.withColumn("v", F.lit(2))
    assert X.join_external(a, b).columns == ["date", "v", "v_ext"]
    assert X.join_external(a, {"w": b}).columns == ["date", "v", "v_w"]
    assert X.join_external(a, (b, b)).columns == ["date", "v", "v_ext_0", "v_ext_1"]
    with pytest.raises(TypeError):
        X.join_external(a, 3)


def test_shares_with_null_category(spark):
    df = spark.createDataFrame([(1, 1, "a", 2.0), (1, 1, "a", 6.0), (1, 1, None, 2.0)], "date int, store_id int, category string, sales double")
    out = to_pandas(D.cross_product_features(df), "category", "sales")
    assert out["category_sales_share"].tolist()[:2] == [0.25, 0.75]
    assert out["store_sales"].tolist() == [10.0, 10.0, 10.0]
    assert out["store_sales_share"].sum() == pytest.approx(1.0)


def test_bins_at_cut_points(spark):
    df = spark.createDataFrame([(float(v),) for v in (-1, 0, 0.5, 10, 11, 100)], "x double")
    got = [r[1] for r in E.bin_values(df, "x", (-1, 0, 10, 50), ("a", "b", "c"), "b").collect()]
    assert got == [None, "a", "b", "b", "c", None]


def test_one_hot_nulls_and_unknown_values(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert sorted(tuple(r) for r in E.one_hot(df, ["c", "absent"]).collect()) == [(0, 0), (0, 1), (1, 0)]
    assert E.one_hot(df, "c", keep_original=True).columns == ["c", "c_x", "c_y"]


def test_ds_y_errors(spark):
    df = spark.createDataFrame([(day("2020-01-01"), 1.0, 7.0)], "date date, sales double, air_temperature double")
    assert E.rename_ds_y(df, regressors=["temperature", "is_holiday"]).first()["temperature"] == 7.0
    with pytest.raises(ValueError):
        E.rename_ds_y(df, regressors=["promo"])
    with pytest.raises(ValueError):
        E.select_var_columns(df, ["absent"])


def test_aggregate_first_and_null_keys(spark):
    df = spark.createDataFrame([(1, "k", 2.0, None), (1, "k", 3.0, "b"), (1, "k", None, "a"), (1, None, 9.0, "z")], "date int, k string, x double, s string")
    assert [tuple(r) for r in A.aggregate(df, ["k"]).collect()] == [(1, "k", 5.0, "a")]
    by_x = A.aggregate(df, ["k"], {"s": "first", "x": "max"}, order="x").first()
    assert by_x["s"] == "a" and by_x["x"] == 3.0


def test_hierarchy_levels_add_up(spark):
    data = [(1, "n", "s1", 2.0), (1, "n", "s2", 3.0), (1, "w", "s3", 5.0), (2, "w", None, 7.0)]
    out = A.hierarchy(spark.createDataFrame(data, "date int, region string, store string, sales double"), ["region", "store"])
    sums = {r["level"]: r["s"] for r in out.groupBy("level").agg(F.sum("sales").alias("s")).collect()}
    assert sums == {"all": 17.0, "region": 17.0, "region_store": 10.0, "region_store_full": 17.0}


@pytest.mark.parametrize("order", [["a", "b", "c"], ["a", "b"], ["c"]])
def test_row_positions_are_the_global_order(spark, order):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.choice([1, 1, 1, 2, 3], 200), "b": rng.integers(0, 9, 200), "c": rng.permutation(200)})
    pdf = pdf.drop_duplicates(order)
    got = to_pandas(A.row_positions(spark.createDataFrame(pdf).repartition(5), order), *order)
    assert got["_pos"].tolist() == list(range(len(pdf))) and set(got["_total"]) == {len(pdf)}


def test_split_sizes_and_order(spark):
    df = spark.createDataFrame([(day("2020-01-01") + dt.timedelta(days=i), i % 3) for i in range(101)], "date date, s int")
    out = A.time_split(df, ["date", "s"])
    got = to_pandas(out.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("a"), F.max("date").alias("b")), "a")
    assert got["split"].tolist() == ["train", "val", "test"] and got["n"].tolist() == [70, 15, 16]
    assert (got["b"][:2].to_numpy() < got["a"][1:].to_numpy()).all()


def test_folds_match_expanding_blocks(spark):
    n, k = 23, 5
    df = spark.createDataFrame([(i,) for i in range(n)], "date int")
    got = to_pandas(A.ts_cv_folds(df, "date", n_splits=k), "fold", "date")
    size = n // (k + 1)
    for f in range(k):
        part = got[got.fold == f]
        start = n - (k - f) * size
        assert part[part.role == "train"]["date"].tolist() == list(range(start))
        assert part[part.role == "test"]["date"].tolist() == list(range(start, start + size))


def test_latest_and_tail(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 30), ("a", 2, 20), ("b", 1, 5)], "k string, date int, v int")
    assert sorted(tuple(r) for r in A.latest_row(df, ["k"]).collect()) == [("a", 3, 30), ("b", 1, 5)]
    assert sorted(r.v for r in A.tail_horizon(df, 2, ["k"]).collect()) == [5, 20, 30]


def test_inventory_zero_denominators(spark):
    facts = spark.createDataFrame([(1, 1, day("2020-01-01"), 0.0)], "store_id int, product_id int, date date, sales double")
    inv = spark.createDataFrame([(1, 1, 5, 0, 0)], "store_id int, product_id int, current_stock int, safety_stock int, reorder_point int")
    row = D.inventory_features(facts, inv).first()
    assert row["days_of_supply"] is None and row["stock_to_safety_ratio"] is None and row["below_reorder_point"] == 0


def test_lags_stay_inside_a_store(spark):
    facts = spark.createDataFrame([(s, day("2020-01-01") + dt.timedelta(days=i)) for s in (1, 2) for i in range(9)], "store_id int, date date")
    weather = facts.select("date").distinct().select("date", F.dayofmonth("date").cast("double").alias("temperature"),
                                                     F.lit(1.0).alias("precipitation"), F.lit(True).alias("is_sunny"))
    out = to_pandas(X.weather_features(facts, weather), "store_id", "date")
    assert out["temperature_lag1"].isna().sum() == 2
    assert out["temperature_lag_7d_avg"].dropna().tolist() == [4.0, 5.0] * 2
    assert out["is_sunny_lag_7d_avg"].dropna().tolist() == [1.0] * 4


def test_row_positions_keep_null_prefixes_and_one_column_orders(spark):
    rows = [(None, 1), (None, 2), (1, 3), (2, 4)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = A.row_positions(df, ["a", "b"]).orderBy("_pos").collect()
    assert [(r.a, r.b, r._pos, r._total) for r in got] == [(*x, i, 4) for i, x in enumerate(rows)]
    one = A.row_positions(df.select("a").union(df.select("b")), ["a"]).orderBy("_pos").collect()
    assert [r.a for r in one] == [None, None, 1, 1, 2, 2, 3, 4] and [r._pos for r in one] == list(range(8))
