"""Queries: aggregations, reports, top-k, splits and set operations."""

from pyspark.sql import functions as F

from demandloom.operators import aggregate as A
from demandloom.operators import external as X
from demandloom.plans.registry import query, r6
from demandloom.sources.retail import MODELS

KEYS = ["store_id", "product_id"]


@query("aggregate", """
    SELECT date, store_id, sum(sales) AS sales, min(category) AS category FROM v_sales JOIN v_products USING (product_id)
      JOIN v_stores USING (store_id) WHERE is_active GROUP BY 1, 2""")
def _(t):
    # Sales of closed stores have no store key here, and a row without a key is in no group.
    store = F.when(F.col("is_active"), F.col("store_id"))
    df = t.sales.join(t.products.select("product_id", "category"), "product_id").join(t.stores, "store_id")
    return A.aggregate(df.select("date", store.alias("store_id"), "sales", "category"), ["store_id"])


@query("hierarchy", """
    WITH f AS (SELECT date, region, store_id, sales FROM v_sales JOIN v_stores USING (store_id))
    SELECT 'all' AS level, date, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS INTEGER) AS store_id, sum(sales) AS sales FROM f GROUP BY date
    UNION ALL SELECT 'region', date, region, NULL, sum(sales) FROM f GROUP BY date, region
    UNION ALL SELECT 'region_store_id', date, region, store_id, sum(sales) FROM f GROUP BY date, region, store_id
    UNION ALL SELECT 'region_store_id_full', date, region, store_id, sales FROM f""")
def _(t):
    return A.hierarchy(t.sales.join(t.stores.select("store_id", "region"), "store_id"), ["region", "store_id"])


@query("series_counts", "SELECT store_id, product_id, count(*) AS count FROM v_sales GROUP BY 1, 2")
def _(t):
    return A.series_counts(t.sales)


@query("distinct_series", "SELECT DISTINCT store_id, product_id FROM v_lines")
def _(t):
    return A.distinct_series(t.lines("store_id", "product_id"))


@query("daily_totals", "SELECT date, sum(sales) AS sales, round(sum(revenue), 4) AS revenue FROM v_sales GROUP BY 1")
def _(t):
    return A.daily_totals(t.sales, ["sales", "revenue"]).withColumn("revenue", F.round("revenue", 4))


@query("weekday_profile", """
    SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday_no, dayname(date) AS weekday, avg(sales) AS mean_sales
    FROM (SELECT date, sum(sales) AS sales FROM v_store_days GROUP BY 1) GROUP BY 1, 2""")
def _(t):
    return A.weekday_profile(t.store_days)


@query("month_profile", """
    SELECT CAST(month(date) AS INTEGER) AS month_no, monthname(date) AS month, avg(sales) AS mean_sales
    FROM (SELECT date, sum(sales) AS sales FROM v_store_days GROUP BY 1) GROUP BY 1, 2""")
def _(t):
    return A.month_profile(t.store_days)


@query("category_totals", "SELECT category, sum(l_quantity) AS l_quantity FROM v_lines JOIN v_products USING (product_id) GROUP BY 1")
def _(t):
    return A.dimension_totals(t.lines("product_id"), t.products, "product_id", "category", "l_quantity")


@query("region_totals", "SELECT region, sum(l_quantity) AS l_quantity FROM v_lines JOIN v_stores USING (store_id) GROUP BY 1")
def _(t):
    return A.dimension_totals(t.lines("store_id"), t.stores, "store_id", "region", "l_quantity")


@query("store_totals", "SELECT store_name, sum(l_quantity) AS l_quantity FROM v_lines JOIN v_stores USING (store_id) GROUP BY 1")
def _(t):
    return A.dimension_totals(t.lines("store_id"), t.stores, "store_id", "store_name", "l_quantity")


@query("competitor_daily", "SELECT date, avg(price_index) AS price_index FROM v_competitors GROUP BY 1")
def _(t):
    return X.competitor_daily(t.competitors)


@query("trend_line", """
    WITH d AS (SELECT date, sum(sales) AS sales FROM v_store_days GROUP BY 1),
      k AS (SELECT sales, row_number() OVER (ORDER BY date) - 1 AS x FROM d)
    SELECT 'day' AS x, round(regr_slope(sales, x), 6) AS slope, round(regr_intercept(sales, x), 6) AS intercept FROM k
    UNION ALL SELECT 'temperature', round(regr_slope(sales, temperature), 6), round(regr_intercept(sales, temperature), 6)
      FROM d JOIN v_weather USING (date)""")
def _(t):
    days = A.daily_totals(t.store_days)
    by_day = A.trend_line(days).withColumn("x", F.lit("day"))
    by_heat = A.trend_line(days.join(t.weather, "date"), x="temperature").withColumn("x", F.lit("temperature"))
    return r6(A.concat_rows(by_day, by_heat))


_FEATURES = ("price", "temperature", "precipitation", "store_id", "product_id")
_CORR = "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(corr({c}, sales)), 6) AS correlation FROM v_sales JOIN v_weather USING (date)"
    for c in _FEATURES) + ")"


@query("corr_with_target", _CORR)
def _(t):
    return r6(A.corr_with_target(t.sales.drop("revenue").join(t.weather, "date"), "sales"))


@query("top_features", _CORR + " ORDER BY correlation DESC, feature LIMIT 3")
def _(t):
    return r6(A.top_features(A.corr_with_target(t.sales.drop("revenue").join(t.weather, "date"), "sales"), 3))


@query("avg_metrics_by_model", """
    WITH m AS (SELECT store_id, model, sqrt(avg((yhat - y) ** 2)) AS rmse, avg(abs(yhat - y)) AS mae,
        avg(CASE WHEN y <> 0 THEN abs((y - yhat) / y) END) * 100 AS mape FROM v_long WHERE yhat IS NOT NULL GROUP BY 1, 2)
    SELECT model, round(avg(rmse), 6) AS rmse, round(avg(mae), 6) AS mae, round(avg(mape), 6) AS mape FROM m GROUP BY 1""")
def _(t):
    from demandloom.operators.metrics import avg_metrics_by_model, metrics_all

    return r6(avg_metrics_by_model(metrics_all(t.forecasts, MODELS, ["store_id"], metrics=("rmse", "mae", "mape"))))


@query("pivot_models", "SELECT store_id, ds, naive7, naive28, mean7 FROM v_forecasts")
def _(t):
    long = A.union_forecasts({m: t.forecasts.select("store_id", "ds", F.col(m).alias("yhat")) for m in MODELS})
    return A.pivot_models(long, MODELS, ["store_id"])


@query("top_products", """
    SELECT product_id, sum(l_quantity) AS l_quantity, any_value(product_name) AS product_name, any_value(category) AS category
    FROM v_lines JOIN v_products USING (product_id) GROUP BY 1 ORDER BY l_quantity DESC, product_id LIMIT 5""")
def _(t):
    return A.top_by_total(t.lines("product_id"), t.products, "product_id", 5, "l_quantity", ["product_name", "category"])


@query("top_stores", """
    SELECT store_id, sum(l_quantity) AS l_quantity, any_value(store_name) AS store_name, any_value(region) AS region
    FROM v_lines JOIN v_stores USING (store_id) GROUP BY 1 ORDER BY l_quantity DESC, store_id LIMIT 3""")
def _(t):
    return A.top_by_total(t.lines("store_id"), t.stores, "store_id", 3, "l_quantity", ["store_name", "region"])


@query("latest_row", """
    SELECT date, store_id, product_id, sales FROM (SELECT *, row_number() OVER
      (PARTITION BY store_id, product_id ORDER BY date DESC) AS r FROM v_sales) WHERE r = 1""")
def _(t):
    return A.latest_row(t.sales.drop("revenue", "price"), KEYS)


@query("tail_horizon", """
    SELECT store_id, date, sales FROM (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date DESC) AS r
      FROM v_store_days) WHERE r <= 30""")
def _(t):
    return A.tail_horizon(t.store_days, 30, ["store_id"])


def _split(over: str, partition: str, source: str, columns: str) -> str:
    return f"""
    WITH p AS (SELECT *, row_number() OVER ({over}) - 1 AS pos, count(*) OVER ({partition}) AS n FROM {source})
    SELECT {columns}, CASE WHEN pos < floor(n * 0.7) THEN 'train' WHEN pos < floor(n * 0.7) + floor(n * 0.15) THEN 'val'
      ELSE 'test' END AS split FROM p"""


@query("time_split", _split("ORDER BY date, store_id, product_id", "", "v_sales", "date, store_id, product_id, sales"))
def _(t):
    return A.time_split(t.sales.drop("revenue", "price"), ["date", *KEYS])


@query("time_split_text", _split("ORDER BY o_orderpriority, o_orderkey", "", "orders", "o_orderpriority, o_orderkey"))
def _(t):
    return A.time_split(t.table("orders").select("o_orderpriority", "o_orderkey"), ["o_orderpriority", "o_orderkey"])


@query("time_split_series", _split("PARTITION BY store_id ORDER BY date", "PARTITION BY store_id", "v_store_days", "date, store_id, sales"))
def _(t):
    return A.time_split(t.store_days, ["date"], keys=["store_id"])


@query("ts_cv_folds", """
    WITH p AS (SELECT *, row_number() OVER (PARTITION BY store_id ORDER BY date) - 1 AS pos,
        count(*) OVER (PARTITION BY store_id) AS n FROM v_store_days),
      f AS (SELECT p.*, CAST(k AS INTEGER) AS fold, n - (5 - k) * (n // 6) AS start FROM p, range(5) AS g(k))
    SELECT store_id, date, sales, fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role FROM f
    WHERE pos < start + n // 6""")
def _(t):
    return A.ts_cv_folds(t.store_days, "date", ["store_id"])


@query("union_forecasts", """
    SELECT store_id, ds, naive7 AS yhat, naive7 - 1 AS yhat_lower, 'naive7' AS model FROM v_forecasts
    UNION ALL SELECT store_id, ds, mean7, NULL, 'mean7' FROM v_forecasts""")
def _(t):
    f = t.forecasts
    with_bound = f.select("store_id", "ds", F.col("naive7").alias("yhat"), (F.col("naive7") - 1).alias("yhat_lower"))
    return A.union_forecasts({"naive7": with_bound, "mean7": f.select("store_id", "ds", F.col("mean7").alias("yhat"))})


@query("concat_rows", """
    SELECT store_id, date, sales FROM v_store_days UNION ALL SELECT store_id, date, NULL FROM v_dense WHERE sales IS NULL""")
def _(t):
    from demandloom.operators.calendar import missing_dates

    return A.concat_rows(t.store_days, missing_dates(t.store_days, ["store_id"]))


@query("dedupe_actuals", "SELECT store_id, date AS ds, sales AS y FROM v_store_days")
def _(t):
    known = t.store_days.select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"))
    return A.dedupe_actuals(known.unionByName(known.withColumn("y", F.lit(None).cast("double"))), ["store_id"])
