"""Queries: scans, projections, missing values, calendars, outliers, scaling."""

from pyspark.sql import functions as F

from demandloom.operators import calendar as C
from demandloom.operators import encode as E
from demandloom.operators import missing as M
from demandloom.operators import outliers as O
from demandloom.operators import scaling as S
from demandloom.plans.registry import query, r6
from demandloom.sources import io

KEYS = ["store_id", "product_id"]
W = "(PARTITION BY store_id, product_id ORDER BY date"


@query("scan_table", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _(t):
    df = io.scan_table(t.spark, f"{t.path}/orders.parquet", "parquet")
    return df.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("scan_csv_dates", "SELECT date, store_id, sales FROM v_store_days")
def _(t):
    path = io.scratch_path(t.spark, "store_days_csv")
    io.write_csv(t.store_days.select("date", "store_id", "sales"), path)
    return io.scan_csv_dates(t.spark, path, "date string, store_id int, sales double")


@query("sink_parquet", "SELECT store_id, date, sales FROM v_store_days UNION ALL SELECT store_id, date, sales FROM v_store_days")
def _(t):
    path = io.scratch_path(t.spark, "store_days")
    out = t.store_days.select("store_id", "date", "sales")
    io.write_parquet(out, path, mode="overwrite", partition_by=["store_id"])
    io.write_parquet(out, path, mode="append", partition_by=["store_id"])
    return t.spark.read.schema(out.schema).parquet(path)


@query("sink_csv", "SELECT store_id, product_id, current_stock, safety_stock, reorder_point FROM v_inventory")
def _(t):
    path = io.scratch_path(t.spark, "inventory_csv")
    io.write_csv(t.inventory, path)
    return t.spark.read.csv(path, header=True, schema=t.inventory.schema)


@query("cast_dates", """
    SELECT o_orderkey, TRY_CAST(CASE WHEN o_orderkey % 7 = 0 THEN 'not a date'
        ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS order_day FROM orders""")
def _(t):
    text = F.when(F.col("o_orderkey") % 7 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    df = t.table("orders").select("o_orderkey", text.alias("order_day"))
    return E.cast_dates(df, ["order_day", "absent"], to="date")


@query("filter_date_range", """
    SELECT store_id, date, sales FROM v_sales WHERE date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""")
def _(t):
    return S.filter_date_range(t.sales, "date", "1996-01-01", "1997-12-31", ["store_id"], "sales")


@query("filter_series", "SELECT date, store_id, product_id, sales FROM v_sales WHERE store_id = 3 AND product_id = 12")
def _(t):
    return E.filter_series(t.sales.select("date", *KEYS, "sales"), store_id=3, product_id=12)


@query("filter_active_stores", """
    SELECT date, store_id, product_id, sales FROM v_sales
    WHERE store_id IN (SELECT store_id FROM v_stores WHERE is_active)""")
def _(t):
    return E.filter_active(t.sales.select("date", *KEYS, "sales"), t.stores, "store_id")


@query("drop_null_rows", "SELECT * FROM v_gappy WHERE sales IS NOT NULL")
def _(t):
    return M.drop_null_rows(t.gappy)


@query("rename_ds_y", """
    SELECT s.store_id, s.product_id, s.date AS ds, s.sales AS y, CAST(0 AS INTEGER) AS is_holiday, w.temperature
    FROM v_sales s LEFT JOIN v_weather w USING (date)""")
def _(t):
    weather = t.weather.select("date", F.col("temperature").alias("mean_temperature"))
    return E.rename_ds_y(t.sales.join(weather, "date", "left"), "date", "sales", ["is_holiday", "temperature"], KEYS)


@query("select_var_columns", "SELECT store_id, product_id, date, sales, revenue FROM v_sales")
def _(t):
    return E.select_var_columns(t.sales, ["sales", "revenue"], "date", KEYS)


_REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query("one_hot", "SELECT date, product_id, store_id, sales, "
       + ", ".join(f"CASE WHEN region = '{r}' THEN 1 ELSE 0 END AS \"region_{r}\"" for r in _REGIONS)
       + " FROM v_sales JOIN v_stores USING (store_id)")
def _(t):
    df = t.sales.join(t.stores, "store_id").select("date", *KEYS, "sales", "region")
    return E.one_hot(df, "region", {"region": _REGIONS})


@query("one_hot_index_text", """
    SELECT c_custkey, c_name, CASE WHEN c_name IS NOT NULL THEN dense_rank() OVER (ORDER BY c_name) - 1 END AS c_name_index FROM customer""")
def _(t):
    return E.one_hot_index(t.table("customer").select("c_custkey", "c_name"), "c_name")


@query("one_hot_index", """
    SELECT o_custkey, o_orderkey, CAST(dense_rank() OVER (ORDER BY o_custkey) - 1 AS BIGINT) AS o_custkey_index FROM orders""")
def _(t):
    return E.one_hot_index(t.table("orders").select("o_orderkey", "o_custkey"), "o_custkey")


@query("bin_values", """
    SELECT date, temperature, CASE WHEN temperature > -100 AND temperature <= 0 THEN 'freezing'
      WHEN temperature > 0 AND temperature <= 10 THEN 'cold' WHEN temperature > 10 AND temperature <= 20 THEN 'mild'
      WHEN temperature > 20 AND temperature <= 30 THEN 'warm' WHEN temperature > 30 AND temperature <= 100 THEN 'hot'
      END AS temperature_bin FROM v_weather""")
def _(t):
    df = t.weather.select("date", "temperature")
    return E.bin_values(df, "temperature", (-100, 0, 10, 20, 30, 100), ("freezing", "cold", "mild", "warm", "hot"))


# Missing values ----------------------------------------------------------

_FILLED = f"""
    SELECT date, store_id, product_id, coalesce(
      last_value(sales IGNORE NULLS) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(sales IGNORE NULLS) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS sales
    FROM v_gappy"""


@query("fill_ffill", _FILLED)
def _(t):
    return M.handle_missing(t.gappy, "ffill", KEYS, "date")


@query("fill_ffill_whole_table", """
    SELECT date, store_id, product_id, coalesce(
      last_value(sales IGNORE NULLS) OVER (ORDER BY date, store_id, product_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(sales IGNORE NULLS) OVER (ORDER BY date, store_id, product_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS sales FROM v_gappy""")
def _(t):
    return M.fill(t.gappy, "sales", "ffill", (), ["date", *KEYS])


@query("fill_bfill", f"""
    SELECT date, store_id, product_id, coalesce(
      first_value(sales IGNORE NULLS) OVER {W} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
      last_value(sales IGNORE NULLS) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS sales
    FROM v_gappy""")
def _(t):
    return M.handle_missing(t.gappy, "bfill", KEYS, "date")


def _interpolated(source: str, keys: str = "store_id, product_id") -> str:
    w = f"(PARTITION BY {keys} ORDER BY date"
    return f"""
    SELECT date, {keys}, round(CASE WHEN sales IS NOT NULL THEN sales WHEN nk IS NULL THEN pv
        WHEN pk IS NULL THEN nv ELSE pv + (nv - pv) * (CAST(k - pk AS DOUBLE) / (nk - pk)) END, 6) AS sales
    FROM (SELECT *,
        last_value(sales IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
        last_value(kk IGNORE NULLS) OVER {w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pk,
        first_value(sales IGNORE NULLS) OVER {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
        first_value(kk IGNORE NULLS) OVER {w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nk
      FROM (SELECT *, CASE WHEN sales IS NOT NULL THEN k END AS kk
        FROM (SELECT *, row_number() OVER {w}) AS k FROM {source})))"""


@query("fill_interpolate", _interpolated("v_gappy"))
def _(t):
    return r6(M.handle_missing(t.gappy, "interpolate", KEYS, "date"))


@query("fill_interpolate_whole_table", _interpolated("v_gappy").replace("PARTITION BY store_id, product_id ORDER BY date", "ORDER BY date, store_id, product_id"))
def _(t):
    return r6(M.fill(t.gappy, "sales", "interpolate", (), ["date", *KEYS]))


@query("fill_mean", "SELECT date, store_id, product_id, coalesce(sales, (SELECT avg(sales) FROM v_gappy)) AS sales FROM v_gappy")
def _(t):
    return M.fill_statistic(t.gappy, "mean", ["sales"])


@query("fill_median", "SELECT date, store_id, product_id, coalesce(sales, (SELECT median(sales) FROM v_gappy)) AS sales FROM v_gappy")
def _(t):
    return M.fill_statistic(t.gappy, "median", ["sales"])


@query("fill_zero", "SELECT date, store_id, product_id, coalesce(sales, 0) AS sales FROM v_gappy")
def _(t):
    return M.fill_zero(t.gappy)


@query("fill_mode", """
    WITH p AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderpriority END AS priority FROM orders)
    SELECT o_orderkey, coalesce(priority, (SELECT priority FROM p WHERE priority IS NOT NULL GROUP BY priority
        ORDER BY count(*) DESC, priority LIMIT 1)) AS priority FROM p""")
def _(t):
    priority = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderpriority"))
    return M.fill_mode(t.table("orders").select("o_orderkey", priority.alias("priority")))


@query("missing_report", """
    SELECT 'date' AS "column", count(*) - count(date) AS missing, count(*) AS total FROM v_gappy
    UNION ALL SELECT 'store_id', count(*) - count(store_id), count(*) FROM v_gappy
    UNION ALL SELECT 'product_id', count(*) - count(product_id), count(*) FROM v_gappy
    UNION ALL SELECT 'sales', count(*) - count(sales), count(*) FROM v_gappy""")
def _(t):
    return M.missing_report(t.gappy)


@query("clean_sales", f"""
    WITH raw AS (SELECT date, store_id, product_id, CASE WHEN day(date) <> 15 THEN sales END AS sales,
        CASE WHEN day(date) % 7 <> 0 THEN price END AS price, CASE WHEN day(date) % 3 <> 0 THEN revenue END AS revenue,
        CASE WHEN product_id % 10 <> 0 THEN concat('Cat', CAST(product_id % 5 AS VARCHAR)) END AS category FROM v_sales)
    SELECT date, store_id, product_id, coalesce(sales, (SELECT avg(sales) FROM raw)) AS sales,
      coalesce(last_value(price IGNORE NULLS) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        first_value(price IGNORE NULLS) OVER {W} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS price,
      round(coalesce(revenue, (SELECT median(revenue) FROM raw)), 6) AS revenue,
      coalesce(category, (SELECT category FROM raw WHERE category IS NOT NULL GROUP BY category
        ORDER BY count(*) DESC, category LIMIT 1)) AS category FROM raw""")
def _(t):
    day, p = F.dayofmonth("date"), F.col("product_id")
    raw = t.sales.select(
        "date", *KEYS,
        F.when(day != 15, F.col("sales")).alias("sales"),
        F.when(day % 7 != 0, F.col("price")).alias("price"),
        F.when(day % 3 != 0, F.col("revenue")).alias("revenue"),
        F.when(p % 10 != 0, F.concat(F.lit("Cat"), (p % 5).cast("string"))).alias("category"),
    )
    return r6(M.clean_sales(raw, KEYS), "revenue")


# Calendars ---------------------------------------------------------------

@query("calendar_fill", """
    SELECT date, store_id, last_value(sales IGNORE NULLS) OVER (PARTITION BY store_id ORDER BY date
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales FROM v_dense""")
def _(t):
    return C.calendar_fill(t.store_days, ["store_id"], method="ffill")


@query("calendar_fill_zero", "SELECT date, store_id, coalesce(sales, 0) AS sales FROM v_dense")
def _(t):
    return C.calendar_fill(t.store_days, ["store_id"], method="zero")


@query("calendar_fill_interpolate", _interpolated("v_dense", "store_id"))
def _(t):
    return r6(C.calendar_fill(t.store_days, ["store_id"], method="interpolate"))


def _resampled(label: str, series: str, aggregate: str, empty: str) -> str:
    return f"""
    WITH b AS (SELECT store_id, {label} AS date, {aggregate} AS sales FROM v_store_days GROUP BY 1, 2),
      d AS (SELECT store_id, {series} AS date FROM b GROUP BY 1)
    SELECT store_id, date, {empty} AS sales FROM d LEFT JOIN b USING (store_id, date)"""


_WEEK = "CAST(date AS DATE) + CAST(7 - isodow(date) AS INTEGER)"


def _period_series(unit: str, step: str, last: str) -> str:
    return (f"unnest(list_transform(generate_series(date_trunc('{unit}', min(date)), date_trunc('{unit}', max(date)), "
            f"INTERVAL {step}), lambda x: {last}))")


@query("resample", _resampled(_WEEK, "CAST(unnest(generate_series(min(date), max(date), INTERVAL 7 DAY)) AS DATE)",
                              "sum(sales)", "coalesce(sales, 0)"))
def _(t):
    return C.resample(t.store_days, ["sales"], "W", "sum", ["store_id"])


@query("resample_month_mean", _resampled("last_day(date)", _period_series("month", "1 MONTH", "last_day(x)"), "avg(sales)", "sales"))
def _(t):
    return C.resample(t.store_days, ["sales"], "M", "mean", ["store_id"])


@query("resample_quarter_median", _resampled(
    "last_day(CAST(date_trunc('quarter', date) AS DATE) + INTERVAL 2 MONTH)",
    _period_series("quarter", "3 MONTH", "last_day(x + INTERVAL 2 MONTH)"), "median(sales)", "sales"))
def _(t):
    return C.resample(t.store_days, ["sales"], "Q", "median", ["store_id"])


@query("resample_year_mixed", """
    SELECT store_id, make_date(CAST(year(date) AS INTEGER), 12, 31) AS date, min(sales) AS sales, sum(n) AS n
    FROM (SELECT store_id, date, sales, CAST(1 AS DOUBLE) AS n FROM v_store_days) GROUP BY 1, 2""")
def _(t):
    return C.resample(t.store_days.withColumn("n", F.lit(1.0)), ["sales", "n"], "Y", {"sales": "min"}, ["store_id"])


@query("missing_dates", "SELECT store_id, date FROM v_dense WHERE sales IS NULL")
def _(t):
    return C.missing_dates(t.store_days, ["store_id"])


@query("dedupe_dates", """
    SELECT date, store_id, l_orderkey, l_quantity FROM (SELECT *, row_number() OVER
      (PARTITION BY store_id, date ORDER BY l_orderkey, l_quantity) AS rn FROM v_lines) WHERE rn = 1""")
def _(t):
    df = t.lines("date", "store_id").select("date", "store_id", "l_orderkey", "l_quantity")
    return C.dedupe_dates(df, ["l_orderkey", "l_quantity"], ["store_id"])


@query("clean_external", """
    WITH d AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_social),
      k AS (SELECT date, retail_trend AS x, row_number() OVER (ORDER BY date) AS k FROM d LEFT JOIN v_social USING (date)),
      n AS (SELECT *, last_value(x IGNORE NULLS) OVER a AS pv, first_value(x IGNORE NULLS) OVER b AS nv,
          last_value(CASE WHEN x IS NOT NULL THEN k END IGNORE NULLS) OVER a AS pk,
          first_value(CASE WHEN x IS NOT NULL THEN k END IGNORE NULLS) OVER b AS nk FROM k
        WINDOW a AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          b AS (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT date, round(CASE WHEN x IS NOT NULL THEN x ELSE pv + (nv - pv) * (CAST(k - pk AS DOUBLE) / (nk - pk)) END, 6)
      AS retail_trend FROM n""")
def _(t):
    doubled = t.social.unionByName(t.social.withColumn("retail_trend", F.col("retail_trend") + 100))
    return r6(C.clean_external(doubled, order="retail_trend"))


@query("clean_external_outliers", """
    SELECT 'sales' AS "column", count(*) FILTER (WHERE abs((sales - m) / s) > 3) AS outliers
      FROM v_sales, (SELECT avg(sales) AS m, stddev_samp(sales) AS s FROM v_sales)
    UNION ALL SELECT 'price', count(*) FILTER (WHERE abs((price - m) / s) > 3)
      FROM v_sales, (SELECT avg(price) AS m, stddev_samp(price) AS s FROM v_sales)""")
def _(t):
    return C.external_outliers(t.sales, ["sales", "price"])


@query("preprocess_series", f"""
    WITH f AS ({_FILLED}), q AS (SELECT *, quantile_cont(sales, 0.25) OVER p AS a, quantile_cont(sales, 0.75) OVER p AS b
        FROM f WINDOW p AS (PARTITION BY store_id, product_id))
    SELECT date, store_id, product_id, least(greatest(sales, a - 1.5 * (b - a)), b + 1.5 * (b - a)) AS sales FROM q""")
def _(t):
    return C.preprocess_series(t.gappy, KEYS)


# Outliers ----------------------------------------------------------------

@query("outlier_remove_zscore", """
    WITH a AS (SELECT date, store_id, product_id, sales, price FROM v_sales
        WHERE abs((sales - (SELECT avg(sales) FROM v_sales)) / (SELECT stddev_samp(sales) FROM v_sales)) <= 2.5)
    SELECT * FROM a WHERE abs((price - (SELECT avg(price) FROM a)) / (SELECT stddev_samp(price) FROM a)) <= 2.5""")
def _(t):
    return O.remove_outliers(t.sales.drop("revenue"), ["sales", "price", "absent"], "zscore", 2.5)


@query("outlier_remove_iqr", """
    WITH q AS (SELECT quantile_cont(sales, 0.25) AS a, quantile_cont(sales, 0.75) AS b FROM v_sales)
    SELECT date, store_id, product_id, sales FROM v_sales, q WHERE sales BETWEEN a - 3 * (b - a) AND b + 3 * (b - a)""")
def _(t):
    return O.remove_outliers(t.sales.drop("revenue", "price"), ["sales"], "iqr", 3.0)


@query("winsorize", """
    WITH q AS (SELECT quantile_cont(sales, 0.01) AS a, quantile_cont(sales, 0.99) AS b FROM v_sales)
    SELECT date, store_id, product_id, round(least(greatest(sales, a), b), 6) AS sales FROM v_sales, q""")
def _(t):
    return r6(O.handle_outliers(t.sales.drop("revenue", "price"), "winsorize", "sales"))


@query("winsorize_all", """
    WITH q AS (SELECT quantile_cont(sales, 0.01) AS sa, quantile_cont(sales, 0.99) AS sb, quantile_cont(revenue, 0.01) AS ra,
        quantile_cont(revenue, 0.99) AS rb FROM v_sales)
    SELECT date, store_id, product_id, round(greatest(least(sales, sb), sa), 6) AS sales,
      round(greatest(least(revenue, rb), ra), 6) AS revenue FROM v_sales, q""")
def _(t):
    return r6(O.handle_outliers(t.sales.drop("price"), "winsorize", ["sales", "revenue"]))


@query("outlier_remove_iqr_all", """
    WITH a AS (SELECT quantile_cont(sales, 0.25) AS a, quantile_cont(sales, 0.75) AS b FROM v_sales),
      s AS (SELECT v.* FROM v_sales v, a WHERE sales BETWEEN a - (b - a) * 1.5 AND b + (b - a) * 1.5),
      c AS (SELECT quantile_cont(revenue, 0.25) AS a, quantile_cont(revenue, 0.75) AS b FROM s),
      r AS (SELECT s.* FROM s, c WHERE revenue BETWEEN a - (b - a) * 1.5 AND b + (b - a) * 1.5),
      e AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM r)
    SELECT date, store_id, product_id, sales, revenue
    FROM r, e WHERE price BETWEEN a - (b - a) * 1.5 AND b + (b - a) * 1.5""")
def _(t):
    return O.remove_outliers(t.sales, ["sales", "revenue", "price"], "iqr", 1.5).drop("price")


@query("winsorize_grouped", """
    WITH q AS (SELECT store_id, quantile_cont(sales, 0.05) AS a, quantile_cont(sales, 0.95) AS b FROM v_sales GROUP BY 1)
    SELECT date, store_id, product_id, round(least(greatest(sales, a), b), 6) AS sales FROM v_sales JOIN q USING (store_id)""")
def _(t):
    return r6(O.handle_outliers(t.sales.drop("revenue", "price"), "winsorize", "sales", (0.05, 0.05), groupby="store_id"))


@query("trim", """
    WITH q AS (SELECT store_id, quantile_cont(sales, 0.01) AS a, quantile_cont(sales, 0.99) AS b FROM v_gappy GROUP BY 1)
    SELECT date, store_id, product_id, sales FROM v_gappy JOIN q USING (store_id) WHERE sales BETWEEN a AND b""")
def _(t):
    return O.handle_outliers(t.gappy, "trim", "sales", groupby="store_id")


@query("outlier_zscore", """
    WITH q AS (SELECT store_id, product_id, avg(sales) AS m, stddev_pop(sales) AS s FROM v_gappy GROUP BY 1, 2)
    SELECT date, store_id, product_id, sales FROM v_gappy JOIN q USING (store_id, product_id)
    WHERE coalesce(abs((sales - m) / nullif(s, 0)) <= 2.0, true)""")
def _(t):
    return O.handle_outliers(t.gappy, "zscore", "sales", threshold=2.0, groupby=KEYS)


@query("outlier_iqr", """
    WITH q AS (SELECT store_id, quantile_cont(sales, 0.25) AS a, quantile_cont(sales, 0.75) AS b FROM v_sales GROUP BY 1)
    SELECT date, store_id, product_id, sales FROM v_sales JOIN q USING (store_id)
    WHERE sales BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a)""")
def _(t):
    return O.handle_outliers(t.sales.drop("revenue", "price"), "iqr", "sales", groupby="store_id")


@query("outlier_flag", """
    WITH z AS (SELECT avg(sales) AS m, stddev_pop(sales) AS s FROM v_gappy),
      q AS (SELECT store_id, quantile_cont(sales, 0.25) AS a, quantile_cont(sales, 0.75) AS b FROM v_gappy GROUP BY 1)
    SELECT date, store_id, product_id, sales, coalesce(abs((sales - m) / s) > 2.0, false) AS far_out,
      coalesce(sales NOT BETWEEN a - 1.5 * (b - a) AND b + 1.5 * (b - a), true) AS out_of_range
    FROM v_gappy JOIN q USING (store_id), z""")
def _(t):
    flagged = O.detect_outliers(t.gappy, "sales", "zscore", 2.0, output="far_out")
    return O.detect_outliers(flagged, "sales", "iqr", groupby="store_id", output="out_of_range")


# Scaling -----------------------------------------------------------------

@query("scale_standard", """
    SELECT date, store_id, product_id, round((sales - m) / s, 6) AS sales, round((price - n) / u, 6) AS price
    FROM v_sales, (SELECT avg(sales) AS m, stddev_pop(sales) AS s, avg(price) AS n, stddev_pop(price) AS u FROM v_sales)""")
def _(t):
    return r6(S.scale_features(t.sales.drop("revenue"), ["sales", "price"]))


@query("scale_minmax", """
    SELECT date, store_id, product_id, round((sales - a) / (b - a), 6) AS sales
    FROM v_sales, (SELECT min(sales) AS a, max(sales) AS b FROM v_sales)""")
def _(t):
    return r6(S.scale_features(t.sales.drop("revenue", "price"), ["sales"], "minmax"))


@query("transform_log", """
    SELECT date, store_id, product_id, round(ln(1 + sales + c), 6) AS sales
    FROM v_sales, (SELECT CASE WHEN min(sales) > 0 THEN 0 ELSE abs(min(sales)) + 1 END AS c FROM v_sales)""")
def _(t):
    return r6(S.filter_and_transform(t.sales.drop("revenue", "price"), "sales", method="log")[0])


@query("transform_sqrt", """
    SELECT date, round(sqrt(temperature + c), 6) AS temperature
    FROM v_weather, (SELECT CASE WHEN min(temperature) >= 0 THEN 0 ELSE abs(min(temperature)) + 1 END AS c FROM v_weather)""")
def _(t):
    return r6(S.filter_and_transform(t.weather.drop("precipitation"), "temperature", method="sqrt")[0])


@query("transform_boxcox")
def _(t):
    return S.filter_and_transform(t.sales.drop("revenue", "price"), "sales", method="box-cox")[0]


@query("inverse_transform", """
    SELECT date, store_id, product_id, round(sales, 6) AS log, round(sales, 6) AS sqrt, round(sales, 6) AS standardize,
      round(sales, 6) AS normalize, round(sales, 6) AS "box-cox", round(sales, 6) AS none FROM v_sales""")
def _(t):
    out = base = io.settle(t.sales.drop("revenue", "price"), "sales")
    for method in ("log", "sqrt", "standardize", "normalize", "box-cox", "none"):
        params = S.transform_params(base, "sales", method)
        out = S.inverse_transform(S.transform(out.withColumn("x", F.col("sales")), "x", params, method), "x", params, method)
        out = out.withColumnRenamed("x", method)
    return r6(out.drop("sales"))
