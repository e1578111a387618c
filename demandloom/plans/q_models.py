"""Queries: forecasting, scoring, stacking, vector autoregression and streams."""

from statistics import NormalDist

from pyspark.sql import functions as F

from demandloom.operators import external as X
from demandloom.operators.encode import filter_active
from demandloom.operators.forecast import additive as AD
from demandloom.operators.forecast import boosted as B
from demandloom.operators.forecast import scoring as SC
from demandloom.operators.forecast import simple as SI
from demandloom.operators.forecast import stacking as ST
from demandloom.operators.forecast import var as V
from demandloom.plans.flagship import store_product_policy
from demandloom.plans.registry import query, r6
from demandloom.sources import io
from demandloom.sources.retail import MODELS
from demandloom.streaming import scoring as S
from demandloom.streaming.series import series_features

STORE = "PARTITION BY store_id ORDER BY date"


def _history(t):
    return t.store_days.select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"))


def _pairs(t):
    """Store-day sales with the number of lines, for models of two variables."""
    return t.lines("store_id", "date").groupBy("store_id", "date").agg(
        F.sum("l_quantity").alias("sales"), F.count(F.lit(1)).cast("double").alias("lines"))


@query("store_product_policy", f"""
    WITH c AS (SELECT store_id, product_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
        FROM v_sales GROUP BY 1, 2),
      d AS (SELECT store_id, product_id, date, coalesce(sales, 0) AS y FROM c LEFT JOIN v_sales USING (store_id, product_id, date)),
      n AS (SELECT *, lag(y, 7) OVER (PARTITION BY store_id, product_id ORDER BY date) AS p FROM d),
      a AS (SELECT store_id, product_id, avg(abs(p - y)) AS mae, sqrt(avg((p - y) * (p - y))) AS rmse, avg(p - y) AS bias,
        sum(abs(p - y)) / nullif(sum(abs(y)), 0) * 100 AS wmape FROM n WHERE p IS NOT NULL GROUP BY 1, 2),
      s AS (SELECT store_id, product_id, avg(y) AS daily_demand, stddev_samp(y) AS sd FROM d GROUP BY 1, 2),
      q AS (SELECT *, {NormalDist().inv_cdf(0.95)!r} * sd * sqrt(lead_time_days) AS ss, daily_demand * 365 AS annual, cost * 0.2 AS h
        FROM s JOIN v_products USING (product_id)),
      e AS (SELECT *, daily_demand * lead_time_days + ss AS rop, sqrt(2 * annual * 50 / nullif(h, 0)) AS eoq FROM q)
    SELECT store_id, product_id, round(ss, 6) AS safety_stock, round(rop, 6) AS reorder_point, round(eoq, 6) AS economic_order_quantity,
      0 <= rop AS reorder_needed, round(CASE WHEN 0 <= rop THEN eoq ELSE 0 END, 6) AS order_quantity,
      CASE WHEN daily_demand > 0 THEN CAST(0 AS DOUBLE) END AS days_of_supply, round(daily_demand, 6) AS daily_demand,
      round(annual, 6) AS annual_demand, round(annual / nullif(eoq, 0) * 50, 6) AS annual_ordering_cost,
      round((ss + eoq / 2) * h, 6) AS annual_holding_cost, round(annual / nullif(eoq, 0) * 50 + (ss + eoq / 2) * h, 6) AS total_annual_cost,
      round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(bias, 6) AS bias, round(wmape, 6) AS wmape
    FROM e LEFT JOIN a USING (store_id, product_id)""")
def _(t):
    return r6(store_product_policy(t.spark, t.path))


@query("forecast_naive_mean", f"""
    WITH l AS (SELECT store_id, avg(sales) AS yhat, max(date) AS last FROM (SELECT *, row_number() OVER
        (PARTITION BY store_id ORDER BY date DESC) AS r FROM v_store_days) WHERE r <= 7 GROUP BY 1)
    SELECT store_id, last + CAST(i AS INTEGER) AS ds, yhat FROM l, generate_series(1, 30) AS g(i)""")
def _(t):
    return SI.forecast_naive_mean(t.store_days, ["store_id"])


@query("seasonal_decompose", f"""
    WITH m AS (SELECT store_id, date, sales, CASE WHEN count(sales) OVER w = 7 THEN avg(sales) OVER w END AS trend,
        (row_number() OVER ({STORE}) - 1) % 7 AS phase FROM v_store_days
      WINDOW w AS ({STORE} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
      f AS (SELECT store_id, phase, avg(sales / nullif(trend, 0)) AS f FROM m GROUP BY 1, 2),
      s AS (SELECT store_id, phase, f / avg(f) OVER (PARTITION BY store_id) AS seasonal FROM f)
    SELECT store_id, date, sales, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
      round(sales / nullif(trend * seasonal, 0), 6) AS remainder FROM m JOIN s USING (store_id, phase)""")
def _(t):
    return r6(SI.seasonal_decompose(t.store_days, ["store_id"]))


_MI_FEATURES = ("price", "temperature", "precipitation")


def _mi_sql() -> str:
    probs = "[" + ", ".join(str(i / 10) for i in range(1, 10)) + "]"
    parts, bins = [], []
    for c in ("sales", *_MI_FEATURES):
        bins.append(f"len(list_filter((SELECT quantile_cont({c}, {probs}) FROM f), lambda e: e < {c})) AS {c}_b")
    for c in _MI_FEATURES:
        parts.append(f"""SELECT '{c}' AS feature, sum(n / t * ln(n * t / (na * nb))) AS mi FROM (
            SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY a) AS na, sum(n) OVER (PARTITION BY b) AS nb FROM (
              SELECT {c}_b AS a, sales_b AS b, CAST(count(*) AS DOUBLE) AS n FROM g GROUP BY 1, 2))""")
    return f"""WITH f AS (SELECT * FROM v_sales JOIN v_weather USING (date)), g AS (SELECT {', '.join(bins)} FROM f)
      SELECT feature, round(mi, 6) AS mutual_info FROM ({' UNION ALL '.join(parts)})"""


@query("select_features_mi", _mi_sql())
def _(t):
    df = t.sales.join(t.weather, "date").select("sales", *_MI_FEATURES)
    return r6(SI.select_features_mi(df, "sales"))


@query("select_features_model")
def _(t):
    df = t.sales.drop("revenue").join(t.weather, "date")
    return B.select_features_model(df, "sales", 5, ["price", "temperature", "precipitation", "store_id", "product_id"])


@query("forecast_additive")
def _(t):
    days = X.holiday_days(X.holiday_windows(t.holidays))
    return AD.forecast_additive(_history(t), ["store_id"], 30, holidays=days)


@query("forecast_components")
def _(t):
    return AD.forecast_components(_history(t), ["store_id"])


@query("forecast_many")
def _(t):
    history = t.sales.select("store_id", "product_id", F.col("date").alias("ds"), F.col("sales").alias("y"))
    return AD.forecast_additive(history, ["store_id", "product_id"], 30, include_history=False)


@query("model_table_io", """
    SELECT store_id, 'ok' AS status, count(*) AS n, min(date) AS first_ds, max(date) AS last_ds FROM v_store_days GROUP BY 1""")
def _(t):
    path = io.scratch_path(t.spark, "models")
    SC.write_models(AD.fit_additive(_history(t), ["store_id"]), path)
    return SC.read_models(t.spark, path).select("store_id", "status", "n", "first_ds", "last_ds")


@query("join_model_state", """
    SELECT store_id, date, sales, n FROM v_store_days JOIN
      (SELECT store_id, count(*) AS n FROM v_store_days JOIN v_stores USING (store_id) WHERE is_active GROUP BY 1)
      USING (store_id)""")
def _(t):
    # Closed stores have no model, so their rows find none.
    models = AD.fit_additive(filter_active(_history(t), t.stores, "store_id"), ["store_id"])
    return SC.join_model_state(t.store_days, models, ["store_id"]).select("store_id", "date", "sales", "n")


@query("score_batch")
def _(t):
    models = AD.fit_additive(_history(t), ["store_id"])
    return SC.score_batch(t.store_days, models, ["store_id"])


def _requests(t):
    """A request for each order: ids that are missing or unknown, all steps, horizons of 0, given and default, some with history."""
    k = F.col("o_orderkey")
    models = AD.fit_additive(_history(t), ["store_id"]).withColumn("model_id", F.col("store_id").cast("string"))
    requests = t.table("orders").select(
        k.alias("request_id"),
        F.when(k % 11 != 0, (F.col("o_custkey") % 30).cast("string")).alias("model_id"),
        F.when(k % 7 != 0, (k % 5).cast("int")).alias("horizon"),
        F.when(k % 3 == 0, "W").when(k % 3 == 1, "M").alias("freq"),
        (k % 500 == 0).alias("include_history"),
    )
    return SC.score_requests(requests, io.settle(models, "request-models"))


@query("score_requests")
def _(t):
    return _requests(t)


@query("score_requests_dates", """
    WITH r AS (SELECT o_orderkey AS request_id, CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_custkey % 30 AS VARCHAR) END AS model_id,
        CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 ELSE 30 END AS horizon, o_orderkey % 3 AS f, o_orderkey % 500 = 0 AS past FROM orders),
      m AS (SELECT CAST(store_id AS VARCHAR) AS model_id, min(date) AS a, max(date) AS z FROM v_store_days GROUP BY 1)
    SELECT request_id, r.model_id, CASE WHEN r.model_id IS NULL THEN 'missing_id' WHEN z IS NULL THEN 'not_found' ELSE 'ok' END AS status,
      CAST(CASE WHEN z IS NULL THEN 0 ELSE horizon + CASE WHEN past THEN z - a + 1 ELSE 0 END END AS BIGINT) AS days,
      CASE WHEN z IS NULL OR (horizon = 0 AND NOT past) THEN NULL WHEN horizon = 0 THEN z WHEN f = 0 THEN z + CAST(7 * horizon AS INTEGER)
        WHEN f = 1 THEN CAST(z + to_months(CAST(horizon AS INTEGER)) AS DATE) ELSE z + CAST(horizon AS INTEGER) END AS last_ds
    FROM r LEFT JOIN m ON r.model_id = m.model_id""")
def _(t):
    return _requests(t).groupBy("request_id", "model_id", "status").agg(F.count("ds").alias("days"), F.max("ds").alias("last_ds"))


@query("forecast_dates", """
    SELECT store_id, status, days, actuals, first_ds, last_ds, ordered FROM (
      SELECT store_id, 'ok' AS status, CAST(count(*) + 30 AS BIGINT) AS days, count(*) AS actuals, min(date) AS first_ds, max(date) + 30 AS last_ds,
        TRUE AS ordered FROM v_store_days GROUP BY 1)""")
def _(t):
    out = AD.forecast_additive(_history(t), ["store_id"], 30)
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return out.groupBy("store_id", "status").agg(
        F.count("ds").alias("days"), F.count("y").alias("actuals"), F.min("ds").alias("first_ds"), F.max("ds").alias("last_ds"),
        F.bool_and(inside).alias("ordered"))


@query("score_batch_var")
def _(t):
    models = V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"])
    return SC.score_batch_var(t.store_days, models, ["sales", "lines"], ["store_id"])


@query("backtest")
def _(t):
    return AD.backtest_metrics(AD.backtest(_history(t), ["store_id"]))


@query("backtest_cutoffs", """
    WITH b AS (SELECT store_id, min(date) AS a, max(date) AS z FROM v_store_days GROUP BY 1),
      c AS (SELECT store_id, z - CAST(30 + 180 * i AS INTEGER) AS cutoff FROM b, generate_series(0, 100) AS g(i) WHERE z - CAST(30 + 180 * i AS INTEGER) >= a + 730),
      r AS (SELECT store_id, cutoff, count(*) AS rows, sum(sales) AS y FROM c JOIN v_store_days s USING (store_id)
        WHERE s.date > cutoff AND s.date <= cutoff + 30 GROUP BY 1, 2)
    SELECT store_id, 'ok' AS status, cutoff, rows, y, TRUE AS ordered FROM r
    UNION ALL SELECT store_id, 'too_short', NULL, 1, NULL, NULL FROM b WHERE store_id NOT IN (SELECT store_id FROM r)""")
def _(t):
    out = AD.backtest(_history(t), ["store_id"]).groupBy("store_id", "status", "cutoff")
    inside = (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return out.agg(F.count(F.lit(1)).alias("rows"), F.sum("y").alias("y"), F.bool_and(inside).alias("ordered"))


@query("grid_search")
def _(t):
    grid = {"changepoint_prior_scale": [0.001, 0.05, 0.5], "seasonality_prior_scale": [0.1, 10.0]}
    return AD.grid_search(_history(t), ["store_id"], grid)


@query("forecast_gbt")
def _(t):
    return B.forecast_gbt(_history(t), ["store_id"], 30)


@query("forecast_gbt_dates", """
    WITH b AS (SELECT store_id, min(date) AS a, max(date) AS z FROM v_store_days GROUP BY 1)
    SELECT store_id, CASE WHEN z - a >= 27 THEN 'ok' ELSE 'too_short' END AS status, CASE WHEN z - a >= 27 THEN count(*) FILTER (date >= a + 28) ELSE 0 END AS known,
      CASE WHEN z - a >= 27 THEN CAST(30 AS BIGINT) ELSE 0 END AS ahead, CASE WHEN z - a >= 27 THEN z + 30 END AS last_ds
    FROM v_store_days JOIN b USING (store_id) GROUP BY store_id, a, z""")
def _(t):
    out = B.forecast_gbt(_history(t), ["store_id"], 30, max_iter=3)
    future = F.col("ds").isNotNull() & F.col("y").isNull()
    return out.groupBy("store_id", "status").agg(F.count("y").alias("known"), F.count(F.when(future, 1)).alias("ahead"), F.max("ds").alias("last_ds"))


@query("pooled_model_io", "SELECT store_id, count(*) AS days, TRUE AS same FROM v_store_days GROUP BY 1")
def _(t):
    # Stores are kinds here; the saved pipeline scores as the fitted one does.
    rows = t.store_days.select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"), F.lit(False).alias("is_validation"))
    rows = B.gbt_date_features(rows, "ds").withColumn("store", F.col("store_id").cast("string"))
    columns = [*B.DATE_FEATURES, "store"]
    model = B.fit_gbt(rows, columns, max_iter=5, early_stopping=False, categorical=["store"])
    path = io.scratch_path(t.spark, "pooled")
    B.write_pooled(model, path)
    first = model.transform(rows).select("store_id", "ds", F.col("yhat").alias("a"))
    again = B.read_pooled(path).transform(rows).select("store_id", "ds", F.col("yhat").alias("b"))
    return first.join(again, ["store_id", "ds"]).groupBy("store_id").agg(F.count(F.lit(1)).alias("days"), F.bool_and(F.col("a") == F.col("b")).alias("same"))


@query("grid_search_gbt")
def _(t):
    rows = B.training_rows(_history(t), ["store_id"], 30)
    grid = {"maxDepth": [3, 5], "stepSize": [0.05, 0.2]}
    return B.grid_search_gbt(rows, B.model_columns(), grid, ["ds", "store_id"], n_splits=3, maxIter=20)


@query("feature_importance")
def _(t):
    return B.feature_importance(_history(t), ["store_id"])


@query("ensemble_stacked")
def _(t):
    return ST.ensemble_stacked(t.forecasts, MODELS, ST.META_LEARNERS)


@query("ensemble_best")
def _(t):
    return ST.ensemble_best(t.forecasts, MODELS)


@query("var_fit")
def _(t):
    return V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]).select("store_id", "status", "n", "lag_order", "diff_order")


@query("var_forecast")
def _(t):
    return V.var_forecast(V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]), ["sales", "lines"], ["store_id"])


@query("var_coefficients")
def _(t):
    return V.var_coefficients(V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]), ["sales", "lines"], ["store_id"])


@query("var_lag_scores")
def _(t):
    return V.var_lag_scores(V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]), ["store_id"])


@query("var_irf")
def _(t):
    return V.var_irf(V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]), ["sales", "lines"], ["store_id"])


@query("var_fevd")
def _(t):
    return V.var_fevd(V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"]), ["sales", "lines"], ["store_id"])


@query("stationarity")
def _(t):
    return V.stationarity(_pairs(t), ["sales", "lines"], ["store_id"])


@query("granger")
def _(t):
    return V.granger(_pairs(t), "lines", "sales", ["store_id"])


# One lag of two variables, where the normal equations have a closed form.
_TWO = """
    p AS (SELECT store_id, date, sum(l_quantity) AS y, CAST(count(*) AS DOUBLE) AS x FROM v_lines GROUP BY 1, 2),
    c AS (SELECT store_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM p GROUP BY 1),
    j AS (SELECT store_id, date, y, x, row_number() OVER (PARTITION BY store_id ORDER BY date) AS k FROM c LEFT JOIN p USING (store_id, date)),
    m AS (SELECT *, CASE WHEN y IS NOT NULL THEN k END AS kk FROM j),
    g AS (SELECT *, last_value(y IGNORE NULLS) OVER b AS py, last_value(x IGNORE NULLS) OVER b AS px, last_value(kk IGNORE NULLS) OVER b AS pk,
        first_value(y IGNORE NULLS) OVER f AS ny, first_value(x IGNORE NULLS) OVER f AS nx, first_value(kk IGNORE NULLS) OVER f AS nk FROM m
      WINDOW b AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        f AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
    z AS (SELECT store_id, date, CASE WHEN y IS NOT NULL THEN y ELSE py + (ny - py) * (k - pk) / (nk - pk) END AS y,
        CASE WHEN x IS NOT NULL THEN x ELSE px + (nx - px) * (k - pk) / (nk - pk) END AS x FROM g),
    l AS (SELECT *, lag(y) OVER w AS u, lag(x) OVER w AS v FROM z WINDOW w AS (PARTITION BY store_id ORDER BY date)),
    s AS (SELECT store_id, count(*) AS n, avg(y) AS my, avg(x) AS mx, avg(u) AS mu, avg(v) AS mv, var_pop(u) AS uu, var_pop(v) AS vv,
        covar_pop(u, v) AS uv, covar_pop(u, y) AS uy, covar_pop(v, y) AS vy, covar_pop(u, x) AS ux, covar_pop(v, x) AS vx,
        var_pop(y) AS yy, var_pop(x) AS xx, covar_pop(y, x) AS yx FROM l WHERE u IS NOT NULL GROUP BY 1),
    b AS (SELECT *, (vv * uy - uv * vy) / (uu * vv - uv * uv) AS a11, (uu * vy - uv * uy) / (uu * vv - uv * uv) AS a12,
        (vv * ux - uv * vx) / (uu * vv - uv * uv) AS a21, (uu * vx - uv * ux) / (uu * vv - uv * uv) AS a22 FROM s),
    e AS (SELECT *, my - a11 * mu - a12 * mv AS c1, mx - a21 * mu - a22 * mv AS c2, (yy - a11 * uy - a12 * vy) * n / (n - 3) AS s11,
        (yx - a11 * ux - a12 * vx) * n / (n - 3) AS s12, (xx - a21 * ux - a22 * vx) * n / (n - 3) AS s22 FROM b)"""


def _one_lag(t):
    return V.var_fit(_pairs(t), ["sales", "lines"], ["store_id"], max_lags=1, difference=False)


@query("var_coefficients_one_lag", f"""
    WITH {_TWO} SELECT store_id, equation, term, round(value, 6) AS coefficient FROM e, LATERAL (VALUES
      ('sales', 'const', c1), ('sales', 'L1.sales', a11), ('sales', 'L1.lines', a12),
      ('lines', 'const', c2), ('lines', 'L1.sales', a21), ('lines', 'L1.lines', a22)) AS q(equation, term, value)""")
def _(t):
    return r6(V.var_coefficients(_one_lag(t), ["sales", "lines"], ["store_id"]))


@query("var_forecast_one_lag", f"""
    WITH RECURSIVE {_TWO.strip()},
    o AS (SELECT e.*, z.date, z.y AS ly, z.x AS lx FROM e JOIN z USING (store_id)
      WHERE z.date = (SELECT max(i.date) FROM z i WHERE i.store_id = z.store_id)),
    r(store_id, i, f1, f2, p11, p12, p21, p22, v1, v2) AS (
      SELECT store_id, 1, c1 + a11 * ly + a12 * lx, c2 + a21 * ly + a22 * lx, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE),
        CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), s11, s22 FROM o
      UNION ALL SELECT store_id, i + 1, c1 + a11 * f1 + a12 * f2, c2 + a21 * f1 + a22 * f2, q11, q12, q21, q22,
        v1 + q11 * q11 * s11 + 2 * q11 * q12 * s12 + q12 * q12 * s22, v2 + q21 * q21 * s11 + 2 * q21 * q22 * s12 + q22 * q22 * s22
      FROM (SELECT r.*, o.* EXCLUDE (store_id), a11 * p11 + a12 * p21 AS q11, a11 * p12 + a12 * p22 AS q12,
        a21 * p11 + a22 * p21 AS q21, a21 * p12 + a22 * p22 AS q22 FROM r JOIN o USING (store_id) WHERE i < 30))
    SELECT store_id, date + CAST(i AS INTEGER) AS ds, variable, round(f, 6) AS yhat, round(f - {NormalDist().inv_cdf(0.975)!r} * sqrt(v), 6) AS yhat_lower,
      round(f + {NormalDist().inv_cdf(0.975)!r} * sqrt(v), 6) AS yhat_upper, 'ok' AS status, CAST(NULL AS VARCHAR) AS error
    FROM r JOIN o USING (store_id), LATERAL (VALUES ('sales', f1, v1), ('lines', f2, v2)) AS q(variable, f, v)""")
def _(t):
    return r6(V.var_forecast(_one_lag(t), ["sales", "lines"], ["store_id"]))


@query("granger_one_lag", f"""
    WITH {_TWO} SELECT store_id, round((yy - uy * uy / uu - (yy - a11 * uy - a12 * vy)) * (n - 3) / (yy - a11 * uy - a12 * vy), 6) AS f_statistic,
      1 AS df_num, CAST(n - 3 AS INTEGER) AS df_den FROM b""")
def _(t):
    return r6(V.granger(_pairs(t), "lines", "sales", ["store_id"], 1).drop("p_value", "is_cause"))


# Streams -----------------------------------------------------------------

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(t):
    return S.stream_parquet(t.spark, t.path, EVENTS, "events.parquet")


def _drained(t, stream, name):
    out, state = io.scratch_path(t.spark, name), io.scratch_path(t.spark, name + "-state")
    S.run_to_parquet(stream, out, state)
    return t.spark.read.schema(stream.schema).parquet(out)


@query("stream_decode", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(NULL AS VARCHAR) AS _corrupt FROM events""")
def _(t):
    return io.decode_json(t.table("events"), "k int", "props", keep=["event_id"])


@query("stream_kafka_json", """
    SELECT event_type AS store_id, CAST(user_id AS VARCHAR) AS product_id, value AS sales FROM events""")
def _(t):
    # The connector's record layout (a binary value holding JSON), fed from the file source.
    record = F.struct(
        F.col("event_type").alias("store_id"), F.col("user_id").cast("string").alias("product_id"),
        F.col("ts").cast("timestamp").alias("timestamp"), F.col("value").alias("sales"))
    records = _stream(t).select(F.to_json(record).cast("binary").alias("value"))
    return _drained(t, io.decode_json(records), "decoded").select("store_id", "product_id", "sales")


@query("stream_daily_sales", """
    SELECT event_type AS store_id, CAST(ts AS DATE) AS date, round(sum(value), 6) AS sales FROM events
    GROUP BY 1, 2 HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def _(t):
    events = _stream(t).select(F.col("event_type").alias("store_id"), F.col("ts").alias("timestamp"), F.col("value").alias("sales"))
    return r6(_drained(t, S.daily_sales(events), "daily"))


@query("stream_dedupe", "SELECT DISTINCT event_id, value FROM events")
def _(t):
    events = _stream(t).select("event_id", F.col("ts").alias("timestamp"), "value")
    doubled = events.unionByName(events)
    return _drained(t, S.dedupe_events(doubled), "deduped").select("event_id", "value")


def _scored_events(t):
    """Additive models of daily event values per type, applied to every batch of new events by their own settings."""
    daily = S.daily_sales(t.stream_events).select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"))
    path = io.scratch_path(t.spark, "event-models")
    SC.write_models(AD.fit_additive(daily, ["store_id"]), path)
    models = SC.read_models(t.spark, path)

    def score(batch):
        return SC.score_batch(batch.withColumn("date", F.to_date("timestamp")), models, ["store_id"], 7, "date")

    events = _stream(t).select(F.col("event_type").alias("store_id"), F.col("ts").cast("timestamp").alias("timestamp"),
                               F.col("value").alias("sales"))
    out, state = io.scratch_path(t.spark, "scored"), io.scratch_path(t.spark, "scored-state")
    S.stream_score(events, score, out, state, trigger=None).awaitTermination()
    return t.spark.read.parquet(out)


@query("stream_score")
def _(t):
    return _scored_events(t).drop("processing_time")


def _arrivals(t):
    """The events as a folder of files that a stream takes one by one: five days each, a fifth of the rows a day late."""
    late = F.when(F.col("event_id") % 5 == 0, 1).otherwise(0)
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    events = t.table("events").withColumn("part", F.floor((day + late) / 5))
    folder = io.scratch_path(t.spark, "arrivals")
    for row in events.select("part").distinct().orderBy("part").collect():
        part = events.where(F.col("part") == row["part"]).drop("part").repartition(1)
        io.write_parquet(part, f"{folder}/{row['part']}")
    reader = t.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
    return reader.parquet(folder)


def _event_series(events):
    named = events.select("event_id", F.col("event_type").alias("store_id"), F.col("ts").alias("timestamp"), F.col("value").alias("sales"))
    return series_features(named, ["store_id"], ties=["event_id"], lags=(1, 7), windows=(7,), functions=("mean", "max", "std"), lateness="2 days")


_EVENT_SERIES = """
    SELECT event_id, event_type AS store_id, ts, value AS sales, lag(value, 1) OVER w AS sales_lag_1, lag(value, 7) OVER w AS sales_lag_7,
      round(avg(value) OVER r, 6) AS sales_rolling_7_mean, max(value) OVER r AS sales_rolling_7_max,
      round(stddev_samp(value) OVER r, 6) AS sales_rolling_7_std
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
      r AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"""


@query("stream_series_features", f"""
    SELECT * EXCLUDE (ts) FROM ({_EVENT_SERIES}) WHERE ts <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)""")
def _(t):
    out, state = io.scratch_path(t.spark, "series"), io.scratch_path(t.spark, "series-state")
    stream = _event_series(_arrivals(t))
    S.run_to_parquet(stream, out, state)
    return r6(t.spark.read.schema(stream.schema).parquet(out).drop("timestamp"), "sales_rolling_7_mean", "sales_rolling_7_std")


@query("stream_score_series", f"""
    WITH f AS ({_EVENT_SERIES}),
      m AS (SELECT store_id, regr_slope(sales, sales_lag_1) AS slope, regr_intercept(sales, sales_lag_1) AS intercept FROM f GROUP BY 1)
    SELECT event_id, store_id, sales, round(intercept + slope * sales_lag_1, 6) AS yhat FROM f JOIN m USING (store_id)
    WHERE ts <= (SELECT max(ts) - INTERVAL 2 DAY FROM events)""")
def _(t):
    past = _event_series(t.table("events"))
    models = past.groupBy("store_id").agg(
        F.regr_slope("sales", "sales_lag_1").alias("slope"), F.regr_intercept("sales", "sales_lag_1").alias("intercept"))
    models = io.settle(models, "event-slopes")

    def score(batch):
        yhat = F.col("intercept") + F.col("slope") * F.col("sales_lag_1")
        return batch.join(models, "store_id").select("event_id", "store_id", "sales", yhat.alias("yhat"))

    out, state = io.scratch_path(t.spark, "series-scored"), io.scratch_path(t.spark, "series-scored-state")
    S.stream_score(_event_series(_arrivals(t)), score, out, state, trigger=None).awaitTermination()
    return r6(t.spark.read.parquet(out).select("event_id", "store_id", "sales", "yhat"), "yhat")


@query("sink_stream_parquet", """
    SELECT event_type AS store_id, count(*) AS events FROM events GROUP BY 1""")
def _(t):
    events = _stream(t).select(F.col("event_type").alias("store_id"))
    out, state = io.scratch_path(t.spark, "batches"), io.scratch_path(t.spark, "batches-state")
    S.stream_score(events, lambda b: b, out, state, trigger=None).awaitTermination()
    # The same checkpoint again: nothing new arrives, nothing is written twice.
    S.stream_score(events, lambda b: b, out, state, trigger=None).awaitTermination()
    return t.spark.read.parquet(out).groupBy("store_id").agg(F.count(F.lit(1)).alias("events"))
