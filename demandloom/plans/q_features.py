"""Queries: calendar features, window features, dimension and external joins."""

from pyspark.sql import functions as F

from demandloom.functions.exprs import slug
from demandloom.operators import aggregate as A
from demandloom.operators import dims as D
from demandloom.operators import external as X
from demandloom.operators import features_time as FT
from demandloom.operators import windows as WN
from demandloom.plans.registry import query, r6
from demandloom.sources.retail import CATEGORIES, PROMOTION_TYPES, REGIONS, STORE_TYPES

KEYS = ["store_id", "product_id"]
SERIES = "PARTITION BY store_id, product_id ORDER BY date"
STORE = "PARTITION BY store_id ORDER BY date"


def _last(n: int, series: str = SERIES) -> str:
    return f"({series} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


# Calendar ----------------------------------------------------------------

_PARTS = """CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(dayofyear(date) AS INTEGER) AS day_of_year,
  CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter, CAST(year(date) AS INTEGER) AS year,
  CAST(weekofyear(date) AS INTEGER) AS week_of_year, CAST(isodow(date) > 5 AS INTEGER) AS is_weekend,
  CAST(date = last_day(date) AS INTEGER) AS is_month_end, CAST(day(date) = 1 AS INTEGER) AS is_month_start,
  CAST(date = last_day(date) AND month(date) % 3 = 0 AS INTEGER) AS is_quarter_end,
  CAST(day(date) = 1 AND month(date) % 3 = 1 AS INTEGER) AS is_quarter_start,
  CAST(date = last_day(date) AND month(date) = 12 AS INTEGER) AS is_year_end,
  CAST(day(date) = 1 AND month(date) = 1 AS INTEGER) AS is_year_start"""


def _cyclic(*parts: tuple[str, str, int]) -> str:
    return ", ".join(
        f"round({fn}(2 * pi() * {expr} / {period}), 6) AS {name}_{fn}" for name, expr, period in parts for fn in ("sin", "cos")
    )


_DOW, _MONTH, _DOY, _DAY = "(isodow(date) - 1)", "month(date)", "dayofyear(date)", "day(date)"


@query("time_features", f"""
    SELECT date, store_id, product_id, sales, {_PARTS}, CAST(day(date) AS INTEGER) AS day_of_month,
      {_cyclic(("day_of_week", _DOW, 7), ("month", _MONTH, 12), ("day_of_year", _DOY, 365))} FROM v_sales""")
def _(t):
    return r6(FT.time_features(t.sales.drop("revenue", "price")))


@query("date_features_wide", f"""
    SELECT store_id, sales, {_PARTS}, CAST(day(date) AS INTEGER) AS day,
      {_cyclic(("month", _MONTH, 12), ("day", _DAY, 31), ("day_of_week", _DOW, 7), ("day_of_year", _DOY, 366))}
    FROM v_store_days""")
def _(t):
    return r6(FT.date_features_wide(t.store_days, drop_date=True))


@query("time_features_spark", f"""
    SELECT date, store_id, sales, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
      CAST(day(date) AS INTEGER) AS day, CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week,
      CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(weekofyear(date) AS INTEGER) AS week_of_year,
      CAST(quarter(date) AS INTEGER) AS quarter, CAST(dayofweek(date) IN (0, 6) AS INTEGER) AS is_weekend,
      CAST(day(date) = 1 AS INTEGER) AS is_month_start, CAST(date = last_day(date) AS INTEGER) AS is_month_end,
      {_cyclic(("month", _MONTH, 12), ("day_of_week", "(dayofweek(date) + 1)", 7))} FROM v_store_days""")
def _(t):
    return r6(FT.time_features_sunday1(t.store_days))


@query("gbt_date_features", """
    SELECT date, store_id, sales, CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, CAST(day(date) AS INTEGER) AS day_of_month,
      CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year FROM v_store_days""")
def _(t):
    return FT.gbt_date_features(t.store_days)


@query("weekday_month_names", "SELECT date, store_id, sales, dayname(date) AS day_name, monthname(date) AS month_name FROM v_store_days")
def _(t):
    return FT.weekday_month_names(t.store_days)


@query("scalar_functions", """
    SELECT o_orderkey, replace(lower(o_orderpriority), ' ', '_') AS flag_name, contains(o_orderpriority, 'URGENT') AS urgent,
      concat_ws('_', CAST(o_custkey AS VARCHAR), o_orderstatus) AS group_id, strftime(o_orderdate, '%Y-%m-%d') AS day,
      round(ln(1 + o_totalprice), 6) AS log1p_price, round(exp(o_totalprice / 1000000) - 1, 6) AS expm1_price,
      round(sqrt(o_totalprice), 6) AS sqrt_price, round(power(o_totalprice / 1000000, 2), 6) AS pow_price,
      abs(o_totalprice - 200000) AS abs_price, CAST(floor(o_totalprice) AS BIGINT) AS floor_price FROM orders""")
def _(t):
    from demandloom.functions.exprs import slug_column

    p = F.col("o_totalprice")
    return t.table("orders").select(
        "o_orderkey",
        slug_column(F.col("o_orderpriority")).alias("flag_name"),
        F.contains("o_orderpriority", F.lit("URGENT")).alias("urgent"),
        F.concat_ws("_", F.col("o_custkey").cast("string"), "o_orderstatus").alias("group_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.round(F.log1p(p), 6).alias("log1p_price"),
        F.round(F.expm1(p / 1000000), 6).alias("expm1_price"),
        F.round(F.sqrt(p), 6).alias("sqrt_price"),
        F.round(F.pow(p / 1000000, F.lit(2)), 6).alias("pow_price"),
        F.abs(p - 200000).alias("abs_price"),
        F.floor(p).alias("floor_price"),
    )


# Windows -----------------------------------------------------------------

@query("lags", "SELECT date, store_id, product_id, sales, "
       + ", ".join(f"lag(sales, {k}) OVER ({SERIES}) AS sales_lag_{k}" for k in (1, 7, 14, 30)) + " FROM v_sales")
def _(t):
    return WN.lags(t.sales.drop("revenue", "price"), "sales", keys=KEYS)


_FN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max", "median": "median", "sum": "sum"}


def _rolled(full: bool, windows, functions) -> str:
    cols = []
    for w in windows:
        for f in functions:
            value = f"{_FN[f]}(sales) OVER {_last(w)}"
            if full:
                value = f"CASE WHEN count(sales) OVER {_last(w)} = {w} THEN {value} END"
            cols.append(f"round({value}, 6) AS sales_rolling_{w}_{f}")
    return f"SELECT date, store_id, product_id, sales, {', '.join(cols)} FROM v_gappy"


@query("rolling", _rolled(False, (7, 14, 30), ("mean", "std", "min", "max", "sum", "median")))
def _(t):
    return r6(WN.rolling(t.gappy, "sales", (7, 14, 30), ("mean", "std", "min", "max", "sum", "median"), KEYS))


@query("rolling_full", _rolled(True, (7, 14, 30), ("mean", "std", "min", "max", "median", "sum")))
def _(t):
    return r6(WN.rolling(t.gappy, "sales", (7, 14, 30), ("mean", "std", "min", "max", "median", "sum"), KEYS, full=True))


@query("rolling_spark", _rolled(True, (7, 14, 28), ("mean", "std", "min", "max")).replace("v_gappy", "v_sales"))
def _(t):
    return r6(WN.rolling(t.sales.drop("revenue", "price"), "sales", (7, 14, 28), keys=KEYS, full=True))


_SO_FAR = f"({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("expanding", "SELECT date, store_id, product_id, sales, "
       + ", ".join(f"round({_FN[f]}(sales) OVER {_SO_FAR}, 6) AS sales_expanding_{f}" for f in _FN) + " FROM v_gappy")
def _(t):
    return r6(WN.expanding(t.gappy, "sales", tuple(_FN), KEYS))


@query("diffs", "SELECT date, store_id, product_id, sales, "
       + ", ".join(f"sales - lag(sales, {k}) OVER ({SERIES}) AS sales_diff_{k}" for k in (1, 7, 30)) + " FROM v_sales")
def _(t):
    return WN.diffs(t.sales.drop("revenue", "price"), "sales", keys=KEYS)


_VELOCITY = f"""
    d AS (SELECT date, store_id, product_id, sales, sales - lag(sales, 1) OVER ({SERIES}) AS d FROM v_sales),
    v AS (SELECT *, CASE WHEN count(d) OVER {_last(7)} = 7 THEN avg(d) OVER {_last(7)} END AS sales_velocity_7d,
      CASE WHEN count(d) OVER {_last(30)} = 30 THEN avg(d) OVER {_last(30)} END AS sales_velocity_30d FROM d)"""


@query("velocity", f"""
    WITH {_VELOCITY} SELECT date, store_id, product_id, sales, sales_velocity_7d, sales_velocity_30d,
      sales_velocity_7d - lag(sales_velocity_7d, 1) OVER ({SERIES}) AS sales_accel_7d FROM v""")
def _(t):
    return WN.velocity(t.sales.drop("revenue", "price"), "sales", KEYS)


def _ewm(span: int, k: str = "k") -> str:
    b = 1 - 2 / (span + 1)
    return (f"sum(sales * power({b!r}, -{k})) OVER {_SO_FAR} / "
            f"sum(CASE WHEN sales IS NOT NULL THEN power({b!r}, -{k}) END) OVER {_SO_FAR}")


@query("ewm", f"""
    WITH n AS (SELECT *, row_number() OVER ({SERIES}) AS k FROM v_gappy)
    SELECT date, store_id, product_id, sales, round({_ewm(7)}, 6) AS sales_ewm_7, round({_ewm(30)}, 6) AS sales_ewm_30 FROM n""")
def _(t):
    return r6(WN.ewm_mean(t.gappy, "sales", (7, 30), KEYS))


# The whole table as one series, in blocks.
_TABLE = "ORDER BY date, store_id, product_id"


@query("lags_whole_table", "SELECT date, store_id, product_id, sales, "
       + ", ".join(f"lag(sales, {k}) OVER ({_TABLE}) AS sales_lag_{k}" for k in (1, 7, 14, 30)) + " FROM v_sales")
def _(t):
    return WN.lags(t.sales.drop("revenue", "price"), "sales", order=["date", *KEYS])


@query("rolling_whole_table", _rolled(False, (7, 30), ("mean", "std", "min", "max", "median")).replace(SERIES, _TABLE))
def _(t):
    return r6(WN.rolling(t.gappy, "sales", (7, 30), ("mean", "std", "min", "max", "median"), order=["date", *KEYS]))


@query("ewm_whole_table", f"""
    WITH n AS MATERIALIZED (SELECT *, row_number() OVER ({_TABLE}) AS k FROM v_gappy),
      w AS (SELECT j, power(CAST(0.75 AS DOUBLE), j) AS d FROM range(200) AS t(j)),
      e AS (SELECT a.k, sum(b.sales * d) / sum(d) AS m FROM n a JOIN w ON a.sales IS NOT NULL
        JOIN n b ON b.k = a.k - j AND b.sales IS NOT NULL GROUP BY a.k)
    SELECT date, store_id, product_id, sales, round(last_value(m IGNORE NULLS) OVER ({_TABLE}
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS sales_ewm_7 FROM n LEFT JOIN e USING (k)""")
def _(t):
    return r6(WN.ewm_mean(t.gappy, "sales", (7,), order=["date", *KEYS]))


_WHOLE = "PARTITION BY store_id, product_id"


@query("group_zscore", """
    SELECT date, store_id, product_id, sales, round((sales - m) / nullif(s, 0), 6) AS zscore
    FROM v_sales JOIN (SELECT store_id, product_id, avg(sales) AS m, stddev_samp(sales) AS s FROM v_sales GROUP BY 1, 2)
      USING (store_id, product_id)""")
def _(t):
    return r6(WN.group_scaled(t.sales.drop("revenue", "price"), "sales", KEYS, ("zscore", None)), "zscore")


@query("group_minmax", """
    SELECT date, store_id, product_id, sales, (sales - lo) / nullif(hi - lo, 0) AS normalized
    FROM v_sales JOIN (SELECT store_id, product_id, min(sales) AS lo, max(sales) AS hi FROM v_sales GROUP BY 1, 2)
      USING (store_id, product_id)""")
def _(t):
    return WN.group_scaled(t.sales.drop("revenue", "price"), "sales", KEYS, (None, "normalized"))


_RANK = f"""CASE WHEN sales IS NOT NULL THEN (rank() OVER ({_WHOLE} ORDER BY sales NULLS LAST)
      + (count(*) OVER ({_WHOLE}, sales) - 1) / 2.0) / count(sales) OVER ({_WHOLE}) END"""


@query("pct_rank_avg", f"SELECT date, store_id, product_id, sales, {_RANK} AS percentile FROM v_gappy")
def _(t):
    return WN.pct_rank_avg(t.gappy, "sales", KEYS)


@query("lagged_roll_mean", f"""
    SELECT store_id, date, sales, CASE WHEN count(sales) OVER w = 7 THEN avg(sales) OVER w END AS sales_lag_7d_avg
    FROM v_store_days WINDOW w AS ({STORE} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""")
def _(t):
    return WN.lagged_roll_mean(t.store_days, "sales", 7, ["store_id"])


@query("sales_velocity_features", f"""
    WITH {_VELOCITY}, n AS (SELECT *, row_number() OVER ({SERIES}) AS k FROM v),
      m AS (SELECT *, {_ewm(7)} AS m7, {_ewm(30)} AS m30 FROM n)
    SELECT date, store_id, product_id, sales, d AS sales_diff_1d, sales - lag(sales, 7) OVER ({SERIES}) AS sales_diff_7d,
      sales - lag(sales, 30) OVER ({SERIES}) AS sales_diff_30d, round(sales_velocity_7d, 6) AS sales_velocity_7d,
      round(sales_velocity_30d, 6) AS sales_velocity_30d,
      round(sales_velocity_7d - lag(sales_velocity_7d, 1) OVER ({SERIES}), 6) AS sales_accel_7d,
      round(m7, 6) AS sales_momentum_7d, round(m30, 6) AS sales_momentum_30d, round(m7 / nullif(m30, 0), 6) AS sales_trend,
      round((sales - avg(sales) OVER ({_WHOLE})) / nullif(stddev_samp(sales) OVER ({_WHOLE}), 0), 6) AS sales_zscore,
      round((sales - min(sales) OVER ({_WHOLE})) / nullif(max(sales) OVER ({_WHOLE}) - min(sales) OVER ({_WHOLE}), 0), 6)
        AS sales_normalized, round({_RANK}, 6) AS sales_percentile FROM m""")
def _(t):
    return r6(WN.sales_velocity_features(t.sales.drop("revenue", "price")))


# Dimension joins ---------------------------------------------------------

@query("join_dims", """
    SELECT f.store_id, f.product_id, f.date, f.sales, f.revenue, s.store_name, s.region, s.store_type, s.size_sqft,
      s.opening_date, s.is_active, p.product_name, p.category, p.price, p.cost, p.lead_time_days
    FROM v_sales f JOIN v_stores s USING (store_id) JOIN v_products p USING (product_id)""")
def _(t):
    return D.join_dims(t.sales.drop("price"), t.stores, t.products)


def _hot(column: str, values) -> str:
    return ", ".join(f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{column}_{v}\"" for v in values)


@query("store_features", f"""
    WITH j AS (SELECT f.store_id, f.date, f.sales, s.* EXCLUDE (store_id), CAST(f.date - s.opening_date AS INTEGER) AS store_age_days
      FROM v_store_days f LEFT JOIN v_stores s USING (store_id))
    SELECT *, CASE WHEN store_age_days <= -1 THEN NULL WHEN store_age_days <= 30 THEN 'new' WHEN store_age_days <= 90 THEN '1-3m'
        WHEN store_age_days <= 365 THEN '3-12m' WHEN store_age_days <= 730 THEN '1-2y' WHEN store_age_days <= 1825 THEN '2-5y'
        WHEN store_age_days <= 3650 THEN '5-10y' WHEN store_age_days <= 999999 THEN '10y+' END AS store_age_bin,
      CASE WHEN size_sqft <= 2000 THEN 'tiny' WHEN size_sqft <= 5000 THEN 'small' WHEN size_sqft <= 10000 THEN 'medium'
        WHEN size_sqft <= 20000 THEN 'large' WHEN size_sqft <= 50000 THEN 'xlarge' ELSE 'mega' END AS store_size_bin,
      {_hot("store_type", STORE_TYPES)}, {_hot("region", REGIONS)} FROM j""")
def _(t):
    return D.store_features(t.store_days, t.stores, values={"store_type": STORE_TYPES, "region": REGIONS})


@query("product_features", f"""
    SELECT f.date, f.store_id, f.product_id, f.sales, p.* EXCLUDE (product_id), p.price - p.cost AS margin,
      (p.price - p.cost) / nullif(p.price, 0) AS margin_ratio,
      CASE WHEN p.price <= -1 THEN NULL WHEN p.price <= 5 THEN 'budget' WHEN p.price <= 10 THEN 'low'
        WHEN p.price <= 25 THEN 'medium' WHEN p.price <= 50 THEN 'high' WHEN p.price <= 100 THEN 'premium' ELSE 'luxury' END
        AS price_bin, {_hot("category", CATEGORIES)}
    FROM v_sales f LEFT JOIN v_products p USING (product_id)""")
def _(t):
    return D.product_features(t.sales.drop("revenue"), t.products, values={"category": CATEGORIES})


@query("inventory_features", f"""
    WITH j AS (SELECT f.date, f.store_id, f.product_id, f.sales, i.current_stock, i.safety_stock, i.reorder_point,
        avg(sales) OVER ({_WHOLE}) AS m, CASE WHEN count(sales) OVER {_last(7)} = 7 THEN sum(sales) OVER {_last(7)} END AS week
      FROM v_sales f LEFT JOIN v_inventory i USING (store_id, product_id)),
    k AS (SELECT * EXCLUDE (m, week), current_stock / nullif(m, 0) AS days_of_supply,
        CAST(current_stock AS DOUBLE) / nullif(safety_stock, 0) AS stock_to_safety_ratio,
        CAST(current_stock AS DOUBLE) / nullif(reorder_point, 0) AS stock_to_reorder_ratio,
        CAST(current_stock < reorder_point AS INTEGER) AS below_reorder_point,
        current_stock / nullif(week, 0) AS stock_to_weekly_sales_ratio FROM j)
    SELECT *, CASE WHEN days_of_supply <= -1 THEN NULL WHEN days_of_supply <= 3 THEN 'critical' WHEN days_of_supply <= 7 THEN 'low'
        WHEN days_of_supply <= 14 THEN 'medium' WHEN days_of_supply <= 30 THEN 'adequate' WHEN days_of_supply <= 60 THEN 'high'
        WHEN days_of_supply <= 999999 THEN 'excess' END AS supply_bin FROM k""")
def _(t):
    return D.inventory_features(t.sales.drop("revenue", "price"), t.inventory)


@query("cross_product_features", """
    WITH f AS (SELECT date, store_id, product_id, sales, category FROM v_sales JOIN (SELECT product_id, category FROM v_products) p
        USING (product_id)),
      w AS (SELECT *, sum(sales) OVER (PARTITION BY date, store_id, category) AS category_sales,
        sum(sales) OVER (PARTITION BY date, store_id) AS store_sales FROM f)
    SELECT *, sales / nullif(category_sales, 0) AS category_sales_share, category_sales - sales AS category_sales_others,
      sales / nullif(store_sales, 0) AS store_sales_share, store_sales - sales AS store_sales_others FROM w""")
def _(t):
    facts = t.sales.drop("revenue", "price").join(t.products.select("product_id", "category"), "product_id")
    return D.cross_product_features(facts)


# External joins ----------------------------------------------------------

@query("weather_features", f"""
    WITH d AS (SELECT DISTINCT store_id, date FROM v_sales), w AS (SELECT store_id, date, temperature, precipitation,
        lag(temperature) OVER s AS temperature_lag1, lag(precipitation) OVER s AS precipitation_lag1,
        CASE WHEN count(temperature) OVER p = 7 THEN avg(temperature) OVER p END AS temperature_lag_7d_avg,
        CASE WHEN count(precipitation) OVER p = 7 THEN avg(precipitation) OVER p END AS precipitation_lag_7d_avg,
        temperature - lag(temperature) OVER s AS temp_change, precipitation - lag(precipitation) OVER s AS precip_change,
        round(CASE WHEN count(temperature) OVER c = 7 THEN stddev_samp(temperature) OVER c END, 6) AS temp_volatility,
        CASE WHEN temperature <= -100 THEN NULL WHEN temperature <= 0 THEN 'freezing' WHEN temperature <= 10 THEN 'cold'
          WHEN temperature <= 20 THEN 'mild' WHEN temperature <= 30 THEN 'warm' WHEN temperature <= 100 THEN 'hot' END AS temp_bin,
        CASE WHEN precipitation <= -1 THEN NULL WHEN precipitation <= 0 THEN 'none' WHEN precipitation <= 5 THEN 'light'
          WHEN precipitation <= 10 THEN 'moderate' WHEN precipitation <= 20 THEN 'heavy' WHEN precipitation <= 100 THEN 'extreme'
          END AS precip_bin,
        CAST(temperature > 30 AS INTEGER) AS is_extreme_hot, CAST(temperature < 0 AS INTEGER) AS is_extreme_cold,
        CAST(precipitation > 10 AS INTEGER) AS is_heavy_rain
      FROM d LEFT JOIN v_weather USING (date)
      WINDOW s AS ({STORE}), p AS ({STORE} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING),
        c AS ({STORE} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
    SELECT f.product_id, f.sales, w.* FROM v_sales f LEFT JOIN w ON f.store_id = w.store_id AND f.date = w.date""")
def _(t):
    return r6(X.weather_features(t.sales.drop("revenue", "price"), t.weather), "temp_volatility")


@query("join_weather", """
    WITH w AS (SELECT date, temperature, precipitation FROM v_weather),
      d AS (SELECT date, precipitation, coalesce(
          last_value(temperature IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          first_value(temperature IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
          AS temperature_weather FROM (SELECT DISTINCT date FROM v_store_days) LEFT JOIN w USING (date))
    SELECT store_id, date, sales, CAST(0 AS DOUBLE) AS temperature, precipitation, temperature_weather
    FROM v_store_days LEFT JOIN d USING (date)""")
def _(t):
    facts = t.store_days.withColumn("temperature", F.lit(0.0))
    return X.join_weather(facts, t.weather)


def _economic(c: str) -> str:
    cols = []
    for tag, change, days in (("lag1m", "mom", 30), ("lag1y", "yoy", 365)):
        before = f"lag({c}, {days}) OVER (ORDER BY date)"
        cols.append(f"{before} AS {c}_{tag}, {c} - {before} AS {c}_{change}_change, "
                    f"({c} - {before}) / nullif({before}, 0) AS {c}_{change}_pct_change")
    return ", ".join(cols)


@query("economic_features", f"""
    WITH d AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_economy),
      e AS (SELECT date, last_value(consumer_confidence_index IGNORE NULLS) OVER o AS consumer_confidence_index,
          last_value(unemployment_rate IGNORE NULLS) OVER o AS unemployment_rate FROM d LEFT JOIN v_economy USING (date)
        WINDOW o AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
      g AS (SELECT *, {_economic("consumer_confidence_index")}, {_economic("unemployment_rate")} FROM e),
      j AS (SELECT f.store_id, f.sales, f.date, g.* EXCLUDE (date) FROM v_store_days f LEFT JOIN g ON f.date = g.date)
    SELECT *, round((consumer_confidence_index - (SELECT avg(consumer_confidence_index) FROM j))
        / (SELECT stddev_pop(consumer_confidence_index) FROM j) - (unemployment_rate - (SELECT avg(unemployment_rate) FROM j))
        / (SELECT stddev_pop(unemployment_rate) FROM j), 6) AS economic_health FROM j""")
def _(t):
    return r6(X.economic_features(t.store_days, t.economy), "economic_health")


@query("join_economic_asof", """
    SELECT f.store_id, f.date, f.sales, e.consumer_confidence_index, e.unemployment_rate
    FROM v_store_days f ASOF LEFT JOIN v_economy e ON f.date >= e.date""")
def _(t):
    return X.join_economic_asof(t.store_days, t.economy)


@query("join_external", """
    SELECT f.store_id, f.date, f.sales, w.temperature, w.precipitation, s.retail_trend, c.sales AS sales_late,
      e.consumer_confidence_index, e.unemployment_rate
    FROM v_store_days f LEFT JOIN v_weather w USING (date) LEFT JOIN v_social s USING (date)
      LEFT JOIN (SELECT date, sum(sales) AS sales FROM v_store_days GROUP BY 1) c USING (date)
      LEFT JOIN v_economy e USING (date)""")
def _(t):
    named = {"weather": t.weather, "social": t.social, "late": A.daily_totals(t.store_days)}
    return X.join_external(X.join_external(t.store_days, named), (t.economy,))


@query("join_external_fill", f"""
    WITH d AS (SELECT date, last_value(retail_trend IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        AS retail_trend FROM (SELECT DISTINCT date FROM v_gappy) LEFT JOIN v_social USING (date))
    SELECT store_id, product_id, date, retail_trend,
      last_value(sales IGNORE NULLS) OVER ({SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sales
    FROM v_gappy JOIN d USING (date)""")
def _(t):
    return X.join_external_fill(t.gappy, t.social, KEYS)


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("event_flags", "SELECT f.store_id, f.date, f.sales, "
       + ", ".join(f"CAST(f.date IN (SELECT event_date FROM v_dated_events WHERE event_type = '{p}') AS INTEGER) "
                   f'AS "is_{slug(p)}"' for p in _PRIORITIES) + " FROM v_store_days f")
def _(t):
    return X.event_flags(t.store_days, t.dated_events, types=_PRIORITIES)


_PROMO_FLAGS = ", ".join(
    f"max(CAST(promotion_type = '{p}' AS INTEGER)) AS is_{slug(p)}" for p in PROMOTION_TYPES)


@query("promotion_features", f"""
    WITH m AS (SELECT f.date, f.product_id, max(promo_seq) AS seq, {_PROMO_FLAGS}
        FROM (SELECT DISTINCT date, product_id FROM v_sales) f JOIN v_promotions p
          ON f.product_id = p.product_id AND f.date BETWEEN p.start_date AND p.end_date GROUP BY 1, 2),
      n AS (SELECT f.date, count(*) AS promo_count FROM (SELECT DISTINCT date FROM v_sales) f
        JOIN v_promotions p ON f.date BETWEEN p.start_date AND p.end_date GROUP BY 1)
    SELECT f.date, f.store_id, f.product_id, f.sales, CAST(m.seq IS NOT NULL AS INTEGER) AS is_promotion,
      coalesce(p.discount_rate, 0) AS discount_rate, CAST(coalesce(f.date - p.start_date, 0) AS INTEGER) AS days_into_promotion,
      CAST(coalesce(p.end_date - f.date, 0) AS INTEGER) AS days_to_promotion_end,
      {", ".join(f"coalesce(is_{slug(p)}, 0) AS is_{slug(p)}" for p in PROMOTION_TYPES)},
      CAST(coalesce(promo_count, 0) AS INTEGER) AS promo_count
    FROM v_sales f LEFT JOIN m ON f.date = m.date AND f.product_id = m.product_id
      LEFT JOIN v_promotions p ON p.promo_seq = m.seq LEFT JOIN n ON f.date = n.date""")
def _(t):
    return X.promotion_features(t.sales.drop("revenue", "price"), t.promotions, types=PROMOTION_TYPES)


@query("promo_count", """
    SELECT f.store_id, f.date, f.sales, CAST(coalesce(n, 0) AS INTEGER) AS promo_count FROM v_store_days f LEFT JOIN
      (SELECT d.date, count(*) AS n FROM v_dates d JOIN v_promotions p ON d.date BETWEEN p.start_date AND p.end_date GROUP BY 1)
      USING (date)""")
def _(t):
    return X.promo_count(t.store_days, t.promotions)


_NEAR = """
    a AS (SELECT d.date, h.date AS before FROM v_dates d ASOF LEFT JOIN v_holidays h ON d.date > h.date),
    b AS (SELECT d.date, h.date AS after FROM v_dates d ASOF LEFT JOIN v_holidays h ON d.date < h.date),
    n AS (SELECT date, before, after, holiday_name FROM v_dates LEFT JOIN v_holidays USING (date)
      JOIN a USING (date) JOIN b USING (date))"""


def _major(words) -> str:
    tests = " OR ".join("contains(holiday_name, '%s')" % w.replace("'", "''") for w in words)
    return f"CAST(coalesce({tests}, false) AS INTEGER)"


@query("holiday_features", f"""
    WITH {_NEAR} SELECT store_id, date, sales, CAST(holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
      {_major(X.MAJOR_HOLIDAYS)} AS is_major_holiday,
      CAST(CASE WHEN holiday_name IS NOT NULL THEN 0 ELSE coalesce(after - date, 99) END AS INTEGER) AS days_to_holiday,
      CAST(CASE WHEN holiday_name IS NOT NULL THEN 0 ELSE coalesce(date - before, 99) END AS INTEGER) AS days_after_holiday,
      {", ".join(f"{_major([m])} AS is_{slug(m)}" for m in X.MAJOR_HOLIDAYS)} FROM v_store_days JOIN n USING (date)""")
def _(t):
    return X.holiday_features(t.store_days, t.holidays)


@query("holiday_name_features", f"""
    WITH {_NEAR} SELECT store_id, date, sales, holiday_name, CAST(holiday_name IS NOT NULL AS INTEGER) AS is_holiday,
      {_major(X.MAJOR_HOLIDAY_WORDS)} AS is_major_holiday,
      CAST(CASE WHEN holiday_name IS NOT NULL THEN 0 ELSE coalesce(after - date, 0) END AS INTEGER) AS days_before_holiday,
      CAST(CASE WHEN holiday_name IS NOT NULL THEN 0 ELSE coalesce(date - before, 0) END AS INTEGER) AS days_after_holiday
    FROM v_store_days JOIN n USING (date)""")
def _(t):
    return X.holiday_name_features(t.store_days, t.holidays)


@query("holiday_calendar", """
    SELECT date, holiday_name, is_major_holiday, 'US' AS country, CAST(NULL AS VARCHAR) AS state FROM v_holidays""")
def _(t):
    return X.holiday_calendar(t.dates)


@query("holiday_windows", """
    SELECT h.date + CAST(o AS INTEGER) AS ds, holiday_name AS holiday, CAST(o AS INTEGER) AS "offset"
    FROM v_holidays h, generate_series(-2, 2) AS g(o) WHERE is_major_holiday OR o = 0""")
def _(t):
    return X.holiday_days(X.holiday_windows(t.holidays))


@query("merge_all_external", f"""
    WITH e0 AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_store_days),
      e AS (SELECT date, last_value(consumer_confidence_index IGNORE NULLS) OVER o AS consumer_confidence_index,
          last_value(unemployment_rate IGNORE NULLS) OVER o AS unemployment_rate FROM e0 LEFT JOIN v_economy USING (date)
        WINDOW o AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
      s0 AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM v_social),
      s1 AS (SELECT date, retail_trend AS x, row_number() OVER (ORDER BY date) AS k FROM s0 LEFT JOIN v_social USING (date)),
      s2 AS (SELECT *, last_value(x IGNORE NULLS) OVER a AS pv, first_value(x IGNORE NULLS) OVER b AS nv,
          last_value(CASE WHEN x IS NOT NULL THEN k END IGNORE NULLS) OVER a AS pk,
          first_value(CASE WHEN x IS NOT NULL THEN k END IGNORE NULLS) OVER b AS nk FROM s1
        WINDOW a AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
          b AS (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
      s AS (SELECT date, CASE WHEN x IS NOT NULL THEN x ELSE pv + (nv - pv) * (CAST(k - pk AS DOUBLE) / (nk - pk)) END AS retail_trend FROM s2),
      c AS (SELECT date, avg(price_index) AS price_index FROM v_competitors GROUP BY 1),
      j AS (SELECT date, h.is_major_holiday, temperature, precipitation, consumer_confidence_index, unemployment_rate, retail_trend,
          price_index FROM (SELECT DISTINCT date FROM v_store_days) LEFT JOIN v_holidays h USING (date)
        LEFT JOIN v_weather USING (date)
        LEFT JOIN e USING (date) LEFT JOIN s USING (date) LEFT JOIN c USING (date)),
      k AS (SELECT date, CAST(is_major_holiday IS NOT NULL AS INTEGER) AS is_holiday,
          CAST(coalesce(is_major_holiday, false) AS INTEGER) AS is_major_holiday,
          last_value(temperature IGNORE NULLS) OVER w AS temperature, last_value(precipitation IGNORE NULLS) OVER w AS precipitation,
          last_value(consumer_confidence_index IGNORE NULLS) OVER w AS consumer_confidence_index,
          last_value(unemployment_rate IGNORE NULLS) OVER w AS unemployment_rate,
          round(last_value(retail_trend IGNORE NULLS) OVER w, 6) AS retail_trend,
          last_value(price_index IGNORE NULLS) OVER w AS price_index
        FROM j WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
    SELECT * FROM v_store_days LEFT JOIN k USING (date)""")
def _(t):
    out = X.merge_all_external(t.store_days, t.holidays, t.weather, t.economy, t.social, t.competitors)
    return r6(out, "retail_trend")


@query("join_actuals", """
    SELECT f.store_id, f.ds, f.naive7, s.sales AS y FROM v_forecasts f LEFT JOIN
      v_store_days s ON f.store_id = s.store_id AND f.ds = s.date""")
def _(t):
    history = t.store_days.select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"))
    return A.join_actuals(t.forecasts.select("store_id", "ds", "naive7"), history, ["store_id"])
