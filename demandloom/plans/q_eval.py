"""Queries: metrics, ensembles, intervals, inventory and costs."""

from statistics import NormalDist

from pyspark.sql import functions as F

from demandloom.functions import distributions as DI
from demandloom.operators import costs as K
from demandloom.operators import ensemble as E
from demandloom.operators import inventory as I
from demandloom.operators import metrics as M
from demandloom.plans.registry import query, r6
from demandloom.sources.retail import MODELS

Z95 = repr(NormalDist().inv_cdf(0.95))
Z975 = repr(NormalDist().inv_cdf(0.975))
STORE = "PARTITION BY store_id ORDER BY ds"


def _metrics(by: str) -> str:
    names = f"{by}, model" if by else "model"
    join = f"JOIN s USING ({by})" if by else ", s"
    group = f"GROUP BY {by}" if by else ""
    select = f"{by}, " if by else ""
    return f"""
    WITH step AS (SELECT store_id, abs(y - lag(y, 7) OVER ({STORE})) AS d FROM v_forecasts),
      s AS (SELECT {select}avg(d) AS scale FROM step {group}),
      m AS (SELECT {names}, avg(abs(yhat - y)) AS mae, sqrt(avg((yhat - y) * (yhat - y))) AS rmse,
        1 - sum((yhat - y) * (yhat - y)) / nullif(count(*) * var_pop(y), 0) AS r2, avg(yhat - y) AS bias,
        avg(CASE WHEN y <> 0 THEN abs((yhat - y) / y) END) * 100 AS mape,
        avg(CASE WHEN abs(y) + abs(yhat) <> 0 THEN abs(yhat - y) / ((abs(y) + abs(yhat)) / 2) END) * 100 AS smape,
        sum(abs(yhat - y)) / nullif(sum(abs(y)), 0) * 100 AS wmape
        FROM v_long WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY {names})
    SELECT {names}, round(mae, 6) AS mae, round(rmse, 6) AS rmse, round(r2, 6) AS r2, round(bias, 6) AS bias,
      round(mape, 6) AS mape, round(smape, 6) AS smape, round(wmape, 6) AS wmape, round(mae / nullif(scale, 0), 6) AS mase
    FROM m {join}"""


@query("metrics_all", _metrics("store_id"))
def _(t):
    return r6(M.metrics_all(t.forecasts, MODELS, ["store_id"], season=7))


@query("metrics_weighted", """
    SELECT store_id, model, round(sum(w * abs(yhat - y)) / nullif(sum(w), 0) * 100, 6) AS wmape FROM (
      SELECT *, CAST(month(ds) AS DOUBLE) AS w FROM v_long WHERE y IS NOT NULL AND yhat IS NOT NULL) GROUP BY 1, 2""")
def _(t):
    weighted = t.forecasts.withColumn("w", F.month("ds"))
    return r6(M.metrics_all(weighted, MODELS, ["store_id"], metrics=("wmape",), weight="w"))


@query("compare_models", _metrics(""))
def _(t):
    return r6(M.compare_models(t.forecasts, MODELS, ["store_id"], season=7))


_RMSE = "SELECT model, sqrt(avg((yhat - y) * (yhat - y))) AS rmse, avg(abs(yhat - y)) AS mae FROM v_long WHERE yhat IS NOT NULL GROUP BY 1"


@query("model_scores", f"SELECT model, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM ({_RMSE})")
def _(t):
    return r6(E.model_scores(t.forecasts, MODELS))


@query("best_model", f"""
    SELECT min_by(model, rmse) AS best_model, round(min(rmse), 6) AS best_rmse, round(max(rmse), 6) AS worst_rmse,
      round(1 - min(rmse) / max(rmse), 6) AS improvement FROM ({_RMSE})""")
def _(t):
    return r6(M.best_model(E.model_scores(t.forecasts, MODELS)))


_METRIC_ROWS = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, model, {m} AS value, row_number() OVER (ORDER BY {'-' if m == 'r2' else ''}{m}, model) AS rank FROM c"
    for m in M.METRICS)


@query("rank_models", f"""
    WITH c AS ({_metrics("")}) SELECT metric, model, value, CAST(rank AS INTEGER) AS rank FROM ({_METRIC_ROWS})""")
def _(t):
    return M.rank_models(r6(M.compare_models(t.forecasts, MODELS, ["store_id"], season=7)))


@query("ensemble_average", """
    SELECT store_id, ds, y, naive7, naive28, mean7, round((naive7 + naive28 + mean7) / 3, 6) AS ensemble FROM v_forecasts""")
def _(t):
    return r6(E.ensemble_average(t.forecasts, MODELS), "ensemble")


# Weights are fitted before 2000 and applied from 2000 on, so no scored row helped to choose them.
_WEIGHTS = f"""
    w AS (SELECT model, (1 / rmse) / (SELECT sum(1 / rmse) FROM r) AS weight FROM r)"""
_FIT = "r AS (SELECT model, sqrt(avg((yhat - y) * (yhat - y))) AS rmse FROM v_long WHERE yhat IS NOT NULL AND year(ds) < 2000 GROUP BY 1)"


@query("ensemble_weights", f"WITH {_FIT}, {_WEIGHTS} SELECT model, round(weight, 6) AS weight FROM w")
def _(t):
    return r6(E.ensemble_weights(t.forecasts.where(F.year("ds") < 2000), MODELS))


@query("ensemble_weighted", f"""
    WITH {_FIT}, {_WEIGHTS}, p AS (SELECT max(CASE WHEN model = 'naive7' THEN weight END) AS a,
      max(CASE WHEN model = 'naive28' THEN weight END) AS b, max(CASE WHEN model = 'mean7' THEN weight END) AS c FROM w)
    SELECT store_id, ds, y, naive7, naive28, mean7, round(a * naive7 + b * naive28 + c * mean7, 6) AS ensemble
    FROM v_forecasts, p WHERE year(ds) >= 2000""")
def _(t):
    weights = E.ensemble_weights(t.forecasts.where(F.year("ds") < 2000), MODELS)
    return r6(E.ensemble_weighted(t.forecasts.where(F.year("ds") >= 2000), MODELS, weights), "ensemble")


@query("ensemble_median", """
    SELECT store_id, ds, y, naive7, naive28, mean7, CASE WHEN naive7 IS NOT NULL AND naive28 IS NOT NULL AND mean7 IS NOT NULL
      THEN list_sort([naive7, naive28, mean7])[2] END AS ensemble FROM v_forecasts""")
def _(t):
    return E.ensemble_median(t.forecasts, MODELS)


@query("ensemble_evaluate", """
    WITH e AS (SELECT store_id, y, (naive7 + naive28 + mean7) / 3 AS p FROM v_forecasts)
    SELECT store_id, round(sqrt(avg((p - y) * (p - y))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae,
      round(1 - sum((p - y) * (p - y)) / nullif(count(*) * var_pop(y), 0), 6) AS r2,
      round(avg(CASE WHEN y <> 0 THEN abs((p - y) / y) END) * 100, 6) AS mape FROM e WHERE p IS NOT NULL GROUP BY 1""")
def _(t):
    return r6(E.ensemble_evaluate(E.ensemble_average(t.forecasts, MODELS), by=["store_id"]))


@query("prediction_interval", f"""
    SELECT store_id, ds, round(avg(yhat), 6) AS yhat, round(greatest(avg(yhat) - {Z975} * stddev_pop(yhat), 0), 6) AS yhat_lower,
      round(avg(yhat) + {Z975} * stddev_pop(yhat), 6) AS yhat_upper FROM v_long WHERE yhat IS NOT NULL GROUP BY 1, 2""")
def _(t):
    long = M.to_long(t.forecasts, MODELS, ["store_id", "ds"]).where(F.col("yhat").isNotNull())
    return r6(M.prediction_interval(long, ["store_id"]))


@query("residuals", "SELECT store_id, ds, model, y - yhat AS residual FROM v_long")
def _(t):
    return M.residuals(M.to_long(t.forecasts, MODELS, ["store_id", "ds", "y"]), ["store_id"])


@query("error_histogram", """
    WITH r AS (SELECT model, y - yhat AS residual FROM v_long WHERE yhat IS NOT NULL),
      b AS (SELECT model, CAST(CASE WHEN residual < -100 THEN 0 WHEN residual >= 100 THEN 21
          ELSE floor((residual + 100) / 10) + 1 END AS BIGINT) AS bin, residual FROM r)
    SELECT model, bin, count(*) AS count, round(sum(residual), 6) AS bin_sum,
      round((SELECT avg(residual) FROM r WHERE r.model = b.model), 6) AS mean_error FROM b GROUP BY 1, 2""")
def _(t):
    errors = M.residuals(M.to_long(t.forecasts, MODELS, ["store_id", "ds", "y"]), ["store_id"])
    return r6(M.error_histogram(errors, -100, 100, 20))


def _normal_quantile(p: str) -> str:
    """SQL of the normal quantile, from the same published tables."""

    def fraction(tables, x: str) -> str:
        top, bottom = (" + ".join(f"CAST({c!r} AS DOUBLE) * power({x}, {7 - i})" for i, c in enumerate(cs)) for cs in tables)
        return f"(({top}) / ({bottom}))"

    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    tail = f"CASE WHEN {r} <= 5 THEN {fraction(DI._NEAR, f'({r} - 1.6)')} ELSE {fraction(DI._FAR, f'({r} - 5)')} END"
    centre = f"({p} - 0.5) * {fraction(DI._CENTRE, f'(0.180625 - ({p} - 0.5) * ({p} - 0.5))')}"
    return f"CASE WHEN abs({p} - 0.5) <= 0.425 THEN {centre} ELSE sign({p} - 0.5) * ({tail}) END"


@query("qq_points", f"""
    WITH r AS (SELECT model, CAST(y - yhat AS DOUBLE) AS value FROM v_long WHERE y IS NOT NULL AND yhat IS NOT NULL),
      c AS (SELECT model, value, count(*) AS copies FROM r GROUP BY 1, 2),
      o AS (SELECT model, value, copies, sum(copies) OVER (PARTITION BY model ORDER BY value) AS upto,
        sum(copies) OVER (PARTITION BY model) AS n FROM c),
      p AS (SELECT model, value, copies, (CAST(upto AS DOUBLE) - (copies - 1) / 2.0 - 0.5) / n AS position FROM o)
    SELECT model, round(value, 6) AS value, copies, round(position, 6) AS position, round({_normal_quantile("position")}, 6) AS theoretical FROM p""")
def _(t):
    errors = M.residuals(M.to_long(t.forecasts, MODELS, ["store_id", "ds", "y"]), ["store_id"])
    return r6(M.qq_points(errors))


# Inventory ---------------------------------------------------------------

_STATS = """s AS (SELECT store_id, product_id, avg(sales) AS daily_demand, stddev_samp(sales) AS sd, count(sales) AS n FROM v_sales
      GROUP BY 1, 2)"""
KEYS = ["store_id", "product_id"]


def _demand(t):
    return t.sales.select(*KEYS, F.col("sales").alias("yhat"))


@query("safety_stock", f"""
    WITH {_STATS} SELECT store_id, product_id, daily_demand, round(sd, 6) AS demand_std, n AS periods,
      round({Z95} * sd * sqrt(7.0), 6) AS safety_stock FROM s""")
def _(t):
    return r6(I.safety_stock(I.demand_stats(_demand(t), KEYS), 7), "demand_std", "safety_stock")


@query("reorder_point", f"""
    WITH {_STATS} SELECT store_id, product_id, daily_demand, round(sd, 6) AS demand_std, n AS periods,
      round({Z95} * sd * sqrt(7.0), 6) AS safety_stock, round(daily_demand * 7 + {Z95} * sd * sqrt(7.0), 6) AS reorder_point FROM s""")
def _(t):
    return r6(I.reorder_point(I.demand_stats(_demand(t), KEYS), 7), "demand_std", "safety_stock", "reorder_point")


@query("eoq", f"""
    WITH {_STATS} SELECT store_id, product_id, round(sqrt(2 * daily_demand * 365 * 50 / nullif(cost * 0.2, 0)), 6) AS eoq
    FROM s JOIN v_products USING (product_id)""")
def _(t):
    stats = I.demand_stats(_demand(t), KEYS).join(t.products.select("product_id", "cost"), "product_id")
    return r6(stats.select(*KEYS, I.eoq(F.col("daily_demand") * 365, F.lit(50.0), F.col("cost") * 0.2).alias("eoq")))


_POLICY = f"""
    p AS (SELECT s.*, {{lead}} AS lead, {{k}} AS k, {{rate}} * {{cost}} AS h, {{stock}} AS stock, {{z}} AS z FROM s {{join}}),
    q AS (SELECT *, z * sd * sqrt(lead) AS ss, daily_demand * 365 AS annual FROM p),
    e AS (SELECT *, daily_demand * lead + ss AS rop, sqrt(2 * annual * k / nullif(h, 0)) AS eoq FROM q)
    SELECT {{keys}}, round(ss, 6) AS safety_stock, round(rop, 6) AS reorder_point, round(eoq, 6) AS economic_order_quantity,
      stock <= rop AS reorder_needed, round(CASE WHEN stock <= rop THEN eoq ELSE 0 END, 6) AS order_quantity,
      round(stock / nullif(daily_demand, 0), 6) AS days_of_supply, round(daily_demand, 6) AS daily_demand,
      round(annual, 6) AS annual_demand, round(annual / nullif(eoq, 0) * k, 6) AS annual_ordering_cost,
      round((ss + eoq / 2) * h, 6) AS annual_holding_cost,
      round(annual / nullif(eoq, 0) * k + (ss + eoq / 2) * h, 6) AS total_annual_cost FROM e"""


@query("inventory_policy", f"WITH {_STATS}, " + _POLICY.format(
    lead="lead_time_days", k="CAST(50 AS DOUBLE)", rate="CAST(0.2 AS DOUBLE)", cost="cost", stock="CAST(current_stock AS DOUBLE)",
    z=Z95, keys="store_id, product_id",
    join="JOIN v_products USING (product_id) JOIN v_inventory USING (store_id, product_id)"))
def _(t):
    params = t.inventory.select(*KEYS, "current_stock").join(t.products.select("product_id", "cost", "lead_time_days"), "product_id")
    return r6(I.inventory_policy(
        _demand(t), KEYS, "lead_time_days", 50.0, 0.2, "cost", 0.95, "current_stock", params=params))


@query("inventory_policy_multi", """
    WITH s AS (SELECT store_id, avg(sales) AS daily_demand, stddev_samp(sales) AS sd FROM v_store_days GROUP BY 1), """ + _POLICY.format(
    lead="(store_id % 5 + 1)", k="CAST(40 + store_id AS DOUBLE)", rate="CAST(0.25 AS DOUBLE)", cost="CAST(10 + store_id AS DOUBLE)",
    stock="CAST(store_id * 10 AS DOUBLE)", z=Z95, keys="store_id", join="JOIN v_stores USING (store_id)"))
def _(t):
    s = F.col("store_id")
    params = t.stores.select(
        "store_id", (s % 5 + 1).alias("lead_time"), (40 + s).alias("ordering_cost"), F.lit(0.25).alias("holding_cost_rate"),
        (10 + s).alias("unit_cost"), (s * 10).alias("current_stock"))
    demand = t.store_days.select("store_id", F.col("sales").alias("yhat"))
    return r6(I.inventory_policy_multi(demand, params, ["store_id"]))


def _optimal(safety: str, stockout: str = "CASE WHEN sd > 0 THEN CAST(1 - 0.95 AS DOUBLE) END") -> str:
    return f"""
    WITH s AS (SELECT store_id, product_id, avg(sales) AS avg_demand, count(sales) AS n,
        CASE WHEN count(sales) > 1 THEN stddev_pop(sales) ELSE 0.2 * avg(sales) END AS sd,
        quantile_cont(sales, 0.95) AS top FROM v_sales GROUP BY 1, 2),
      q AS (SELECT *, greatest(sqrt(2 * avg_demand * 50 / 0.2), 10) AS eoq, {safety} AS ss, {stockout} AS prob FROM s)
    SELECT store_id, product_id, round(avg_demand, 6) AS avg_demand, round(sd, 6) AS forecast_std,
      round(eoq, 6) AS economic_order_quantity, round(ss, 6) AS safety_stock, round(avg_demand * 7 + ss, 6) AS reorder_point,
      round(eoq + ss, 6) AS max_inventory, round(eoq / 2 + ss, 6) AS avg_inventory, round(prob, 6) AS stockout_probability,
      round((eoq / 2 + ss) * 0.2, 6) AS expected_holding_cost, round(prob * avg_demand * 0.5, 6) AS expected_stockout_cost,
      round(avg_demand / eoq * 50, 6) AS expected_order_cost,
      round((eoq / 2 + ss) * 0.2 + prob * avg_demand * 0.5 + avg_demand / eoq * 50, 6) AS total_expected_cost FROM q"""


def _optimal_inventory(t, method):
    return r6(I.optimal_inventory(
        _demand(t), KEYS, service_level=0.95, lead_time=7, holding_cost=0.2, stockout_cost=0.5, order_cost=50,
        min_order_qty=10, method=method))


@query("optimal_inventory", _optimal(f"{Z95} * sd * sqrt(7.0)"))
def _(t):
    return _optimal_inventory(t, "normal")


@query("optimal_inventory_empirical", _optimal(
    f"CASE WHEN n >= 10 THEN top - avg_demand ELSE {Z95} * sd * sqrt(7.0) END", "CAST(1 - 0.95 AS DOUBLE)"))
def _(t):
    return _optimal_inventory(t, "empirical")


@query("optimal_inventory_given", _optimal(f"{Z95} * sd * sqrt(7.0)").replace(
    "CASE WHEN count(sales) > 1 THEN stddev_pop(sales) ELSE 0.2 * avg(sales) END AS sd", "avg(store_id + 0.5) AS sd"))
def _(t):
    demand = _demand(t).withColumn("spread", F.col("store_id") + 0.5)
    return r6(I.optimal_inventory(
        demand, KEYS, service_level=0.95, lead_time=7, holding_cost=0.2, stockout_cost=0.5, order_cost=50, min_order_qty=10,
        deviation="spread"))


@query("optimal_inventory_fixed", _optimal("avg_demand * 0.3", "CAST(1 - 0.95 AS DOUBLE)"))
def _(t):
    return _optimal_inventory(t, "fixed")


# Mass and sum of the distribution, value by value, until the sum reaches the level.
_POISSON = _optimal("k - avg_demand * 7", "greatest(1 - cdf, 0)").replace("FROM s)", "FROM s JOIN z USING (store_id, product_id))").strip()[5:]


@query("optimal_inventory_poisson", f"""
    WITH RECURSIVE m AS (SELECT store_id, product_id, avg(sales) * 7 AS rate FROM v_sales GROUP BY 1, 2),
      x(store_id, product_id, rate, k, mass, cdf) AS (
        SELECT store_id, product_id, rate, 0, exp(-rate), exp(-rate) FROM m
        UNION ALL SELECT store_id, product_id, rate, k + 1, mass * rate / (k + 1), cdf + mass * rate / (k + 1) FROM x WHERE cdf < 0.95 - 1e-12),
      z AS (SELECT store_id, product_id, max(k) AS k, max(cdf) AS cdf FROM x GROUP BY 1, 2),
      {_POISSON}""")
def _(t):
    return _optimal_inventory(t, "poisson")


@query("inventory_snapshot", """
    WITH s AS (SELECT store_id, product_id, sum(sales) / 365 AS a FROM v_sales GROUP BY 1, 2)
    SELECT store_id, product_id, CAST(floor(a * lead_time_days * 2) AS INTEGER) AS safety_stock,
      CAST(floor(a * lead_time_days * 1.5) AS INTEGER) AS reorder_point,
      CAST(floor(sqrt(a * 2 * 365 * 50 / (cost * 0.2))) AS INTEGER) AS economic_order_quantity
    FROM s JOIN v_products USING (product_id)""")
def _(t):
    return I.inventory_snapshot(t.sales, t.products)


@query("stock_projection", """
    WITH p AS (SELECT *, 500 + sum(receipts - demand) OVER (PARTITION BY store_id ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM v_ledger)
    SELECT *, CAST(level <= 70 AS INTEGER) AS below_reorder,
      min(CASE WHEN level <= 70 THEN date END) OVER (PARTITION BY store_id) AS first_breach FROM p""")
def _(t):
    return I.stock_projection(t.ledger, 500.0, 70.0)


# Costs -------------------------------------------------------------------

def _cost(name, sql, expr):
    @query(name, f"SELECT store_id, round({sql}, 6) AS {name} FROM v_stock_ledger GROUP BY 1")
    def _(t):
        return r6(t.stock_ledger.groupBy("store_id").agg(expr().alias(name)))


_cost("holding_cost", "sum(level * 10 * 0.25) / 365", lambda: K.holding_cost(F.col("level"), F.lit(10.0), F.lit(0.25)))
_cost("ordering_cost", "CAST(count(*) FILTER (WHERE order_qty > 0) * 50 AS DOUBLE)", lambda: K.ordering_cost(F.col("order_qty"), F.lit(50.0)))
_cost("stockout_cost", "sum(short) * 20", lambda: K.stockout_cost(F.col("short"), F.lit(20.0)))
_cost("lost_sales_cost", "sum(short) * (15 - 10)", lambda: K.lost_sales_cost(F.col("short"), F.lit(15.0), F.lit(10.0)))
_cost("service_level", "CASE WHEN sum(demand) > 0 THEN (sum(demand) - sum(short)) / sum(demand) ELSE 0 END",
      lambda: K.service_level(F.sum("demand"), F.sum("short")))
_cost("turnover", "sum(demand) * 365 / count(*) / nullif(avg(level), 0)",
      lambda: K.turnover(F.sum("demand") * 365 / F.count(F.lit(1)), F.avg("level")))
_cost("days_of_supply", "avg(level) / nullif(avg(demand), 0)", lambda: K.days_of_supply(F.avg("level"), F.avg("demand")))
_cost("total_cost", "sum(level * 10 * 0.25) / 365 + count(*) FILTER (WHERE order_qty > 0) * 50 + sum(short) * 25",
      lambda: K.total_cost(
          K.holding_cost(F.col("level"), F.lit(10.0), F.lit(0.25)), K.ordering_cost(F.col("order_qty"), F.lit(50.0)),
          K.stockout_cost(F.col("short"), F.lit(20.0)), K.lost_sales_cost(F.col("short"), F.lit(15.0), F.lit(10.0))))


@query("annual_costs", f"""
    WITH {_STATS}, q AS (SELECT store_id, product_id, daily_demand * 365 AS annual_demand, {Z95} * sd AS safety_stock,
        sqrt(2 * daily_demand * 365 * 50 / (cost * 0.2)) AS order_quantity, cost, price FROM s JOIN v_products USING (product_id))
    SELECT store_id, product_id, round(annual_demand / order_quantity, 6) AS num_orders,
      round((safety_stock + order_quantity / 2) * cost * 0.2, 6) AS annual_holding_cost,
      round(annual_demand / order_quantity * 50, 6) AS annual_ordering_cost, round(annual_demand * 0.05 * 20, 6) AS annual_stockout_cost,
      round(annual_demand * 0.05 * (price - cost), 6) AS annual_lost_sales_cost,
      round((safety_stock + order_quantity / 2) * cost * 0.2 + annual_demand / order_quantity * 50 + annual_demand * 0.05 * 20
        + annual_demand * 0.05 * (price - cost), 6) AS total_annual_cost FROM q""")
def _(t):
    stats = I.demand_stats(_demand(t), KEYS)
    base = stats.join(t.products.select("product_id", "cost", "price"), "product_id").select(
        *KEYS, "cost", "price", (F.col("daily_demand") * 365).alias("annual_demand"),
        I.eoq(F.col("daily_demand") * 365, F.lit(50.0), F.col("cost") * 0.2).alias("order_quantity"),
        (F.lit(float(Z95)) * F.col("demand_std")).alias("safety_stock"))
    base = base.withColumn("average", F.col("safety_stock") + F.col("order_quantity") / 2)
    out = K.annual_costs(base, "average", "annual_demand", "order_quantity", "cost", 0.2, 50.0, 0.05, 20.0, "price")
    return r6(out.drop("cost", "price", "annual_demand", "order_quantity", "safety_stock", "average"))


@query("cost_breakdown", f"""
    WITH {_STATS}, q AS (SELECT store_id, product_id, daily_demand, daily_demand * 365 AS annual, {Z95} * sd * sqrt(7.0) AS ss,
        sqrt(2 * daily_demand * 365 * 50 / (cost * 0.2)) AS eoq, cost FROM s JOIN v_products USING (product_id)),
      c AS (SELECT *, ss + eoq / 2 AS av, annual / eoq AS orders, (ss + eoq / 2) * cost * 0.2 AS hold, annual / eoq * 50 AS ord FROM q)
    SELECT store_id, product_id, round(av, 6) AS average_inventory, round(orders, 6) AS num_orders, round(hold, 6) AS annual_holding_cost,
      round(ord, 6) AS annual_ordering_cost, round(hold + ord, 6) AS total_annual_cost,
      round(CASE WHEN hold + ord > 0 THEN hold / (hold + ord) * 100 ELSE 0 END, 6) AS holding_cost_percentage,
      round(CASE WHEN hold + ord > 0 THEN ord / (hold + ord) * 100 ELSE 0 END, 6) AS ordering_cost_percentage,
      round(CASE WHEN av > 0 THEN annual / av END, 6) AS inventory_turnover, round(av / daily_demand, 6) AS days_of_supply FROM c""")
def _(t):
    params = t.inventory.select(*KEYS).join(t.products.select("product_id", "cost"), "product_id")
    policy = I.inventory_policy(_demand(t), KEYS, 7, 50.0, 0.2, "cost", params=params)
    base = policy.select(*KEYS, "safety_stock", "economic_order_quantity", "annual_demand", "daily_demand")
    base = base.join(t.products.select("product_id", "cost"), "product_id")
    out = K.cost_breakdown(base, "cost", 0.2, 50.0)
    return r6(out.drop("cost", "safety_stock", "economic_order_quantity", "annual_demand", "daily_demand"))


@query("echelon_costs", """
    WITH e AS (SELECT region AS echelon, avg(level) AS lvl, avg(demand) AS d FROM v_stock_ledger JOIN v_stores USING (store_id) GROUP BY 1),
      c AS (SELECT echelon, lvl * 10 * 0.25 AS hold, d * 365 / 100 * 50 AS ord FROM e)
    SELECT echelon, round(hold, 6) AS holding_cost, round(ord, 6) AS ordering_cost, round(hold + ord, 6) AS total_cost FROM c
    UNION ALL SELECT NULL, round(sum(hold), 6), round(sum(ord), 6), round(sum(hold + ord), 6) FROM c""")
def _(t):
    levels = t.stock_ledger.join(t.stores.select("store_id", F.col("region").alias("echelon")), "store_id")
    params = t.stores.select(F.col("region").alias("echelon")).distinct().withColumns(
        {"unit_cost": F.lit(10.0), "holding_cost_rate": F.lit(0.25), "cost_per_order": F.lit(50.0), "order_quantity": F.lit(100.0)})
    return r6(K.echelon_costs(levels, params, demand="demand"))


@query("ledger_costs", """
    WITH s AS (SELECT store_id, count(*) AS n, avg(level) AS average_inventory, sum(demand) AS d, sum(short) AS sh,
        count(*) FILTER (WHERE order_qty > 0) AS o, sum(level * 10 * 0.25) / 365 AS hold FROM v_stock_ledger GROUP BY 1),
      a AS (SELECT *, 365.0 / n AS f FROM s)
    SELECT store_id, round(average_inventory, 6) AS average_inventory, round(d * f, 6) AS annual_demand, round(o * f, 6) AS num_orders,
      round(CASE WHEN d > 0 THEN (d - sh) / d ELSE 0 END, 6) AS service_level,
      round(CASE WHEN average_inventory > 0 THEN d * f / average_inventory END, 6) AS inventory_turnover,
      round(hold * f, 6) AS annual_holding_cost, round(o * 50 * f, 6) AS annual_ordering_cost,
      round(sh * 20 * f, 6) AS annual_stockout_cost, round(sh * 5 * f, 6) AS annual_lost_sales_cost,
      round(hold * f + o * 50 * f + sh * 20 * f + sh * 5 * f, 6) AS total_annual_cost FROM a""")
def _(t):
    return r6(K.ledger_costs(t.stock_ledger, ["store_id"], unit_price=15.0))
