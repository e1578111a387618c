"""Inventory policies: one row per series, from one aggregate of its demand."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.dates import flag
from demandloom.functions.distributions import normal_quantile, poisson_cdf, poisson_quantile
from demandloom.functions.exprs import ratio, series_window, z_value
from demandloom.operators.quantiles import exact_quantiles

DAYS_PER_YEAR = 365


def _z(service_level: float | str) -> Column:
    """A literal for one level, the quantile as an expression for a column of levels."""
    if isinstance(service_level, str):
        return normal_quantile(F.col(service_level).cast("double"))
    return F.lit(z_value(service_level))


def _param(value: float | str) -> Column:
    return F.col(value).cast("double") if isinstance(value, str) else F.lit(float(value))


def demand_stats(df: DataFrame, keys: Sequence[str], demand: str = "yhat") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.avg(demand).alias("daily_demand"), F.stddev_samp(demand).alias("demand_std"), F.count(demand).alias("periods")
    )


def safety_stock(stats: DataFrame, lead_time: float | str, service_level: float | str = 0.95) -> DataFrame:
    """z * sample deviation of demand * sqrt(lead time)."""
    return stats.withColumn("safety_stock", _z(service_level) * F.col("demand_std") * F.sqrt(_param(lead_time)))


def reorder_point(stats: DataFrame, lead_time: float | str, service_level: float | str = 0.95) -> DataFrame:
    out = stats if "safety_stock" in stats.columns else safety_stock(stats, lead_time, service_level)
    return out.withColumn("reorder_point", F.col("daily_demand") * _param(lead_time) + F.col("safety_stock"))


def eoq(annual_demand: Column, ordering_cost: Column, holding_cost: Column) -> Column:
    """sqrt(2 D K / h); NULL where holding is free."""
    return F.sqrt(ratio(annual_demand * ordering_cost * 2, holding_cost))


def inventory_policy(
    df: DataFrame,
    keys: Sequence[str],
    lead_time: float | str,
    ordering_cost: float | str,
    holding_cost_rate: float | str,
    unit_cost: float | str,
    service_level: float | str = 0.95,
    current_stock: float | str = 0.0,
    demand: str = "yhat",
    params: DataFrame | None = None,
    params_on: Sequence[str] | None = None,
) -> DataFrame:
    """Policy per series; a parameter is a number, or a column of ``params``.

    ``params`` has one row per ``params_on`` (the keys unless given).
    """
    out = demand_stats(df, keys, demand)
    if params is not None:
        out = out.join(params, list(params_on or keys), "left")
    out = reorder_point(out, lead_time, service_level)
    out = out.withColumn("annual_demand", F.col("daily_demand") * DAYS_PER_YEAR)
    holding = _param(holding_cost_rate) * _param(unit_cost)
    order_cost, stock = _param(ordering_cost), _param(current_stock)
    out = out.withColumn("economic_order_quantity", eoq(F.col("annual_demand"), order_cost, holding))
    q = F.col("economic_order_quantity")
    needed = stock <= F.col("reorder_point")
    out = out.withColumns(
        {
            "reorder_needed": needed,
            "order_quantity": F.when(needed, q).otherwise(0.0),
            "days_of_supply": F.when(F.col("daily_demand") > 0, ratio(stock, F.col("daily_demand"))),
            "annual_ordering_cost": ratio("annual_demand", "economic_order_quantity") * order_cost,
            "annual_holding_cost": (F.col("safety_stock") + q / 2) * holding,
        }
    )
    out = out.withColumn("total_annual_cost", F.col("annual_ordering_cost") + F.col("annual_holding_cost"))
    return out.select(
        *keys, "safety_stock", "reorder_point", "economic_order_quantity", "reorder_needed", "order_quantity",
        "days_of_supply", "daily_demand", "annual_demand", "annual_ordering_cost", "annual_holding_cost",
        "total_annual_cost",
    )


def inventory_policy_multi(df: DataFrame, params: DataFrame, keys: Sequence[str], demand: str = "yhat") -> DataFrame:
    """Policy per location with its own row of parameters.

    ``params`` has lead_time, ordering_cost, holding_cost_rate, unit_cost and
    may have service_level (else 0.95) and current_stock (else 0).
    """
    filled = params
    for name, default in (("service_level", 0.95), ("current_stock", 0.0)):
        value = F.coalesce(F.col(name).cast("double"), F.lit(default)) if name in params.columns else F.lit(default)
        filled = filled.withColumn(name, value)
    return inventory_policy(
        df, keys, "lead_time", "ordering_cost", "holding_cost_rate", "unit_cost", "service_level", "current_stock",
        demand, filled,
    )


def optimal_inventory(
    df: DataFrame,
    keys: Sequence[str],
    demand: str = "yhat",
    service_level: float = 0.95,
    lead_time: float = 1.0,
    holding_cost: float = 0.2,
    stockout_cost: float = 0.8,
    order_cost: float = 10.0,
    min_order_qty: float = 0.0,
    method: str = "normal",
    deviation: float | str | None = None,
) -> DataFrame:
    """Order quantity, safety stock and expected costs per period.

    ``deviation`` gives the deviation of demand: a number, or a column of
    ``df``, of which a key's mean counts.  Without it the values decide:    the population deviation, and for a single value a fifth of it.

    ``method`` is normal, poisson, empirical (ten values or more, else normal)
    or fixed.  The normal stockout probability is 1 - service level, NULL where
    demand does not vary.
    """
    keys = list(keys)
    given = F.avg(deviation) if isinstance(deviation, str) else F.lit(deviation)
    out = df.groupBy(*keys).agg(
        F.avg(demand).alias("avg_demand"), F.stddev_pop(demand).alias("_sd"), F.count(demand).alias("_n"),
        given.cast("double").alias("_given"),
    )
    avg = F.col("avg_demand")
    observed = F.when(F.col("_n") > 1, F.col("_sd")).otherwise(avg * 0.2)
    out = out.withColumn("forecast_std", observed if deviation is None else F.col("_given"))
    out = out.withColumn(
        "economic_order_quantity",
        F.greatest(F.sqrt(avg * (2.0 * order_cost / holding_cost)), F.lit(float(min_order_qty))),
    )
    normal = F.lit(z_value(service_level)) * F.col("forecast_std") * F.lit(math.sqrt(lead_time))
    stockout = F.lit(1.0 - service_level)
    if method == "normal":
        safety = normal
        stockout = F.when(F.col("forecast_std") > 0, stockout)
    elif method == "poisson":
        rate = avg * float(lead_time)
        safety = poisson_quantile(rate, F.lit(float(service_level))) - rate
    elif method == "empirical":
        top = exact_quantiles(df, demand, [service_level], keys, names=["_p"])
        out = out.join(top, keys, "left")
        safety = F.when(F.col("_n") >= 10, F.col("_p") - avg).otherwise(normal)
    elif method == "fixed":
        safety = avg * 0.3
    else:
        raise ValueError(f"unknown safety stock method: {method}")
    out = out.withColumn("safety_stock", safety)
    out = out.withColumn("reorder_point", avg * float(lead_time) + F.col("safety_stock"))
    if method == "poisson":
        stockout = 1 - poisson_cdf(avg * float(lead_time), F.col("reorder_point"))
    q = F.col("economic_order_quantity")
    out = out.withColumns(
        {
            "max_inventory": q + F.col("safety_stock"),
            "avg_inventory": q / 2 + F.col("safety_stock"),
            "stockout_probability": stockout,
        }
    )
    out = out.withColumns(
        {
            "expected_holding_cost": F.col("avg_inventory") * float(holding_cost),
            "expected_stockout_cost": F.col("stockout_probability") * avg * float(stockout_cost),
            "expected_order_cost": ratio(avg, q) * float(order_cost),
        }
    )
    total = F.col("expected_holding_cost") + F.col("expected_stockout_cost") + F.col("expected_order_cost")
    return out.withColumn("total_expected_cost", total).select(
        *keys, "avg_demand", "forecast_std", "economic_order_quantity", "safety_stock", "reorder_point",
        "max_inventory", "avg_inventory", "stockout_probability", "expected_holding_cost", "expected_stockout_cost",
        "expected_order_cost", "total_expected_cost",
    )


def inventory_snapshot(
    facts: DataFrame, products: DataFrame, keys: Sequence[str] = ("store_id", "product_id"), product: str = "product_id"
) -> DataFrame:
    """Rule-of-thumb stock levels: twice and one and a half lead times of mean daily sales, and an order quantity."""
    totals = facts.groupBy(*keys).agg(F.sum("sales").alias("_total"))
    joined = totals.join(products.select(product, "lead_time_days", "cost"), product)
    avg = F.col("_total") / DAYS_PER_YEAR
    lead = F.col("lead_time_days")
    quantity = F.sqrt(ratio(avg * 2 * DAYS_PER_YEAR * 50, F.col("cost") * 0.2))
    return joined.select(
        *keys,
        F.floor(avg * lead * 2).cast("int").alias("safety_stock"),
        F.floor(avg * lead * 1.5).cast("int").alias("reorder_point"),
        F.floor(quantity).cast("int").alias("economic_order_quantity"),
    )


def stock_projection(
    ledger: DataFrame,
    opening: float | str,
    reorder_at: float | str,
    keys: Sequence[str] = ("store_id",),
    date: str = "date",
    receipts: str = "receipts",
    demand: str = "demand",
) -> DataFrame:
    """Stock level per day: opening plus receipts minus demand so far, with the reorder flag and first breach.

    The level may go below zero, which is the backlog.
    """
    w = series_window(keys, date).rowsBetween(Window.unboundedPreceding, 0)
    change = F.coalesce(F.col(receipts), F.lit(0.0)) - F.coalesce(F.col(demand), F.lit(0.0))
    out = ledger.withColumn("level", _param(opening) + F.sum(change).over(w))
    below = F.col("level") <= _param(reorder_at)
    out = out.withColumn("below_reorder", flag(below))
    first = F.min(F.when(below, F.col(date))).over(Window.partitionBy(*keys))
    return out.withColumn("first_breach", first)
