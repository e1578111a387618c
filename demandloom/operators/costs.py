"""Inventory cost accounting over ledgers and policies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import ratio, series_window
from demandloom.operators.inventory import DAYS_PER_YEAR, _param


def holding_cost(level: Column, unit_cost: Column, annual_rate: Column) -> Column:
    """Aggregate: stock held each day at the daily share of the annual rate."""
    return F.sum(level * unit_cost * annual_rate) / DAYS_PER_YEAR


def ordering_cost(order_qty: Column, cost_per_order: Column) -> Column:
    """Aggregate: number of orders placed times the cost of one."""
    return F.sum(F.when(order_qty > 0, cost_per_order).otherwise(0.0))


def stockout_cost(short: Column, cost_per_unit: Column) -> Column:
    return F.sum(short * cost_per_unit)


def lost_sales_cost(short: Column, unit_price: Column, unit_cost: Column) -> Column:
    return F.sum(short * (unit_price - unit_cost))


def total_cost(*parts: Column) -> Column:
    out = F.coalesce(parts[0], F.lit(0.0))
    for p in parts[1:]:
        out = out + F.coalesce(p, F.lit(0.0))
    return out


def turnover(annual_demand: Column, average_inventory: Column) -> Column:
    return F.when(average_inventory > 0, ratio(annual_demand, average_inventory))


def days_of_supply(level: Column, daily_demand: Column) -> Column:
    return F.when(daily_demand > 0, ratio(level, daily_demand))


def service_level(demand: Column, short: Column) -> Column:
    """Share of demand served; 0 without demand."""
    return F.when(demand > 0, ratio(demand - short, demand)).otherwise(0.0)


def annual_costs(
    df: DataFrame,
    average_inventory: str,
    annual_demand: str,
    order_quantity: str,
    unit_cost: float | str,
    holding_cost_rate: float | str,
    cost_per_order: float | str,
    stockout_rate: float | str = 0.0,
    stockout_cost_per_unit: float | str = 0.0,
    unit_price: float | str | None = None,
) -> DataFrame:
    """Orders, holding, ordering, stockout, lost-sales and total cost of a year, per row."""
    demand, quantity = F.col(annual_demand), F.col(order_quantity)
    cost = _param(unit_cost)
    short = demand * _param(stockout_rate)
    lost = short * (_param(unit_price) - cost) if unit_price is not None else F.lit(0.0)
    out = df.withColumn("num_orders", F.when(quantity > 0, ratio(demand, quantity)).otherwise(0.0))
    out = out.withColumns(
        {
            "annual_holding_cost": F.col(average_inventory) * cost * _param(holding_cost_rate),
            "annual_ordering_cost": F.col("num_orders") * _param(cost_per_order),
            "annual_stockout_cost": short * _param(stockout_cost_per_unit),
            "annual_lost_sales_cost": lost,
        }
    )
    return out.withColumn(
        "total_annual_cost",
        F.col("annual_holding_cost") + F.col("annual_ordering_cost") + F.col("annual_stockout_cost")
        + F.col("annual_lost_sales_cost"),
    )


def cost_breakdown(
    policy: DataFrame, unit_cost: float | str, holding_cost_rate: float | str, cost_per_order: float | str
) -> DataFrame:
    """Average stock, orders, cost shares, turnover and days of supply of a policy row."""
    out = policy.withColumn("average_inventory", F.col("safety_stock") + F.col("economic_order_quantity") / 2)
    out = annual_costs(
        out, "average_inventory", "annual_demand", "economic_order_quantity", unit_cost, holding_cost_rate, cost_per_order
    ).drop("annual_stockout_cost", "annual_lost_sales_cost")
    total = F.col("total_annual_cost")

    def percent(c: str) -> Column:
        return F.when(total > 0, ratio(F.col(c), total) * 100).otherwise(0.0)

    return out.withColumns(
        {
            "holding_cost_percentage": percent("annual_holding_cost"),
            "ordering_cost_percentage": percent("annual_ordering_cost"),
            "inventory_turnover": turnover(F.col("annual_demand"), F.col("average_inventory")),
            "days_of_supply": days_of_supply(F.col("average_inventory"), F.col("daily_demand")),
        }
    )


def echelon_costs(
    levels: DataFrame,
    params: DataFrame,
    echelon: str = "echelon",
    date: str = "date",
    level: str = "level",
    demand: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Holding, ordering and total cost per echelon and a grand-total row (echelon NULL).

    Daily demand is the mean of ``demand``, or without one the mean fall of the
    level from day to day, inside each series of ``keys``.
    """
    if demand is None:
        drop = F.lag(level, 1).over(series_window([echelon, *keys], date)) - F.col(level)
        levels = levels.withColumn("_d", F.when(drop > 0, drop))
        demand = "_d"
    per = levels.groupBy(echelon).agg(
        F.avg(level).alias("average_inventory"), F.avg(demand).alias("daily_demand")
    ).join(params, echelon)
    quantity = F.col("order_quantity")
    annual = F.coalesce(F.col("daily_demand"), F.lit(0.0)) * DAYS_PER_YEAR
    per = per.withColumns(
        {
            "holding_cost": F.col("average_inventory") * F.col("unit_cost") * F.col("holding_cost_rate"),
            "num_orders": F.when(quantity > 0, ratio(annual, quantity)).otherwise(0.0),
        }
    ).withColumn("ordering_cost", F.col("num_orders") * F.col("cost_per_order"))
    return per.rollup(echelon).agg(
        F.sum("holding_cost").alias("holding_cost"),
        F.sum("ordering_cost").alias("ordering_cost"),
        F.sum(F.col("holding_cost") + F.col("ordering_cost")).alias("total_cost"),
    )


def ledger_costs(
    ledger: DataFrame,
    keys: Sequence[str],
    unit_cost: float | str = 10.0,
    holding_cost_rate: float | str = 0.25,
    cost_per_order: float | str = 50.0,
    stockout_cost_per_unit: float | str = 20.0,
    unit_price: float | str | None = None,
    level: str = "level",
    order_qty: str = "order_qty",
    demand: str = "demand",
    short: str = "short",
) -> DataFrame:
    """Annualised costs, service level and turnover of an observed ledger (one row per key and day)."""
    cost = _param(unit_cost)
    s = F.col(short)
    sums = ledger.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_days"),
        F.avg(level).alias("average_inventory"),
        F.sum(demand).alias("_demand"),
        F.sum(short).alias("_short"),
        F.sum(F.when(F.col(order_qty) > 0, 1).otherwise(0)).alias("_orders"),
        holding_cost(F.col(level), cost, _param(holding_cost_rate)).alias("_holding"),
        ordering_cost(F.col(order_qty), _param(cost_per_order)).alias("_ordering"),
        stockout_cost(s, _param(stockout_cost_per_unit)).alias("_stockout"),
        (lost_sales_cost(s, _param(unit_price), cost) if unit_price is not None else F.lit(0.0)).alias("_lost"),
    )
    year = F.lit(float(DAYS_PER_YEAR)) / F.col("_days")
    out = sums.withColumns(
        {
            "annual_demand": F.col("_demand") * year,
            "num_orders": F.col("_orders") * year,
            "service_level": service_level(F.col("_demand"), F.col("_short")),
            "annual_holding_cost": F.col("_holding") * year,
            "annual_ordering_cost": F.col("_ordering") * year,
            "annual_stockout_cost": F.col("_stockout") * year,
            "annual_lost_sales_cost": F.col("_lost") * year,
        }
    )
    out = out.withColumns(
        {
            "inventory_turnover": turnover(F.col("annual_demand"), F.col("average_inventory")),
            "total_annual_cost": total_cost(
                F.col("annual_holding_cost"), F.col("annual_ordering_cost"), F.col("annual_stockout_cost"),
                F.col("annual_lost_sales_cost"),
            ),
        }
    )
    return out.select(
        *keys, "average_inventory", "annual_demand", "num_orders", "service_level", "inventory_turnover",
        "annual_holding_cost", "annual_ordering_cost", "annual_stockout_cost", "annual_lost_sales_cost",
        "total_annual_cost",
    )
