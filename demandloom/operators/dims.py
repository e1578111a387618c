"""Joins to store, product and inventory dimensions, and within-store shares.

No join here carries a broadcast hint: Spark broadcasts a dimension when its
measured size is under the session threshold and otherwise runs a sort-merge
join, whose skewed partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.dates import flag
from demandloom.functions.exprs import all_of, cut, ratio, series_window
from demandloom.operators.encode import category_values, one_hot

# Bin edges and labels of the derived dimension features.
STORE_AGE_EDGES = (-1, 30, 90, 365, 730, 1825, 3650, 999999)
STORE_AGE_LABELS = ("new", "1-3m", "3-12m", "1-2y", "2-5y", "5-10y", "10y+")
STORE_SIZE_EDGES = (-1, 2000, 5000, 10000, 20000, 50000, 999999)
STORE_SIZE_LABELS = ("tiny", "small", "medium", "large", "xlarge", "mega")
PRICE_EDGES = (-1, 5, 10, 25, 50, 100, 999999)
PRICE_LABELS = ("budget", "low", "medium", "high", "premium", "luxury")
SUPPLY_EDGES = (-1, 3, 7, 14, 30, 60, 999999)
SUPPLY_LABELS = ("critical", "low", "medium", "adequate", "high", "excess")


def join_dims(
    facts: DataFrame, stores: DataFrame, products: DataFrame, store: str = "store_id", product: str = "product_id"
) -> DataFrame:
    """Inner join of facts with both dimensions; dimension columns that clash with facts are suffixed."""
    out = facts
    for dim, key, suffix in ((stores, store, "_store"), (products, product, "_product")):
        clash = [c for c in dim.columns if c != key and c in out.columns]
        for c in clash:
            dim = dim.withColumnRenamed(c, c + suffix)
        out = out.join(dim, key, "inner")
    return out


def store_features(
    facts: DataFrame,
    stores: DataFrame,
    date: str = "date",
    store: str = "store_id",
    values: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Store columns, age in days with bins, size bins, one-hot type and region."""
    out = facts.join(stores, store, "left")
    if "opening_date" in stores.columns:
        age = F.datediff(F.col(date), F.col("opening_date"))
        out = out.withColumn("store_age_days", age).withColumn(
            "store_age_bin", cut("store_age_days", STORE_AGE_EDGES, STORE_AGE_LABELS)
        )
    if "size_sqft" in stores.columns:
        out = out.withColumn("store_size_bin", cut("size_sqft", STORE_SIZE_EDGES, STORE_SIZE_LABELS))
    return _encoded(out, stores, ("store_type", "region"), values)


def product_features(
    facts: DataFrame,
    products: DataFrame,
    product: str = "product_id",
    values: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Product columns, margin, margin ratio, price bins, one-hot category.

    Where both sides have a column, the dimension's is taken.
    """
    own = [c for c in facts.columns if c == product or c not in products.columns]
    out = facts.select(*own).join(products, product, "left")
    if {"price", "cost"} <= set(products.columns):
        out = out.withColumn("margin", F.col("price") - F.col("cost"))
        out = out.withColumns(
            {"margin_ratio": ratio("margin", "price"), "price_bin": cut("price", PRICE_EDGES, PRICE_LABELS)}
        )
    return _encoded(out, products, ("category", "subcategory"), values)


def _encoded(out: DataFrame, dim: DataFrame, columns: Sequence[str], values) -> DataFrame:
    present = [c for c in columns if c in dim.columns]
    # Values are read from the dimension, which is far smaller than the joined facts.
    known = {c: (values or {}).get(c) or category_values(dim, c) for c in present}
    return one_hot(out, present, known, keep_original=True)


def inventory_features(
    facts: DataFrame,
    inventory: DataFrame,
    keys: Sequence[str] = ("store_id", "product_id"),
    date: str = "date",
    sales: str = "sales",
) -> DataFrame:
    """Coverage, stock ratios, reorder flag and stock against the last seven rows' sales."""
    keys = list(keys)
    means = facts.groupBy(*keys).agg(F.avg(sales).alias("_mean"))
    out = facts.join(inventory.join(means, keys, "left"), keys, "left")
    stock = F.col("current_stock")
    made = {"days_of_supply": ratio(stock, F.col("_mean"))}
    if "safety_stock" in inventory.columns:
        made["stock_to_safety_ratio"] = ratio(stock, F.col("safety_stock"))
    if "reorder_point" in inventory.columns:
        made["stock_to_reorder_ratio"] = ratio(stock, F.col("reorder_point"))
        made["below_reorder_point"] = flag(stock < F.col("reorder_point"))
    week = series_window(keys, date).rowsBetween(-6, 0)
    weekly = F.when(F.count(sales).over(week) == 7, F.sum(sales).over(week))
    made["stock_to_weekly_sales_ratio"] = ratio(stock, weekly)
    out = out.withColumns(made).drop("_mean")
    return out.withColumn("supply_bin", cut("days_of_supply", SUPPLY_EDGES, SUPPLY_LABELS))


def cross_product_features(
    facts: DataFrame,
    date: str = "date",
    store: str = "store_id",
    sales: str = "sales",
    levels: Sequence[str] = ("category", "subcategory"),
) -> DataFrame:
    """Daily totals of category, subcategory and store, the row's share of each, and the rest.

    Facts are aggregated once (map-side combined, so a store-day of any size is
    never gathered); all totals are derived from that smaller table and joined
    back in a single join.
    """
    present = [c for c in levels if c in facts.columns]
    cell = [date, store, *present]
    cells = facts.groupBy(*cell).agg(F.sum(sales).alias("_cell"))
    for keys, name in [([date, store, c], c) for c in present] + [([date, store], "store")]:
        totals = cells.groupBy(*keys).agg(F.coalesce(F.sum("_cell"), F.lit(0)).alias(f"{name}_sales"))
        cells = cells.join(totals, keys, "left")
    cells = cells.drop("_cell")
    for c in cell:
        cells = cells.withColumnRenamed(c, f"_{c}")
    out = facts.join(cells, all_of(F.col(c).eqNullSafe(F.col(f"_{c}")) for c in cell), "left")
    out = out.drop(*[f"_{c}" for c in cell])
    made = {}
    for name in [*present, "store"]:
        made[f"{name}_sales_share"] = ratio(sales, f"{name}_sales")
        made[f"{name}_sales_others"] = F.col(f"{name}_sales") - F.col(sales)
    return out.withColumns(made)
