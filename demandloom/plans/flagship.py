"""The flagship plan: facts to features, accuracy and inventory policy, as one lazy DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators.calendar import calendar_fill
from demandloom.operators.features_time import time_features
from demandloom.operators.inventory import inventory_policy
from demandloom.operators.metrics import metrics_all
from demandloom.operators.windows import lags, rolling
from demandloom.sources.retail import RetailTables

KEYS = ["store_id", "product_id"]


def series_features(t: RetailTables) -> DataFrame:
    """Dense daily series with calendar, lag and rolling features."""
    dense = calendar_fill(t.sales.select("date", *KEYS, "sales"), KEYS, method="zero")
    featured = lags(dense, "sales", (1, 7, 14, 28), KEYS)
    featured = rolling(featured, "sales", (7, 28), ("mean", "std"), KEYS)
    return time_features(featured)


def store_product_policy(spark: SparkSession, path: str) -> DataFrame:
    """One row per series: seasonal-naive accuracy and the resulting inventory policy."""
    t = RetailTables(spark, path)
    features = series_features(t)
    wide = features.select(*KEYS, F.col("date").alias("ds"), F.col("sales").alias("y"), F.col("sales_lag_7").alias("naive7"))
    accuracy = metrics_all(wide, ["naive7"], KEYS, metrics=("mae", "rmse", "bias", "wmape")).drop("model")
    params = t.products.select("product_id", "cost", "lead_time_days")
    demand = wide.select(*KEYS, F.col("y").alias("yhat"))
    policy = inventory_policy(demand, KEYS, "lead_time_days", 50.0, 0.2, "cost", params=params, params_on=["product_id"])
    return policy.join(accuracy, KEYS, "left")
