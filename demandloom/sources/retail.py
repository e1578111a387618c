"""Retail tables derived from the order tables: sales facts and their dimensions.

A store is a supplier nation and a product is a part brand, so that series are
dense enough to forecast.  Money is summed in exact cents and divided once.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.functions.exprs import nan_to_null, series_window
from demandloom.operators.external import holiday_calendar

# Attribute values of the derived tables.
STORE_TYPES = ("Corner", "Market Hall", "Outlet", "Depot", "Kiosk")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
CATEGORIES = ("Cat0", "Cat1", "Cat2", "Cat3", "Cat4")
PROMOTION_TYPES = ("Two For One", "Markdown", "Weekend Deal")


def _cents(c: str) -> Column:
    return F.rint(F.col(c) * 100).cast("bigint")


def product_of(brand: str = "p_brand") -> Column:
    return F.regexp_replace(brand, "Brand#", "").cast("int")


MODELS = ("naive7", "naive28", "mean7")


class RetailTables:
    """The retail tables over one directory of parquet files; every one is a lazy DataFrame."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def table(self, name: str) -> DataFrame:
        """A stored table; NaN is NULL from here on."""
        return nan_to_null(self.spark.read.parquet(f"{self.path}/{name}.parquet"))

    def lines(self, *parts: str) -> DataFrame:
        """Line items with the wanted ones of date, store_id and product_id; only the tables that give them are joined."""
        known = {
            "store_id": ("l_suppkey", lambda: self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("store_id"))),
            "product_id": ("l_partkey", lambda: self.table("part").select("p_partkey", product_of().alias("product_id"))),
            "date": ("l_orderkey", lambda: self.table("orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))),
        }
        out = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
        )
        for name in [p for p in known if p in parts]:
            key, make = known[name]
            dim = make()
            out = out.join(dim, F.col(key) == F.col(dim.columns[0]))
        return out

    @cached_property
    def sales_lines(self) -> DataFrame:
        """Line items with date, store and product: the finest facts."""
        return self.lines("store_id", "product_id", "date")

    @cached_property
    def sales(self) -> DataFrame:
        """One row per date, store and product: sales, revenue and mean list price."""
        gross = _cents("l_extendedprice")
        kept = 100 - _cents("l_discount")
        return self.sales_lines.groupBy("date", "store_id", "product_id").agg(
            F.sum("l_quantity").alias("sales"),
            (F.sum(gross * kept).cast("double") / F.lit(10000.0)).alias("revenue"),
            (F.sum(gross).cast("double") / (F.lit(100.0) * F.sum("l_quantity"))).alias("price"),
        )

    @cached_property
    def gappy(self) -> DataFrame:
        """Sales with every seventh day of the month missing (18 percent of the rows)."""
        gap = F.when(F.dayofmonth("date") % 7 != 0, F.col("sales"))
        return self.sales.select("date", "store_id", "product_id", gap.alias("sales"))

    @cached_property
    def store_days(self) -> DataFrame:
        """One row per store and date with summed sales."""
        return self.lines("store_id", "date").groupBy("store_id", "date").agg(F.sum("l_quantity").alias("sales"))

    @cached_property
    def stores(self) -> DataFrame:
        n = F.col("n_nationkey")
        kind = F.element_at(F.array(*[F.lit(t) for t in STORE_TYPES]), (n % 5 + 1).cast("int"))
        return self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        ).select(
            n.alias("store_id"),
            F.col("n_name").alias("store_name"),
            F.col("r_name").alias("region"),
            kind.alias("store_type"),
            (1000 + 2000 * n).alias("size_sqft"),
            F.date_add(F.lit("1990-01-01").cast("date"), n).alias("opening_date"),
            (n % 10 != 9).alias("is_active"),
        )

    @cached_property
    def products(self) -> DataFrame:
        total, n = F.sum(_cents("p_retailprice")).cast("double"), F.count(F.lit(1))
        product = product_of()
        return self.table("part").groupBy(product.alias("product_id"), F.col("p_brand").alias("product_name")).agg(
            F.concat(F.lit("Cat"), (F.first(product) % 5).cast("string")).alias("category"),
            (total / (100.0 * n)).alias("price"),
            (total * 6 / (1000.0 * n)).alias("cost"),
            F.min("p_size").cast("int").alias("lead_time_days"),
        )

    @cached_property
    def dates(self) -> DataFrame:
        return self.table("orders").select(F.to_date("o_orderdate").alias("date")).distinct()

    @cached_property
    def weather(self) -> DataFrame:
        d, m = F.dayofmonth("date"), F.month("date")
        return self.dates.select(
            "date",
            (d + m * 2 - 10).cast("double").alias("temperature"),
            ((d * 7 + m) % 23 - 8).cast("double").alias("precipitation"),
        )

    @cached_property
    def economy(self) -> DataFrame:
        y, m = F.year("o_orderdate"), F.month("o_orderdate")
        return self.table("orders").select(
            F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
            (100 + (y * 12 + m) % 7).cast("double").alias("consumer_confidence_index"),
            (4 + (y + m) % 4).cast("double").alias("unemployment_rate"),
        ).distinct()

    @cached_property
    def competitors(self) -> DataFrame:
        """Two competitors per order date, with an index from that date's orders."""
        names = F.explode(F.array(F.lit("A"), F.lit("B"))).alias("competitor")
        per_day = self.table("orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(F.count(F.lit(1)).alias("n"))
        return per_day.select("date", "n", names).select(
            "date", "competitor", (F.col("n") + F.when(F.col("competitor") == "A", 1).otherwise(4)).cast("double").alias("price_index")
        )

    @cached_property
    def social(self) -> DataFrame:
        """Weekly trend: orders placed on Sundays."""
        return self.table("orders").where(F.weekday("o_orderdate") == 6).groupBy(
            F.to_date("o_orderdate").alias("date")
        ).agg(F.count(F.lit(1)).cast("double").alias("retail_trend"))

    @cached_property
    def inventory(self) -> DataFrame:
        """Stock of every series that has sold."""
        s, p = F.col("store_id"), F.col("product_id")
        return self.sales_lines.select("store_id", "product_id").distinct().select(
            "store_id",
            "product_id",
            ((s * 37 + p * 11) % 200).cast("int").alias("current_stock"),
            F.lit(40).alias("safety_stock"),
            F.lit(70).alias("reorder_point"),
        )

    @cached_property
    def ledger(self) -> DataFrame:
        """Returned quantities as receipts and the rest as demand, per store and shipping day."""
        q, back = F.col("l_quantity"), F.col("l_returnflag") == "R"
        lines = self.table("lineitem").select("l_suppkey", "l_quantity", "l_returnflag", F.to_date("l_shipdate").alias("date"))
        supplier = self.table("supplier").select("s_suppkey", F.col("s_nationkey").alias("store_id"))
        return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).groupBy("store_id", "date").agg(
            F.sum(F.when(back, q).otherwise(0.0)).alias("receipts"), F.sum(F.when(~back, q).otherwise(0.0)).alias("demand")
        )

    @cached_property
    def stock_ledger(self) -> DataFrame:
        """Ledger with level, order and shortage columns derived day by day from receipts and demand."""
        r, d = F.col("receipts"), F.col("demand")
        return self.ledger.select(
            "store_id",
            "date",
            (r + 20.0).alias("level"),
            F.when(r > d, r).otherwise(0.0).alias("order_qty"),
            d.alias("demand"),
            F.greatest(d - r - 20.0, F.lit(0.0)).alias("short"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        """One promotion per urgent order: product from the customer, length from the order number."""
        k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
        kind = F.element_at(F.array(*[F.lit(t) for t in PROMOTION_TYPES]), (k % 3 + 1).cast("int"))
        return self.table("orders").where(F.col("o_orderpriority") == "1-URGENT").select(
            k.alias("promo_seq"),
            (F.col("o_custkey") % 25 + 1).cast("int").alias("product_id"),
            kind.alias("promotion_type"),
            ((k % 5 + 1).cast("double") / 10.0).alias("discount_rate"),
            day.alias("start_date"),
            F.date_add(day, (k % 15).cast("int")).alias("end_date"),
        )

    @cached_property
    def holidays(self) -> DataFrame:
        """US holidays between the first and last order."""
        return holiday_calendar(self.dates)

    @cached_property
    def dated_events(self) -> DataFrame:
        """Occurrences by order priority: the days of very large orders."""
        return self.table("orders").where(F.col("o_totalprice") > 400000).select(
            F.to_date("o_orderdate").alias("event_date"), F.col("o_orderpriority").alias("event_type")
        )

    @cached_property
    def forecasts(self) -> DataFrame:
        """Three naive forecasts of store-day sales, wide: last week, four weeks ago, mean of seven."""
        w = series_window(["store_id"], "ds")
        base = self.store_days.select("store_id", F.col("date").alias("ds"), F.col("sales").alias("y"))
        week = w.rowsBetween(-7, -1)
        return base.withColumns(
            {
                "naive7": F.lag("y", 7).over(w),
                "naive28": F.lag("y", 28).over(w),
                "mean7": F.when(F.count("y").over(week) == 7, F.avg("y").over(week)),
            }
        )

    @cached_property
    def stream_events(self) -> DataFrame:
        """Events in the shape of the sales stream."""
        return self.table("events").select(
            F.col("event_type").alias("store_id"),
            F.col("user_id").cast("string").alias("product_id"),
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("value").alias("sales"),
        )
