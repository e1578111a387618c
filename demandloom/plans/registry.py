"""Query registry: a Spark query and, where SQL can express it, its DuckDB twin."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.plans.oracle_views import VIEWS
from demandloom.sources.retail import RetailTables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` and its SQL text under an operator id."""

    def register(fn: Callable[[RetailTables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, path: fn(RetailTables(spark, path))
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return register


def with_views(sql: str) -> str:
    """Prefix the retail views a statement uses, in dependency order."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                if name not in wanted:
                    wanted.append(name)

    visit(sql)
    if not wanted:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in wanted)
    body = sql.strip()
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def r6(df: DataFrame, *columns: str) -> DataFrame:
    """Round computed doubles to 6 digits so that both engines' last bits agree."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, 6) for c in names})
