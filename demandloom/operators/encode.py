"""Type casts, categorical encodings and selections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import as_list, cut
from demandloom.operators.aggregate import row_positions


def cast_dates(df: DataFrame, columns: Sequence[str], to: str = "timestamp", formats: str | None = None) -> DataFrame:
    """Parse date columns; unreadable text becomes NULL, absent columns are skipped."""
    parse = {"timestamp": F.try_to_timestamp, "date": F.try_to_date}[to]
    made = {}
    for c in columns:
        if c in df.columns:
            text = F.col(c).cast("string")
            if formats is None:
                made[c] = parse(text)
            else:
                made[c] = parse(text, F.lit(formats)) if to == "timestamp" else parse(text, formats)
    return df.withColumns(made) if made else df


def category_values(df: DataFrame, column: str, limit: int = 1000) -> list:
    """Sorted distinct values of a categorical column; refuses columns that are not categorical."""
    rows = df.select(column).where(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} values; pass the wanted values or use one_hot_index")
    return sorted(r[0] for r in rows)


def one_hot(
    df: DataFrame,
    columns: Sequence[str] | str,
    values: Mapping[str, Sequence] | None = None,
    keep_original: bool = False,
) -> DataFrame:
    """``{column}_{value}`` 0/1 columns; NULL gives 0 everywhere.

    Values come from ``values`` (no job) or from one distinct query per column.
    """
    made = {}
    columns = [c for c in as_list(columns) if c in df.columns]
    for c in columns:
        known = (values or {}).get(c)
        for v in known if known is not None else category_values(df, c):
            made[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
    out = df.withColumns(made) if made else df
    return out if keep_original else out.drop(*columns)


def one_hot_index(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """``{column}_index``: place of the value among the column's sorted distinct values, NULL for NULL.

    The form for columns with any number of values: one indicator is set per
    row, so its place says all, and Spark ML's encoder takes it as it is.
    Values are ordered and joined as tables; nothing is read by the driver but
    bounds.
    """
    for c in [c for c in as_list(columns) if c in df.columns]:
        values = df.select(c).where(F.col(c).isNotNull()).distinct()
        places = row_positions(values, [c]).select(c, F.col("_pos").cast("long").alias(f"{c}_index"))
        df = df.join(places, c, "left")
    return df


def bin_values(
    df: DataFrame, column: str, edges: Sequence[float], labels: Sequence[str], output: str | None = None
) -> DataFrame:
    """Right-closed labelled bins; outside every bin gives NULL."""
    return df.withColumn(output or f"{column}_bin", cut(column, edges, labels))


def rename_ds_y(
    df: DataFrame, date: str = "date", target: str = "sales", regressors: Sequence[str] = (), keys: Sequence[str] = ()
) -> DataFrame:
    """Forecast input: keys, ``ds``, ``y`` and the regressors.

    A missing ``is_holiday`` is 0; ``temperature`` may come from any column
    containing that word; another absent regressor is an error.
    """
    picked = []
    for r in regressors:
        if r in df.columns:
            picked.append(F.col(r))
        elif r == "is_holiday":
            picked.append(F.lit(0).alias(r))
        else:
            near = [c for c in df.columns if r == "temperature" and "temperature" in c.lower()]
            if not near:
                raise ValueError(f"no column for regressor {r}")
            picked.append(F.col(near[0]).alias(r))
    return df.select(*keys, F.col(date).cast("date").alias("ds"), F.col(target).cast("double").alias("y"), *picked)


def select_var_columns(df: DataFrame, columns: Sequence[str], date: str = "date", keys: Sequence[str] = ()) -> DataFrame:
    """Keys, date and the wanted columns; an absent column is an error, never made up."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not in table: {absent}")
    return df.select(*keys, F.col(date).cast("date").alias(date), *[F.col(c).cast("double").alias(c) for c in columns])


def filter_series(df: DataFrame, **equals) -> DataFrame:
    """Rows of one series; the equality reaches the scan."""
    for c, v in equals.items():
        df = df.where(F.col(c) == F.lit(v))
    return df


def filter_active(df: DataFrame, dimension: DataFrame, key: str, flag: str = "is_active") -> DataFrame:
    """Facts of the dimension rows whose flag is true."""
    return df.join(dimension.where(F.col(flag)).select(key), key, "left_semi")
