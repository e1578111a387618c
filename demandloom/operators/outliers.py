"""Outlier removal, capping and flagging, over the whole table or per group.

Groups here are arbitrary and may be very large, so statistics come from
partial aggregation (or range-split exact quantiles) and are joined back;
nothing gathers a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exprs import as_list, numeric_columns, ratio, scalar_struct
from demandloom.operators.quantiles import exact_quantiles
from demandloom.sources.io import settle

_TEMP = ["_a", "_b"]


def _with_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], now: bool = False) -> DataFrame:
    """Attach the two-column statistics ``_a, _b`` to every row.

    ``now`` computes them at once (one row on the driver, or a small table in
    the shared folder), so that a chain over many columns plans in proportion
    to their number.
    """
    if now and not keys:
        row = stats.first()
        return df.withColumns({t: F.lit(row[t]).cast("double") for t in _TEMP})
    if keys:
        stats = settle(stats, "bounds") if now else stats
        return df.join(stats, list(keys), "left")
    one = scalar_struct(stats)
    return df.withColumns({t: one.getField(t) for t in _TEMP})


def _with_quantiles(df: DataFrame, column: str, probs: Sequence[float], keys: Sequence[str], now: bool = False) -> DataFrame:
    return _with_stats(df, exact_quantiles(df, column, probs, keys, names=_TEMP), keys, now)


def _winsorize_all(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Cap all columns at once: their values are counted in one pass, keyed by column."""
    pairs = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_x")) for c in columns])
    long = df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p._col", "_p._x")
    found = exact_quantiles(long, "_x", probs, ["_col", *keys], names=_TEMP)
    wide = found.groupBy(*keys).agg(*[F.max(F.when(F.col("_col") == c, F.struct(*_TEMP))).alias(f"_q_{c}") for c in columns])
    names = [f"_q_{c}" for c in columns]
    if keys:
        out = df.join(wide, list(keys), "left")
    else:
        one = scalar_struct(wide)
        out = df.withColumns({n: one.getField(n) for n in names})

    def capped(c: str) -> Column:
        x, lo, hi = F.col(c), F.col(f"_q_{c}").getField("_a"), F.col(f"_q_{c}").getField("_b")
        return F.when(x < lo, lo).when(x > hi, hi).otherwise(x.cast("double"))

    return out.withColumns({c: capped(c) for c in columns}).select(*df.columns)


def _with_moments(df: DataFrame, column: str, keys: Sequence[str], sample: bool, now: bool = False) -> DataFrame:
    spread = F.stddev_samp(column) if sample else F.stddev_pop(column)
    return _with_stats(df, df.groupBy(*keys).agg(F.avg(column).alias("_a"), spread.alias("_b")), keys, now)


def _zscore(column: str) -> Column:
    return F.abs(ratio(F.col(column) - F.col("_a"), F.col("_b")))


def _outside_iqr(column: str, multiplier: float) -> Column:
    reach = (F.col("_b") - F.col("_a")) * multiplier
    x = F.col(column)
    return (x < F.col("_a") - reach) | (x > F.col("_b") + reach)


def remove_outliers(df: DataFrame, columns: Sequence[str], method: str = "zscore", threshold: float = 3.0) -> DataFrame:
    """Drop rows column by column, each time with statistics of the rows still left.

    ``zscore`` uses the sample deviation; ``iqr`` keeps Q1 - t*IQR .. Q3 + t*IQR.
    Non-numeric or absent columns are skipped; NULLs are dropped.
    """
    numeric = set(numeric_columns(df))
    columns = [c for c in columns if c in numeric]
    now = len(columns) > 1
    for c in columns:
        if method == "zscore":
            df = _with_moments(df, c, (), sample=True, now=now).where(_zscore(c) <= threshold)
        elif method == "iqr":
            df = _with_quantiles(df, c, [0.25, 0.75], (), now).where(~_outside_iqr(c, threshold))
        else:
            raise ValueError(f"unknown method: {method}")
        df = df.drop(*_TEMP)
    return df


def handle_outliers(
    df: DataFrame,
    method: str = "winsorize",
    columns: Sequence[str] | str | None = None,
    limits: tuple[float, float] = (0.01, 0.01),
    threshold: float = 3.0,
    groupby: Sequence[str] | str | None = None,
) -> DataFrame:
    """``winsorize`` caps at the limit percentiles; ``trim``, ``zscore`` and ``iqr`` drop rows.

    ``zscore`` uses the population deviation and keeps constant groups.  Rows of
    a NULL group are not examined.
    """
    keys = as_list(groupby)
    columns = as_list(columns) or numeric_columns(df, keys)
    if method == "winsorize":
        return _winsorize_all(df, columns, [limits[0], 1 - limits[1]], keys)
    now = len(columns) > 1
    for c in columns:
        x = F.col(c)
        if method == "trim":
            out = _with_quantiles(df, c, [limits[0], 1 - limits[1]], keys, now)
            out = out.where(_keep(x.between(F.col("_a"), F.col("_b")), keys, null_value=False))
        elif method == "zscore":
            out = _with_moments(df, c, keys, sample=False, now=now)
            z = _zscore(c)
            constant = F.col("_b") == 0
            inside = (z <= threshold) | constant
            out = out.where(_keep(inside, keys, null_value=bool(keys)))
        elif method == "iqr":
            out = _with_quantiles(df, c, [0.25, 0.75], keys, now)
            out = out.where(_keep(~_outside_iqr(c, 1.5), keys, null_value=False))
        else:
            raise ValueError(f"unknown method: {method}")
        df = out.select(*df.columns)
    return df


def _keep(inside: Column, keys: Sequence[str], null_value: bool) -> Column:
    known = F.coalesce(inside, F.lit(null_value))
    for k in keys:
        known = known | F.col(k).isNull()
    return known


def detect_outliers(
    df: DataFrame,
    column: str,
    method: str = "zscore",
    threshold: float = 3.0,
    groupby: Sequence[str] | str | None = None,
    output: str = "is_outlier",
) -> DataFrame:
    """Add a boolean column: population z-score over ``threshold``, or outside 1.5 IQR."""
    keys = as_list(groupby)
    if method == "zscore":
        out = _with_moments(df, column, keys, sample=False)
        found = F.coalesce(_zscore(column) > threshold, F.lit(False))
    elif method == "iqr":
        out = _with_quantiles(df, column, [0.25, 0.75], keys)
        found = F.coalesce(_outside_iqr(column, 1.5), F.lit(True))
    else:
        raise ValueError(f"unknown method: {method}")
    for k in keys:
        found = found & F.col(k).isNotNull()
    return out.withColumn(output, found).select(*df.columns, output)
