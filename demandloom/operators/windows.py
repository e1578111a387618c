"""Lag, rolling, expanding and momentum features of a series.

Input holds one row per (keys, date); all windows of a bundle share one
exchange on the keys, and a partition is at most one calendar long.  Without
keys the whole table is one series, worked on in blocks (see ``ordered``).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from demandloom.functions.exprs import as_list, ratio, series_window
from demandloom.operators.medians import Frame, with_medians
from demandloom.operators.ordered import carried, in_blocks, with_positions
from demandloom.sources.io import settle

# Default offsets and window lengths in days.
LAGS = (1, 7, 14, 30)
WINDOWS = (7, 14, 30)
FUNCTIONS = ("mean", "std", "min", "max")

_FUNCS = {
    "mean": lambda x: F.avg(x),
    "std": lambda x: F.stddev_samp(x),
    "min": lambda x: F.min(x),
    "max": lambda x: F.max(x),
    "sum": lambda x: F.sum(x),
}


def lags(
    df: DataFrame,
    columns: Sequence[str] | str,
    periods: Sequence[int] = LAGS,
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
    drop_null: bool = False,
) -> DataFrame:
    """``{column}_lag_{k}`` for every column and period."""
    if not as_list(keys):
        return in_blocks(df, as_list(order), max(periods), lambda d, k, o: lags(d, columns, periods, k, o, drop_null)).drop("_pos")
    w = series_window(keys, order)
    made = {f"{c}_lag_{k}": F.lag(c, k).over(w) for c in as_list(columns) for k in periods}
    out = df.withColumns(made)
    return out.na.drop(subset=list(made)) if drop_null else out


def _over(x: Column, func: str, frame: WindowSpec, min_periods: int) -> Column:
    value = _FUNCS[func](x).over(frame)
    return value if min_periods <= 1 else F.when(F.count(x).over(frame) >= min_periods, value)


def rolling(
    df: DataFrame,
    columns: Sequence[str] | str,
    windows: Sequence[int] = WINDOWS,
    functions: Sequence[str] = FUNCTIONS,
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
    full: bool = False,
    drop_null: bool = False,
) -> DataFrame:
    """``{column}_rolling_{w}_{f}`` over the last w rows; ``full`` needs w known values."""
    if not as_list(keys):
        return in_blocks(df, as_list(order), max(windows) - 1, lambda d, k, o: rolling(d, columns, windows, functions, k, o, full, drop_null)).drop("_pos")
    base = series_window(keys, order)
    made, medians = {}, {}
    for c in as_list(columns):
        for w in windows:
            frame = base.rowsBetween(-(w - 1), 0)
            for f in functions:
                name = f"{c}_rolling_{w}_{f}"
                if f == "median":
                    medians[name] = Frame(c, w, w if full else 1)
                else:
                    made[name] = _over(F.col(c), f, frame, w if full else 1)
    names = [f"{c}_rolling_{w}_{f}" for c in as_list(columns) for w in windows for f in functions]
    out = _with_frames(df, made, medians, names, keys, order)
    return out.na.drop(subset=names) if drop_null else out


def _with_frames(df: DataFrame, made: dict[str, Column], medians: dict[str, Frame], names: Sequence[str], keys, order) -> DataFrame:
    """Window columns, and medians from one ordered pass over the same partitions, in the order of ``names``."""
    if not medians:
        return df.withColumns(made)
    rows = df.repartition(*as_list(keys)).withColumns(made) if made else df
    return with_medians(rows, medians, keys, order).select(*df.columns, *names)


def expanding(
    df: DataFrame,
    columns: Sequence[str] | str,
    functions: Sequence[str] = FUNCTIONS,
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
) -> DataFrame:
    """``{column}_expanding_{f}`` over all rows so far.

    A running median keeps the values so far of one series, two heaps that
    each row enters.  Without keys give a table of one row per date: it is one
    series and one task.
    """
    if not as_list(keys):
        return expanding(df.withColumn("_all", F.lit(0)), columns, functions, ["_all"], order).drop("_all")
    frame = series_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    names = [f"{c}_expanding_{f}" for c in as_list(columns) for f in functions]
    made = {f"{c}_expanding_{f}": _FUNCS[f](F.col(c)).over(frame) for c in as_list(columns) for f in functions if f != "median"}
    medians = {f"{c}_expanding_median": Frame(c) for c in as_list(columns) if "median" in functions}
    return _with_frames(df, made, medians, names, keys, order)


def diffs(
    df: DataFrame,
    column: str,
    periods: Sequence[int] = (1, 7, 30),
    keys: Sequence[str] = (),
    order: str | Sequence[str] = "date",
    names: Sequence[str] | None = None,
) -> DataFrame:
    if not as_list(keys):
        return in_blocks(df, as_list(order), max(periods), lambda d, k, o: diffs(d, column, periods, k, o, names)).drop("_pos")
    w = series_window(keys, order)
    names = list(names) if names else [f"{column}_diff_{k}" for k in periods]
    return df.withColumns({n: F.col(column) - F.lag(column, k).over(w) for n, k in zip(names, periods)})


def lagged_roll_mean(
    df: DataFrame, column: str, window: int = 7, keys: Sequence[str] = (), order="date", name: str | None = None
) -> DataFrame:
    """Mean of the previous ``window`` rows without the current one; NULL until all are known."""
    if not as_list(keys):
        return in_blocks(df, as_list(order), window, lambda d, k, o: lagged_roll_mean(d, column, window, k, o, name)).drop("_pos")
    frame = series_window(keys, order).rowsBetween(-window, -1)
    return df.withColumn(name or f"{column}_lag_{window}d_avg", _over(F.col(column), "mean", frame, window))


def velocity(
    df: DataFrame, column: str, keys: Sequence[str] = (), order="date", windows: Sequence[int] = (7, 30), prefix="sales"
) -> DataFrame:
    """Rolling means of the one-step difference, and the change of the first of them."""
    if not as_list(keys):
        return in_blocks(df, as_list(order), max(windows) + 1, lambda d, k, o: velocity(d, column, k, o, windows, prefix)).drop("_pos")
    base = series_window(keys, order)
    df = df.withColumn("_d", F.col(column) - F.lag(column, 1).over(base))
    made = {
        f"{prefix}_velocity_{w}d": _over(F.col("_d"), "mean", base.rowsBetween(-(w - 1), 0), w) for w in windows
    }
    df = df.withColumns(made).drop("_d")
    first = f"{prefix}_velocity_{windows[0]}d"
    return df.withColumn(f"{prefix}_accel_{windows[0]}d", F.col(first) - F.lag(first, 1).over(base))


def _memory(span: int) -> int:
    """Rows after which a weight is less than one unit in the last place."""
    decay = 1.0 - 2.0 / (span + 1.0)
    return max(2, math.ceil(37.0 / -math.log(decay))) if decay > 0 else 2


def _ewm_whole_table(df: DataFrame, column: str, spans: Sequence[int], order: Sequence[str], names: Sequence[str]) -> DataFrame:
    """At a known value only so many rows before it count; rows without one repeat the last result, however far back."""
    placed = with_positions(df, order)
    reach = max(map(_memory, spans))
    near = settle(in_blocks(placed, order, reach, lambda d, k, o: ewm_mean(d, column, spans, k, o, names)), "ewm")
    last = {f"_e_{n}": F.when(F.col(column).isNotNull(), F.col(n)) for n in names}
    return carried(near, last).select(*df.columns, *[F.col(f"_e_{n}").alias(n) for n in names])


def ewm_mean(
    df: DataFrame,
    column: str,
    spans: Sequence[int] = (7, 30),
    keys: Sequence[str] = (),
    order="date",
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Exponentially weighted mean with adjusted weights; NULL rows still age the weights.

    Weighted running sums need b**-k, which overflows on long series.  Rows are
    therefore cut into blocks so long that anything before the previous block
    weighs less than one unit in the last place; within a block the power is
    small, and the previous block enters through its closing sum.
    """
    keys = as_list(keys)
    names = list(names) if names else [f"{column}_ewm_{s}" for s in spans]
    if not keys:
        return _ewm_whole_table(df, column, spans, as_list(order), names)
    base = series_window(keys, order)
    kept = df.columns
    df = df.withColumn("_k", F.row_number().over(base) - 1)
    for span, name in zip(spans, names):
        decay = 1.0 - 2.0 / (span + 1.0)
        length = _memory(span)
        if decay <= 0:
            df = df.withColumn(name, F.last(column, ignorenulls=True).over(base.rowsBetween(Window.unboundedPreceding, 0)))
            continue
        x = F.col(column).cast("double")
        pos = F.col("_k") % length
        grow = F.pow(F.lit(1.0 / decay), pos)
        df = df.withColumns({"_blk": F.floor(F.col("_k") / length), "_at": pos})
        inner = series_window([*keys, "_blk"], order).rowsBetween(Window.unboundedPreceding, 0)
        shrink = F.pow(F.lit(decay), F.col("_at"))
        df = df.withColumns(
            {
                "_s": F.sum(F.when(x.isNotNull(), x * grow)).over(inner) * shrink,
                "_w": F.sum(F.when(x.isNotNull(), grow)).over(inner) * shrink,
            }
        )
        before = base.rowsBetween(Window.unboundedPreceding, -1)
        close = F.when(F.col("_at") == length - 1, F.struct(F.coalesce("_s", F.lit(0.0)).alias("s"),
                                                             F.coalesce("_w", F.lit(0.0)).alias("w")))
        carried = F.last(close, ignorenulls=True).over(before)
        df = df.withColumn("_c", carried)
        fade = F.pow(F.lit(decay), F.col("_at") + 1)
        total = F.coalesce("_s", F.lit(0.0)) + fade * F.coalesce(F.col("_c.s"), F.lit(0.0))
        weight = F.coalesce("_w", F.lit(0.0)) + fade * F.coalesce(F.col("_c.w"), F.lit(0.0))
        df = df.withColumn(name, ratio(total, weight))
    return df.select(*kept, *names)


def group_scaled(
    df: DataFrame, column: str, keys: Sequence[str], names: tuple[str | None, str | None] = ("zscore", "normalized")
) -> DataFrame:
    """Per-series z-score (sample deviation) and min-max position, by partial aggregates joined back."""
    stats = df.groupBy(*keys).agg(
        F.avg(column).alias("_m"), F.stddev_samp(column).alias("_s"), F.min(column).alias("_lo"), F.max(column).alias("_hi")
    )
    x = F.col(column)
    made = {}
    if names[0]:
        made[names[0]] = ratio(x - F.col("_m"), F.col("_s"))
    if names[1]:
        made[names[1]] = ratio(x - F.col("_lo"), F.col("_hi") - F.col("_lo"))
    return df.join(stats, list(keys), "left").withColumns(made).select(*df.columns, *made)


def pct_rank_avg(df: DataFrame, column: str, keys: Sequence[str], name: str = "percentile") -> DataFrame:
    """Rank as a share of the known values; equal values take their mean rank; NULL stays NULL."""
    x = F.col(column)
    ordered = Window.partitionBy(*keys).orderBy(x.asc_nulls_last())
    ties = F.count(F.lit(1)).over(Window.partitionBy(*keys, column))
    known = F.count(x).over(Window.partitionBy(*keys))
    share = ratio(F.rank().over(ordered) + (ties - 1) / F.lit(2.0), known)
    return df.withColumn(name, F.when(x.isNotNull(), share))


def sales_velocity_features(
    df: DataFrame, column: str = "sales", keys: Sequence[str] = ("store_id", "product_id"), order="date"
) -> DataFrame:
    """Differences, velocity, acceleration, momentum, trend and normalised position, with one exchange."""
    keys = list(keys)
    out = diffs(df, column, (1, 7, 30), keys, order, ["sales_diff_1d", "sales_diff_7d", "sales_diff_30d"])
    out = velocity(out, column, keys, order)
    out = ewm_mean(out, column, (7, 30), keys, order, ["sales_momentum_7d", "sales_momentum_30d"])
    out = out.withColumn("sales_trend", ratio("sales_momentum_7d", "sales_momentum_30d"))
    # The rows already sit by series here, so whole-series windows cost no further exchange.
    whole = Window.partitionBy(*keys)
    x = F.col(column)
    lo, hi = F.min(x).over(whole), F.max(x).over(whole)
    out = out.withColumns(
        {
            "sales_zscore": ratio(x - F.avg(x).over(whole), F.stddev_samp(x).over(whole)),
            "sales_normalized": ratio(x - lo, hi - lo),
        }
    )
    return pct_rank_avg(out, column, keys, "sales_percentile")
