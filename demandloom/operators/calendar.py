"""Calendar completion, resampling and date-set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.dates import period_end, period_step
from demandloom.functions.exprs import as_list, numeric_columns, ratio, scalar_struct, series_window
from demandloom.operators.missing import fill, fill_series
from demandloom.operators.quantiles import exact_quantiles


def date_spine(df: DataFrame, keys: Sequence[str] = (), date: str = "date", freq: str = "D") -> DataFrame:
    """Every period label between the first and last date of each series."""
    keys = list(keys)
    first, last = F.min(date).cast("date"), F.max(date).cast("date")
    ends = df.groupBy(*keys).agg(first.alias("_a"), last.alias("_b"))
    return ends.select(*keys, F.explode(_labels(F.col("_a"), F.col("_b"), freq)).alias(date))


def _labels(a: Column, b: Column, freq: str) -> Column:
    """Period-end labels from the period of ``a`` to that of ``b``; NULL ends give none."""
    if freq in ("D", "W"):
        return F.sequence(period_end(a, freq), period_end(b, freq), F.expr(period_step(freq)))
    unit = {"M": "month", "Q": "quarter", "Y": "year"}[freq]
    starts = F.sequence(F.trunc(a, unit), F.trunc(b, unit), F.expr(period_step(freq)))
    return F.transform(starts, lambda d: period_end(d, freq))


def _with_gaps(df: DataFrame, keys: Sequence[str], date: str, freq: str = "D") -> DataFrame:
    """Each row followed by empty rows up to the next date of its series: one exchange, no join.

    Dates must be labels of ``freq``.  Added rows hold the keys and the date only.
    """
    known = df.where(F.col(date).isNotNull()).withColumn(date, F.col(date).cast("date"))
    known = known.withColumn("_next", F.lead(date).over(series_window(keys, date)))
    here = F.array(F.col(date))
    ahead = _labels(F.col(date), F.col("_next"), freq)
    run = F.when(F.col("_next") > F.col(date), F.slice(ahead, 1, F.greatest(F.size(ahead) - 1, F.lit(1)))).otherwise(here)
    spread = known.select("*", F.explode(run).alias("_d"))
    values = [
        F.when(F.col("_d") == F.col(date), F.col(c)).alias(c) for c in df.columns if c not in {*keys, date}
    ]
    return spread.select(*keys, F.col("_d").alias(date), *values).select(*df.columns)


def calendar_fill(
    df: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    columns: Sequence[str] | None = None,
    method: str | None = "ffill",
    freq: str = "D",
) -> DataFrame:
    """Add the missing dates of every series, then fill ``columns`` in one direction only.

    With a coarser ``freq`` the result has its labels, and other dates are left out.
    """
    keys = list(keys)
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in {*keys, date}]
    if freq == "D":
        dense = _with_gaps(df, keys, date)
    else:
        dated = df.withColumn(date, F.col(date).cast("date"))
        dense = date_spine(df, keys, date, freq).join(dated, [*keys, date], "left").select(*df.columns)
    if method is None:
        return dense
    if method == "interpolate":
        columns = [c for c in columns if c in numeric_columns(df)]
    return fill_series(dense, columns, method, keys, date, edges=False)


_AGGREGATES = {
    "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)),
    "mean": F.avg,
    "min": F.min,
    "max": F.max,
}


def resample(
    df: DataFrame,
    columns: Sequence[str],
    freq: str = "D",
    agg: str | Mapping[str, str] = "sum",
    keys: Sequence[str] = (),
    date: str = "date",
) -> DataFrame:
    """Aggregate to period-end labels; empty periods are present (sum 0, others NULL)."""
    keys = list(keys)
    how = {c: (agg if isinstance(agg, str) else agg.get(c, "sum")) for c in columns}
    labelled = df.withColumn(date, period_end(F.col(date).cast("date"), freq))
    simple = [_AGGREGATES[how[c]](c).alias(c) for c in columns if how[c] != "median"]
    binned = labelled.groupBy(*keys, date).agg(*simple) if simple else labelled.select(*keys, date).distinct()
    for c in [c for c in columns if how[c] == "median"]:
        medians = exact_quantiles(labelled, c, [0.5], [*keys, date], names=[c])
        binned = binned.join(medians, [*keys, date], "left")
    binned = binned.select(*keys, date, *columns)
    dense = _with_gaps(binned, keys, date, freq)
    zeros = {c: F.coalesce(c, F.lit(0)) for c in columns if how[c] == "sum"}
    return dense.withColumns(zeros) if zeros else dense


def missing_dates(df: DataFrame, keys: Sequence[str] = (), date: str = "date") -> DataFrame:
    """Calendar days between first and last date that a series does not have."""
    days = df.select(*keys, F.col(date).cast("date").alias(date)).where(F.col(date).isNotNull()).distinct()
    ahead = days.withColumn("_next", F.lead(date).over(series_window(keys, date)))
    gaps = ahead.where(F.datediff("_next", date) > 1)
    between = F.explode(F.sequence(F.date_add(date, 1), F.date_sub("_next", 1)))
    return gaps.select(*keys, between.alias(date))


def dedupe_dates(
    df: DataFrame, order: Sequence[str] | str, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """Keep the first row per (series, date) by ``order``.

    ``min_by`` combines on the map side, so a date with very many copies is
    never gathered.
    """
    keys = [*keys, date]
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*as_list(order))).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def clean_external(
    df: DataFrame, order: Sequence[str] | str | None = None, keys: Sequence[str] = (), date: str = "date"
) -> DataFrame:
    """One row per day without gaps: drop duplicate dates, add days, interpolate numerics to the edges."""
    numeric = numeric_columns(df, {*keys, date})
    single = dedupe_dates(df, order or [c for c in df.columns if c not in {*keys, date}], keys, date)
    dense = calendar_fill(single, keys, date, method=None)
    return fill_series(dense, numeric, "interpolate", keys, date)


def external_outliers(
    df: DataFrame, columns: Sequence[str] | None = None, threshold: float = 3.0, date: str = "date"
) -> DataFrame:
    """(column, outliers): values further than ``threshold`` sample deviations from the mean."""
    columns = list(columns) if columns else numeric_columns(df, {date})
    stats = scalar_struct(
        df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(c) for c in columns])
    )

    def far(c: str) -> Column:
        s = stats.getField(c)
        return F.abs(ratio(F.col(c) - s.getField("m"), s.getField("s"))) > threshold

    row = df.agg(*[F.count(F.when(far(c), 1)).alias(c) for c in columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("outliers")) for c in columns])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def preprocess_series(
    df: DataFrame, keys: Sequence[str] = ("store_id", "product_id"), date: str = "date"
) -> DataFrame:
    """Per series: fill gaps both ways, then clip every numeric column to 1.5 IQR of the filled values.

    All windows share one exchange on the keys; a constant column is left as is.
    """
    numeric = numeric_columns(df, {*keys, date})
    df = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    filled = fill(df, numeric, "ffill", keys, date)
    whole = Window.partitionBy(*keys)
    quartiles = {f"_q_{c}": F.percentile(c, F.array(F.lit(0.25), F.lit(0.75))).over(whole) for c in numeric}
    clipped = {}
    for c in numeric:
        lo, hi = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        reach = (hi - lo) * 1.5
        bounded = F.least(F.greatest(F.col(c), lo - reach), hi + reach)
        clipped[c] = F.when(F.col(c).isNotNull(), bounded)
    return filled.withColumns(quartiles).withColumns(clipped).drop(*quartiles)
