"""Column expression helpers shared by the operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_list(cols: str | Iterable[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric column names in schema order; resolved without running a job."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN doubles become NULL, so that every operator has one notion of missing."""
    floats = {
        f.name: F.when(~F.isnan(f.name), F.col(f.name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    }
    return df.withColumns(floats) if floats else df


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` in doubles; NULL where the denominator is zero (ANSI mode would raise)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def slug(name: str) -> str:
    """Column-name form of a label: lower case, blanks to underscores, apostrophes dropped."""
    return re.sub(r"'", "", name.lower().replace(" ", "_"))


def slug_column(col: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(col), " ", "_"), "'", "")


def cut(col: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins ``(lo, hi]``; values outside every bin give NULL."""
    if len(edges) != len(labels) + 1:
        raise ValueError("need one more edge than labels")
    x = F.col(col) if isinstance(col, str) else col
    out = None
    for lo, hi, label in zip(edges, edges[1:], labels):
        inside = (x > F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def z_value(p: float) -> float:
    """Standard normal quantile."""
    return NormalDist().inv_cdf(p)


def series_window(keys: Iterable[str], order: str | Sequence[str], descending: bool = False) -> WindowSpec:
    """Rows of one series in time order.

    A series holds one row per date (see ``aggregate.daily_series``), so a
    window partition is bounded by the calendar, not by the fact volume.
    """
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in as_list(order)]
    return Window.partitionBy(*as_list(keys)).orderBy(*cols)


def scalar_struct(stats: DataFrame) -> Column:
    """A one-row DataFrame as one struct column: a scalar subquery, run once, no join."""
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def join_on_keys(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join; Spark picks broadcast or a skew-splitting sort-merge join from real sizes."""
    return df.join(other, list(keys), how)
