"""Calendar feature bundles: projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.functions.dates import calendar_parts, cyclic


def time_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Date parts, period flags and cyclic day-of-week, month and day-of-year (period 365)."""
    d = F.col(date)
    parts = calendar_parts(d)
    for name, period in (("day_of_week", 7), ("month", 12), ("day_of_year", 365)):
        parts[f"{name}_sin"], parts[f"{name}_cos"] = cyclic(parts[name], period)
    return df.withColumns(parts)


def date_features_wide(df: DataFrame, date: str = "date", drop_date: bool = False) -> DataFrame:
    """Like ``time_features`` with ``day`` (cyclic over 31) and day-of-year over 366."""
    d = F.col(date)
    parts = calendar_parts(d)
    parts["day"] = parts.pop("day_of_month")
    for name, period in (("month", 12), ("day", 31), ("day_of_week", 7), ("day_of_year", 366)):
        parts[f"{name}_sin"], parts[f"{name}_cos"] = cyclic(parts[name], period)
    out = df.withColumns(parts)
    return out.drop(date) if drop_date else out


# The parts this variant exposes, by name.
SUNDAY1_PARTS = (
    "year", "month", "day", "day_of_week", "day_of_year", "week_of_year", "quarter",
    "is_weekend", "is_month_start", "is_month_end",
)


def time_features_sunday1(df: DataFrame, date: str = "date") -> DataFrame:
    """Variant with day_of_week counted Sunday=1..Saturday=7 and month flags only."""
    parts = calendar_parts(F.col(date))
    parts["day"] = parts["day_of_month"]
    parts["day_of_week"] = F.dayofweek(date)
    out = {name: parts[name] for name in SUNDAY1_PARTS}
    for name, period in (("month", 12), ("day_of_week", 7)):
        out[f"{name}_sin"], out[f"{name}_cos"] = cyclic(parts[name], period)
    return df.withColumns(out)


def gbt_date_features(df: DataFrame, date: str = "date") -> DataFrame:
    d = F.col(date)
    return df.withColumns(
        {
            "day_of_week": F.weekday(d),
            "day_of_month": F.dayofmonth(d),
            "month": F.month(d),
            "year": F.year(d),
        }
    )


def weekday_month_names(df: DataFrame, date: str = "date") -> DataFrame:
    return df.withColumns(
        {"day_name": F.date_format(date, "EEEE"), "month_name": F.date_format(date, "MMMM")}
    )
