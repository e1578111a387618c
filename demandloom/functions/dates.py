"""Calendar expressions: date parts, cyclic encodings and period-end labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_end(d: Column, freq: str) -> Column:
    """Label of the period holding ``d``: D the day, W the Sunday, M/Q/Y the last day."""
    if freq == "D":
        return d
    if freq == "W":
        return F.next_day(F.date_sub(d, 1), "Sun")
    if freq == "M":
        return F.last_day(d)
    if freq == "Q":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if freq == "Y":
        return F.last_day(F.add_months(F.trunc(d, "year"), 11))
    raise ValueError(f"unknown frequency: {freq}")


def period_step(freq: str) -> str:
    """Interval literal between two consecutive labels, counted on first days for M/Q/Y."""
    return {
        "D": "interval 1 day",
        "W": "interval 7 days",
        "M": "interval 1 month",
        "Q": "interval 3 months",
        "Y": "interval 12 months",
    }[freq]


def flag(cond: Column) -> Column:
    """1/0 integer; NULL counts as 0."""
    return F.when(cond, 1).otherwise(0)


def cyclic(part: Column, period: float) -> tuple[Column, Column]:
    angle = part.cast("double") * (2.0 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_parts(d: Column) -> dict[str, Column]:
    """Integer date parts and start/end flags; Monday is day 0 of the week."""
    first_of_month = F.dayofmonth(d) == 1
    last_of_month = d == F.last_day(d)
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year": F.year(d),
        "week_of_year": F.weekofyear(d),
        "is_weekend": flag(F.weekday(d) >= 5),
        "is_month_end": flag(last_of_month),
        "is_month_start": flag(first_of_month),
        "is_quarter_end": flag(last_of_month & (F.month(d) % 3 == 0)),
        "is_quarter_start": flag(first_of_month & (F.month(d) % 3 == 1)),
        "is_year_end": flag(last_of_month & (F.month(d) == 12)),
        "is_year_start": flag(first_of_month & (F.month(d) == 1)),
    }
