"""Joins to external tables: weather, economy, promotions, holidays, events.

External tables are keyed by date (or date and location), so their features
are computed on the small dated table and then joined to the facts by equality.
Interval and nearest-date conditions are turned into equalities by expanding
the small side to days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandloom.functions.dates import flag
from demandloom.functions.exprs import cut, numeric_columns, ratio, scalar_struct, series_window, slug
from demandloom.operators.calendar import calendar_fill
from demandloom.operators.encode import category_values
from demandloom.operators.missing import ffill_expr, fill_series

# Weather bins and thresholds.
TEMPERATURE_EDGES = (-100, 0, 10, 20, 30, 100)
TEMPERATURE_LABELS = ("freezing", "cold", "mild", "warm", "hot")
PRECIPITATION_EDGES = (-1, 0, 5, 10, 20, 100)
PRECIPITATION_LABELS = ("none", "light", "moderate", "heavy", "extreme")
HOT, COLD, WET = 30, 0, 10

# Names that make a holiday a major one, for the two holiday feature sets.
MAJOR_HOLIDAYS = (
    "New Year's Day", "Independence Day", "Thanksgiving", "Christmas Day", "Memorial Day", "Labor Day",
)
MAJOR_HOLIDAY_WORDS = (
    "New Year", "Christmas", "Thanksgiving", "Independence", "Labor Day", "Memorial Day", "Easter", "Halloween",
    "Valentine",
)
NO_HOLIDAY = 99

_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


def _renamed(ext: DataFrame, taken: Sequence[str], on: Sequence[str], suffix: str) -> DataFrame:
    for c in ext.columns:
        if c not in on and c in taken:
            ext = ext.withColumnRenamed(c, c + suffix)
    return ext


def join_external(
    df: DataFrame,
    external: DataFrame | Mapping[str, DataFrame] | Sequence[DataFrame],
    on: str | Sequence[str] = "date",
    how: str = "left",
) -> DataFrame:
    """Join one table, a named set or a sequence; clashing columns get ``_ext``, ``_{name}``, ``_ext_{i}``."""
    on = [on] if isinstance(on, str) else list(on)
    if isinstance(external, DataFrame):
        parts = [("_ext", external)]
    elif isinstance(external, Mapping):
        parts = [(f"_{name}", ext) for name, ext in external.items()]
    elif isinstance(external, Sequence):
        parts = [(f"_ext_{i}", ext) for i, ext in enumerate(external)]
    else:
        raise TypeError("external must be a DataFrame, a mapping or a sequence of DataFrames")
    for suffix, ext in parts:
        if ext is not None and ext.columns:
            df = df.join(_renamed(ext, df.columns, on, suffix), on, how)
    return df


def _filled_by_date(
    base: DataFrame, ext: DataFrame, columns: Sequence[str], method: str, on: Sequence[str], date: str, edges: bool
) -> DataFrame:
    """External columns for every row of ``base`` (the wanted dates), filled in date order.

    Dates, not facts, are ordered here, so the window is as long as the calendar.
    """
    places = [c for c in on if c != date]
    out = base.select(*on).distinct().join(ext, list(on), "left")
    if method == "interpolate":
        columns = [c for c in columns if c in numeric_columns(ext)]
    return fill_series(out, columns, method, places, date, edges=edges) if columns else out


def join_external_fill(
    df: DataFrame,
    external: DataFrame,
    keys: Sequence[str] = (),
    date: str = "date",
    how: str = "left",
    method: str = "ffill",
) -> DataFrame:
    """Join by date with gaps of the external columns filled in one direction, in date order.

    With ``keys`` the facts' own columns are filled too, inside each series.
    """
    ext = _renamed(external, df.columns, [date], "_ext")
    wanted = {"left": [df], "inner": [ext], "right": [ext], "outer": [df, ext]}[how]
    dates = wanted[0].select(date)
    for w in wanted[1:]:
        dates = dates.union(w.select(date))
    added = [c for c in ext.columns if c != date]
    out = df.join(_filled_by_date(dates, ext, added, method, [date], date, edges=False), date, how)
    if not keys:
        return out
    own = [c for c in df.columns if c not in {date, *keys}]
    if method == "interpolate":
        own = [c for c in own if c in numeric_columns(df)]
    return fill_series(out, own, method, keys, date, edges=False)


def join_weather(df: DataFrame, weather: DataFrame, date: str = "date", location: str | None = None) -> DataFrame:
    """Weather by date (and location); columns that clash get ``_weather`` and are filled both ways in date order."""
    by_place = location and location in df.columns and location in weather.columns
    on = [date, location] if by_place else [date]
    ext = _renamed(weather, df.columns, on, "_weather")
    suffixed = [c for c in ext.columns if c.endswith("_weather")]
    return df.join(_filled_by_date(df, ext, suffixed, "ffill", on, date, edges=True), on, "left")


def weather_features(
    facts: DataFrame,
    weather: DataFrame,
    date: str = "date",
    store: str = "store_id",
    columns: Sequence[str] = ("temperature", "precipitation", "is_sunny"),
) -> DataFrame:
    """Weather with bins, extremes, previous day, previous-week mean, change and volatility.

    "Previous" means the previous day on which the store has facts; lags run on
    one row per store and day, not on fact rows.
    """
    columns = [c for c in columns if c in weather.columns]
    days = facts.select(store, date).distinct().join(weather, date, "left")
    w = series_window([store], date)
    week = w.rowsBetween(-7, -1)
    made = {}
    for c in columns:
        x = F.col(c).cast("double")
        made[f"{c}_lag1"] = F.lag(c, 1).over(w)
        made[f"{c}_lag_7d_avg"] = F.when(F.count(x).over(week) == 7, F.avg(x).over(week))
    t, p = F.col("temperature"), F.col("precipitation")
    last7 = w.rowsBetween(-6, 0)
    made["temp_change"] = t - F.lag("temperature", 1).over(w)
    made["precip_change"] = p - F.lag("precipitation", 1).over(w)
    made["temp_volatility"] = F.when(F.count(t).over(last7) == 7, F.stddev_samp(t).over(last7))
    made["temp_bin"] = cut(t, TEMPERATURE_EDGES, TEMPERATURE_LABELS)
    made["precip_bin"] = cut(p, PRECIPITATION_EDGES, PRECIPITATION_LABELS)
    made["is_extreme_hot"] = flag(t > HOT)
    made["is_extreme_cold"] = flag(t < COLD)
    made["is_heavy_rain"] = flag(p > WET)
    return facts.join(days.withColumns(made), [store, date], "left")


def economic_features(
    facts: DataFrame,
    economy: DataFrame,
    date: str = "date",
    indicators: Sequence[str] = ("consumer_confidence_index", "unemployment_rate", "inflation_rate"),
) -> DataFrame:
    """Indicator, its value 30 and 365 days before, absolute and relative changes, and a health index.

    Lags are taken on the daily indicator table.  When all its dates share one
    day of the month it is carried forward to daily first.
    """
    daily = _carried_daily(economy, date)
    present = [c for c in indicators if c in economy.columns]
    w = series_window([], date)
    made = {}
    for c in present:
        x = F.col(c).cast("double")
        for tag, change, days in (("lag1m", "mom", 30), ("lag1y", "yoy", 365)):
            before = F.lag(x, days).over(w)
            made[f"{c}_{tag}"] = before
            made[f"{c}_{change}_change"] = x - before
            made[f"{c}_{change}_pct_change"] = ratio(x - before, before)
    out = facts.join(daily.withColumns(made), date, "left")
    if {"consumer_confidence_index", "unemployment_rate"} <= set(present):
        # Means and deviations over fact rows, from counts per date.
        per_day = facts.groupBy(date).agg(F.count(F.lit(1)).alias("_n")).join(daily, date, "left")
        pair = ("consumer_confidence_index", "unemployment_rate")
        moments = []
        for c in pair:
            n = F.sum(F.when(F.col(c).isNotNull(), F.col("_n")))
            mean = ratio(F.sum(F.col(c) * F.col("_n")), n)
            square = ratio(F.sum(F.col(c) * F.col(c) * F.col("_n")), n)
            moments.append(F.struct(mean.alias("m"), F.sqrt(F.greatest(square - mean * mean, F.lit(0.0))).alias("s")).alias(c))
        s = scalar_struct(per_day.agg(*moments))
        scaled = []
        for c in pair:
            sd = s.getField(c).getField("s")
            scaled.append((F.col(c) - s.getField(c).getField("m")) / F.when(sd == 0, 1.0).otherwise(sd))
        out = out.withColumn("economic_health", scaled[0] - scaled[1])
    return out


def _carried_daily(economy: DataFrame, date: str) -> DataFrame:
    """Daily table: gaps take the last value if the source is monthly, else only given dates count."""
    columns = [c for c in economy.columns if c != date]
    one_day = scalar_struct(economy.agg((F.count_distinct(F.dayofmonth(date)) == 1).alias("monthly"))).getField("monthly")
    tagged = economy.withColumn("_given", F.lit(True))
    dense = calendar_fill(tagged, (), date, columns, method=None)
    carried = {c: F.when(one_day, ffill_expr(F.col(c), (), date, then_bfill=False)).otherwise(F.col(c)) for c in columns}
    return dense.withColumns(carried).where(one_day | F.col("_given")).drop("_given")


def join_economic_asof(facts: DataFrame, economy: DataFrame, date: str = "date", mode: str = "asof") -> DataFrame:
    """Indicator columns for each fact date: the last row on or before it (``asof``), or that date's own (``exact``).

    The carrying runs over distinct dates only.
    """
    if mode not in ("asof", "exact"):
        raise ValueError(f"mode {mode}")
    columns = [c for c in economy.columns if c != date]
    renamed = {c: (c + "_economic" if c in facts.columns else c) for c in columns}
    rows = economy.select(date, F.struct(*[F.col(c).alias(renamed[c]) for c in columns]).alias("_e"))
    known = rows.unionByName(facts.select(date).distinct(), allowMissingColumns=True)
    known = known.groupBy(date).agg(F.max("_e").alias("_e"))
    if mode == "asof":
        known = known.withColumn("_e", F.last("_e", ignorenulls=True).over(series_window([], date).rowsBetween(*_TO_HERE)))
    asof = known.select(date, "_e")
    joined = facts.join(asof, date, "left")
    return joined.select(*facts.columns, *[F.col("_e").getField(renamed[c]).alias(renamed[c]) for c in columns])


def is_sparse(facts: DataFrame, economy: DataFrame, date: str = "date", per_days: int = 28) -> bool:
    """Whether an indicator has fewer dates than one per ``per_days`` days of the facts' span (reads two aggregates)."""
    days = facts.agg(F.datediff(F.max(date), F.min(date))).first()[0]
    return economy.agg(F.count_distinct(date)).first()[0] < (days or 0) / per_days


def event_flags(
    df: DataFrame,
    events: DataFrame,
    date: str = "date",
    event_date: str = "event_date",
    event_type: str = "event_type",
    types: Sequence[str] | None = None,
) -> DataFrame:
    """``is_{type}`` for every event type on that date; ``is_event`` without a type column."""
    day = F.col(event_date).cast("date").alias(date)
    if event_type in events.columns:
        types = list(types) if types is not None else category_values(events, event_type)
        flags = {f"is_{slug(t)}": F.max(flag(F.col(event_type) == t)) for t in types}
    else:
        flags = {"is_event": F.max(F.lit(1))}
    per_day = events.groupBy(day).agg(*[e.alias(n) for n, e in flags.items()])
    out = df.join(per_day, date, "left")
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in flags})


def promotion_days(
    promotions: DataFrame,
    on: Sequence[str] = ("product_id",),
    sequence: str = "promo_seq",
    date: str = "date",
    types: Sequence[str] | None = None,
) -> DataFrame:
    """One row per promoted (product, day): the last promotion's scalars and all type flags.

    Expanding the small promotion table to days turns the interval join into an
    equality join that cannot multiply fact rows.
    """
    types = list(types) if types is not None else category_values(promotions, "promotion_type")
    days = promotions.where(F.col("start_date") <= F.col("end_date")).withColumn(
        date, F.explode(F.sequence("start_date", "end_date"))
    )
    last = F.max_by(
        F.struct(
            F.col("discount_rate"),
            F.datediff(date, "start_date").alias("days_into_promotion"),
            F.datediff("end_date", date).alias("days_to_promotion_end"),
        ),
        sequence,
    )
    flags = [F.max(flag(F.col("promotion_type") == t)).alias(f"is_{slug(t)}") for t in types]
    return days.groupBy(*on, date).agg(last.alias("_p"), *flags).select(
        *on, date, "_p.*", *[f"is_{slug(t)}" for t in types]
    )


def promotion_features(
    facts: DataFrame,
    promotions: DataFrame,
    on: Sequence[str] = ("product_id",),
    sequence: str = "promo_seq",
    date: str = "date",
    types: Sequence[str] | None = None,
) -> DataFrame:
    """Promotion flag, discount, days into and to the end, type flags and promotions active that day.

    ``on`` may add a store column; the promotion with the highest ``sequence`` wins.
    """
    days = promotion_days(promotions, on, sequence, date, types)
    extra = [c for c in days.columns if c not in {*on, date}]
    out = facts.join(days.withColumn("is_promotion", F.lit(1)), [*on, date], "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ["is_promotion", *extra]})
    return promo_count(out, promotions, date)


def promo_count(df: DataFrame, promotions: DataFrame, date: str = "date") -> DataFrame:
    """Number of promotions running on each date, 0 outside all of them."""
    days = promotions.where(F.col("start_date") <= F.col("end_date")).select(
        F.explode(F.sequence("start_date", "end_date")).alias(date)
    )
    counts = days.groupBy(date).agg(F.count(F.lit(1)).cast("int").alias("promo_count"))
    return df.join(counts, date, "left").withColumn("promo_count", F.coalesce("promo_count", F.lit(0)))


def _nearest_holidays(dates: DataFrame, holidays: DataFrame, date: str) -> DataFrame:
    """Per date: holiday name (NULL if none) and nearest holiday before and after it.

    Runs over distinct dates, so its unpartitioned window holds a calendar at most.
    """
    names = holidays.groupBy(F.col(date).cast("date").alias(date)).agg(F.min("holiday_name").alias("holiday_name"))
    both = names.unionByName(dates, allowMissingColumns=True).groupBy(date).agg(F.max("holiday_name").alias("holiday_name"))
    asc, desc = series_window([], date), series_window([], date, descending=True)
    hit = F.when(F.col("holiday_name").isNotNull(), F.col(date))
    return both.withColumns(
        {
            "_before": F.last(hit, ignorenulls=True).over(asc.rowsBetween(Window.unboundedPreceding, -1)),
            "_after": F.last(hit, ignorenulls=True).over(desc.rowsBetween(Window.unboundedPreceding, -1)),
        }
    )


def _contains_any(col: Column, words: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [col.contains(w) for w in words])


def holiday_features(facts: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Holiday and major-holiday flags, days to and after the nearest holiday (99 if none), one flag per major one."""
    near = _nearest_holidays(facts.select(F.col(date).cast("date").alias(date)).distinct(), holidays, date)
    name = F.col("holiday_name")
    on_day = name.isNotNull()
    made = {
        "is_holiday": flag(on_day),
        "is_major_holiday": flag(_contains_any(name, MAJOR_HOLIDAYS)),
        "days_to_holiday": F.when(on_day, 0).otherwise(F.coalesce(F.datediff("_after", date), F.lit(NO_HOLIDAY))),
        "days_after_holiday": F.when(on_day, 0).otherwise(F.coalesce(F.datediff(date, "_before"), F.lit(NO_HOLIDAY))),
    }
    for major in MAJOR_HOLIDAYS:
        made[f"is_{slug(major)}"] = flag(name.contains(major))
    return facts.join(near.withColumns(made).select(date, *made), date, "left")


def holiday_name_features(facts: DataFrame, holidays: DataFrame, date: str = "date") -> DataFrame:
    """Holiday flag and name, major flag, distance to the nearest holiday ahead and behind (0 on it or if none)."""
    near = _nearest_holidays(facts.select(F.col(date).cast("date").alias(date)).distinct(), holidays, date)
    name = F.col("holiday_name")
    on_day = name.isNotNull()
    made = {
        "is_holiday": flag(on_day),
        "is_major_holiday": flag(_contains_any(name, MAJOR_HOLIDAY_WORDS)),
        "days_before_holiday": F.when(on_day, 0).otherwise(F.coalesce(F.datediff("_after", date), F.lit(0))),
        "days_after_holiday": F.when(on_day, 0).otherwise(F.coalesce(F.datediff(date, "_before"), F.lit(0))),
    }
    return facts.join(near.withColumns(made).select(date, "holiday_name", *made), date, "left")


def holiday_windows(holidays: DataFrame, date: str = "date", major: str = "is_major_holiday", reach: int = 2) -> DataFrame:
    """(ds, holiday, lower_window, upper_window): two days each side for major holidays."""
    return holidays.select(
        F.col(date).cast("date").alias("ds"),
        F.col("holiday_name").alias("holiday"),
        F.when(F.col(major), -reach).otherwise(0).alias("lower_window"),
        F.when(F.col(major), reach).otherwise(0).alias("upper_window"),
    )


def holiday_days(windows: DataFrame) -> DataFrame:
    """(ds, holiday, offset): every day a holiday window covers."""
    spread = F.explode(F.sequence("lower_window", "upper_window")).alias("offset")
    return windows.select(F.col("ds").alias("_h"), "holiday", spread).select(
        F.date_add("_h", F.col("offset")).alias("ds"), "holiday", "offset"
    )


def merge_all_external(
    facts: DataFrame,
    holidays: DataFrame | None = None,
    weather: DataFrame | None = None,
    economy: DataFrame | None = None,
    social: DataFrame | None = None,
    competitors: DataFrame | None = None,
    date: str = "date",
    location: str | None = None,
) -> DataFrame:
    """All external tables on the facts.

    Holidays give two flags; weather is of one ``location``; the economy is
    carried to daily; social trends are interpolated to daily; competitors are
    averaged per date; then gaps take the previous date's value.  Everything is
    assembled on one row per date and joined to the facts once.
    """
    days = facts.select(date).distinct()
    added: list[str] = []
    if holidays is not None:
        per_day = holidays.groupBy(F.col(date).cast("date").alias(date)).agg(
            F.max(flag(F.col("is_major_holiday"))).alias("is_major_holiday"), F.max(F.lit(1)).alias("is_holiday")
        )
        days = days.join(per_day, date, "left").withColumns(
            {c: F.coalesce(c, F.lit(0)) for c in ("is_holiday", "is_major_holiday")}
        )
    parts = []
    if weather is not None:
        if location is not None and "location" in weather.columns:
            weather = weather.where(F.col("location") == location)
        parts.append(weather.drop("location"))
    if economy is not None:
        ends = facts.agg(F.min(date).alias("a"), F.max(date).alias("b"))
        span = ends.select(F.explode(F.sequence("a", "b")).alias(date))
        columns = [c for c in economy.columns if c != date]
        parts.append(fill_series(span.join(economy, date, "left"), columns, "ffill", (), date, edges=False))
    if social is not None:
        parts.append(calendar_fill(social, (), date, numeric_columns(social, {date}), "interpolate"))
    if competitors is not None:
        parts.append(competitor_daily(competitors, date))
    for ext in parts:
        ext = _renamed(ext, [*facts.columns, *days.columns], [date], "_ext")
        added += [c for c in ext.columns if c != date]
        days = days.join(ext, date, "left")
    return facts.join(fill_series(days, added, "ffill", (), date, edges=False) if added else days, date, "left")


def competitor_daily(competitors: DataFrame, date: str = "date") -> DataFrame:
    """Mean of every numeric column per date."""
    return competitors.groupBy(date).agg(*[F.avg(c).alias(c) for c in numeric_columns(competitors, {date})])


# United States federal holidays as (name, rule).  A rule is a
# fixed (month, day) or (month, weekday, n-th; -1 is the last).
US_FIXED = (
    ("New Year's Day", 1, 1), ("Independence Day", 7, 4), ("Veterans Day", 11, 11), ("Christmas Day", 12, 25),
)
US_FLOATING = (
    ("Martin Luther King Jr. Day", 1, "Mon", 3), ("Washington's Birthday", 2, "Mon", 3), ("Memorial Day", 5, "Mon", -1),
    ("Labor Day", 9, "Mon", 1), ("Columbus Day", 10, "Mon", 2), ("Thanksgiving", 11, "Thu", 4),
)


def holiday_calendar(
    dates: DataFrame, date: str = "date", holidays: DataFrame | None = None, country: str = "US", state: str | None = None
) -> DataFrame:
    """Holidays between the first and last date of ``dates`` with name, major flag, country and state.

    Reads a holiday table when given one; otherwise applies the US rules to
    every year of the range.
    """
    ends = dates.agg(F.min(date).cast("date").alias("_a"), F.max(date).cast("date").alias("_b"))
    if holidays is None:
        if country != "US":
            raise ValueError("rules are known for US only; pass a holiday table")
        years = ends.select("_a", "_b", F.explode(F.sequence(F.year("_a"), F.year("_b"))).alias("_y"))
        rules = [F.struct(F.lit(n).alias("holiday_name"), F.make_date("_y", F.lit(m), F.lit(d)).alias(date)) for n, m, d in US_FIXED]
        for name, month, weekday, nth in US_FLOATING:
            first = F.make_date(F.col("_y"), F.lit(month), F.lit(1))
            if nth > 0:
                day = F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (nth - 1))
            else:
                day = F.next_day(F.date_sub(F.last_day(first), 7), weekday)
            rules.append(F.struct(F.lit(name).alias("holiday_name"), day.alias(date)))
        found = years.select("_a", "_b", F.explode(F.array(*rules)).alias("h")).select("_a", "_b", "h.*")
        found = found.where(F.col(date).between(F.col("_a"), F.col("_b"))).drop("_a", "_b")
    else:
        s = scalar_struct(ends)
        found = holidays.select("holiday_name", F.col(date).cast("date").alias(date)).where(
            F.col(date).between(s.getField("_a"), s.getField("_b"))
        )
    return found.select(
        date,
        "holiday_name",
        _contains_any(F.col("holiday_name"), MAJOR_HOLIDAYS).alias("is_major_holiday"),
        F.lit(country).alias("country"),
        F.lit(state).cast("string").alias("state"),
    )
