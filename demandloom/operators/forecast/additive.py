"""Additive (or multiplicative) trend + seasonality + holiday + regressor model per series.

Fitting solves one small ridge problem per series in a grouped map; input is
first reduced to one row per series and day, so a group is bounded by the
calendar.  The result is a model table.  Scoring joins that table and evaluates
the model with column expressions, so it runs the same in batch and stream.
"""

from __future__ import annotations

import itertools
import json
import pickle
import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, replace
from datetime import date as _date
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.exprs import slug, z_value
from demandloom.operators.encode import category_values
from demandloom.sources.io import settle

# Seasonal periods in days.
WEEK, YEAR = 7.0, 365.25
EPOCH = _date(1970, 1, 1)

STATE = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("first_ds", T.DateType()),
        T.StructField("last_ds", T.DateType()),
        T.StructField("span", T.DoubleType()),
        T.StructField("scale", T.DoubleType()),
        T.StructField("sigma", T.DoubleType()),
        T.StructField("knots", T.ArrayType(T.DoubleType())),
        T.StructField("trend", T.ArrayType(T.DoubleType())),
        T.StructField("weekly", T.ArrayType(T.DoubleType())),
        T.StructField("yearly", T.ArrayType(T.DoubleType())),
        T.StructField("holidays", T.ArrayType(T.DoubleType())),
        T.StructField("regressors", T.ArrayType(T.DoubleType())),
        T.StructField("settings", T.StringType()),
    ]
)


@dataclass(frozen=True)
class AdditiveSpec:
    """Model settings; prior scales work as in ridge: the smaller, the stiffer."""

    mode: str = "additive"
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    changepoints: int = 25
    changepoint_range: float = 0.8
    weekly_order: int = 3
    yearly_order: int = 10
    interval: float = 0.8

    def __post_init__(self):
        if self.mode not in ("additive", "multiplicative"):
            raise ValueError(f"unknown mode: {self.mode}")


def settings_text(spec: AdditiveSpec, regressors: Sequence[str] = (), holidays: Sequence[str] = ()) -> str:
    """How a model was fitted, as its row in the model table says it."""
    return json.dumps({**asdict(spec), "regressors": list(regressors), "holidays": list(holidays)}, sort_keys=True)


def read_settings(text: str) -> tuple[AdditiveSpec, list[str], list[str]]:
    """(spec, regressor names, holiday flag names) of a model's settings."""
    values = json.loads(text)
    regressors, holidays = values.pop("regressors"), values.pop("holidays")
    return AdditiveSpec(**values), regressors, holidays


def _fourier(days: np.ndarray, period: float, order: int) -> np.ndarray:
    k = np.arange(1, order + 1)
    angle = 2.0 * np.pi * days[:, None] * k[None, :] / period
    return np.hstack([np.sin(angle), np.cos(angle)])


def _blocks(days, first, span, knots, spec, extra_h, extra_r):
    """Design matrix blocks: trend (level, slope, hinges), weekly, yearly, holidays, regressors."""
    t = (days - first) / span
    trend = np.column_stack([np.ones_like(t), t, *[np.maximum(t - c, 0.0) for c in knots]])
    return [trend, _fourier(days, WEEK, spec.weekly_order), _fourier(days, YEAR, spec.yearly_order), extra_h, extra_r]


def _solve(days, y, spec: AdditiveSpec, extra_h, extra_r) -> dict:
    """Ridge fit of one series; ``days`` are day numbers in order, ``y`` without gaps."""
    first, span = days[0], max(float(days[-1] - days[0]), 1.0)
    if not np.isfinite(y).all():
        raise ValueError("values that are not finite")
    if spec.mode == "multiplicative" and (y <= -1).any():
        raise ValueError("multiplicative mode needs values above -1")
    z = np.log1p(y) if spec.mode == "multiplicative" else y
    scale = float(np.max(np.abs(z))) or 1.0
    z = z / scale
    n_knots = max(0, min(spec.changepoints, len(y) // 3))
    knots = np.linspace(0.0, spec.changepoint_range, n_knots + 1)[1:] if n_knots else np.zeros(0)
    blocks = _blocks(days, first, span, knots, spec, extra_h, extra_r)
    x = np.hstack(blocks)
    prior, cuts = _prior([b.shape[1] for b in blocks], spec)
    noise = max(float(np.var(z)), 1e-12)
    # Two passes: the noise level scales the penalty, and the first fit estimates it.
    for _ in range(2):
        beta = np.linalg.solve(x.T @ x + np.diag(noise / prior**2 + 1e-10), x.T @ z)
        rest = z - x @ beta
        noise = max(float(rest @ rest) / len(z), 1e-12)
    return _state(beta, cuts, knots, span, scale, float(rest @ rest), len(z))


def _prior(widths: Sequence[int], spec: AdditiveSpec) -> tuple[np.ndarray, np.ndarray]:
    """Prior scale of every coefficient, and where the blocks end."""
    season, holiday = spec.seasonality_prior_scale, spec.holidays_prior_scale
    scales = [np.full(widths[0], spec.changepoint_prior_scale), *[np.full(w, p) for w, p in zip(widths[1:], (season, season, holiday, season))]]
    scales[0][:2] = 1e3
    return np.concatenate(scales), np.cumsum(widths)[:-1]


def _state(beta, cuts, knots, span, scale, squares: float, n: int) -> dict:
    parts = np.split(beta, cuts)
    return {
        "span": span, "scale": scale, "sigma": float(np.sqrt(squares / max(n - 2, 1))),
        "knots": knots, "trend": parts[0], "weekly": parts[1], "yearly": parts[2], "holidays": parts[3], "regressors": parts[4],
    }


def _predict(days, first, state, spec, extra_h, extra_r, shift: float = 0.0) -> np.ndarray:
    blocks = _blocks(days, first, state["span"], state["knots"], spec, extra_h, extra_r)
    names = ("trend", "weekly", "yearly", "holidays", "regressors")
    z = (sum(b @ state[n] for b, n in zip(blocks, names)) + shift) * state["scale"]
    return np.expm1(z) if spec.mode == "multiplicative" else z


def _series_arrays(pdf: pd.DataFrame, holidays: Sequence[str], regressors: Sequence[str]):
    pdf = pdf[pdf["y"].notna()].sort_values("ds")
    days = (pd.to_datetime(pdf["ds"]) - pd.Timestamp(EPOCH)).dt.days.to_numpy(float)
    return (
        days, pdf["y"].to_numpy(float), pdf[list(holidays)].to_numpy(float), pdf[list(regressors)].fillna(0.0).to_numpy(float)
    )


def one_per_day(df: DataFrame, keys, columns) -> DataFrame:
    """Series rows reduced to one per day, keeping only what the fit reads."""
    return df.where(F.col("y").isNotNull()).groupBy(*keys, "ds").agg(*[F.avg(c).alias(c) for c in columns])


def with_holidays(df: DataFrame, holidays: DataFrame | None, names: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Add one 0/1 column per holiday name from (ds, holiday) days; equal dates only."""
    if holidays is None:
        return df, []
    names = list(names) if names is not None else category_values(holidays, "holiday")
    columns = ["h_" + re.sub(r"\W+", "_", slug(n)) for n in names]
    flags = [F.max(F.when(F.col("holiday") == n, 1.0).otherwise(0.0)).alias(c) for n, c in zip(names, columns)]
    out = df.join(holidays.groupBy("ds").agg(*flags), "ds", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in columns}), columns


def fit_additive(
    df: DataFrame,
    keys: Sequence[str],
    spec: AdditiveSpec = AdditiveSpec(),
    regressors: Sequence[str] = (),
    holidays: Sequence[str] = (),
    min_rows: int = 2,
) -> DataFrame:
    """Model table: one row per series of (keys, ds, y, regressors, holiday flags).

    A series that cannot be fitted gets ``status`` too_short or failed, with the reason in ``error``.
    ``settings`` holds what scoring needs to know beside the coefficients.
    """
    keys, regressors, holidays = list(keys), list(regressors), list(holidays)
    daily = one_per_day(df, keys, ["y", *holidays, *regressors])
    schema = T.StructType([*[df.schema[k] for k in keys], *STATE.fields])
    settings = settings_text(spec, regressors, holidays)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        head = {k: pdf[k].iloc[0] for k in keys}
        days, y, eh, er = _series_arrays(pdf, holidays, regressors)
        row = dict.fromkeys(STATE.fieldNames())
        row.update(head, n=len(y), status="ok", settings=settings)
        if len(y):
            row.update(
                first_ds=_date.fromordinal(EPOCH.toordinal() + int(days[0])),
                last_ds=_date.fromordinal(EPOCH.toordinal() + int(days[-1])),
            )
        if len(y) < min_rows:
            row.update(status="too_short", error=f"{len(y)} rows")
        else:
            try:
                row.update(_solve(days, y, spec, eh, er))
            except (np.linalg.LinAlgError, ValueError) as e:
                row.update(status="failed", error=str(e))
        return pd.DataFrame([row], columns=schema.fieldNames())

    return daily.groupBy(*keys).applyInPandas(fit, schema)


def _dot(values: Column, coefs: Column) -> Column:
    return F.aggregate(F.zip_with(values, coefs, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def _fourier_expr(days: Column, period: float, order: int, coefs: Column) -> Column:
    terms = []
    for i, fn in enumerate((F.sin, F.cos)):
        for k in range(1, order + 1):
            terms.append(coefs[i * order + k - 1] * fn(days * F.lit(2.0 * np.pi * k / period)))
    total = F.lit(0.0)
    for term in terms:
        total = total + term
    return total


def component_columns(spec: AdditiveSpec, regressors: Sequence[str] = (), holidays: Sequence[str] = (), ds: str = "ds") -> dict[str, Column]:
    """Scaled component values of a row joined with its model."""
    days = F.datediff(F.col(ds), F.lit("1970-01-01").cast("date")).cast("double")
    t = F.datediff(F.col(ds), F.col("first_ds")) / F.col("span")
    hinges = F.transform("knots", lambda c: F.greatest(t - c, F.lit(0.0)))
    extra = {"holidays": list(holidays), "regressors": list(regressors)}
    out = {
        "trend": F.col("trend")[0] + F.col("trend")[1] * t + _dot(hinges, F.slice("trend", 3, F.size("knots"))),
        "weekly": _fourier_expr(days, WEEK, spec.weekly_order, F.col("weekly")),
        "yearly": _fourier_expr(days, YEAR, spec.yearly_order, F.col("yearly")),
    }
    for name, columns in extra.items():
        values = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]) if columns else F.array().cast("array<double>")
        out[name] = _dot(values, F.col(name)) if columns else F.lit(0.0)
    return out


def score_additive(
    rows: DataFrame,
    models: DataFrame,
    keys: Sequence[str],
    spec: AdditiveSpec | None = None,
    regressors: Sequence[str] = (),
    holidays: Sequence[str] = (),
    components: bool = False,
) -> DataFrame:
    """yhat with interval for every row whose series has a fitted model; others give no rows.

    Without ``spec`` the models' own settings count, of which the table may
    hold several (their few distinct values are read); regressors and holiday
    flags are then columns of ``rows``.  With it the table is not read ahead,
    and a model that was fitted otherwise stops the query.
    """
    usable = models.where(F.col("status") == "ok")
    if spec is None:
        texts = sorted(r[0] for r in usable.select("settings").distinct().collect())
        parts = [_scored(rows, usable.where(F.col("settings") == t), keys, *read_settings(t), components) for t in texts]
        return reduce(DataFrame.unionByName, parts) if parts else _scored(rows, usable, keys, AdditiveSpec(), [], [], components)
    expected = F.lit(settings_text(spec, regressors, holidays))
    own = F.when(F.col("settings") == expected, F.col("scale")).otherwise(
        F.raise_error(F.concat(F.lit("the model was fitted with other settings: "), F.col("settings"))).cast("double")
    )
    return _scored(rows, usable.withColumn("scale", own), keys, spec, regressors, holidays, components)


def _scored(rows, usable, keys, spec: AdditiveSpec, regressors, holidays, components: bool) -> DataFrame:
    joined = rows.join(usable.drop("status", "error", "n", "last_ds", "settings"), list(keys))
    parts = component_columns(spec, regressors, holidays)
    names = {f"c_{n}": e * F.col("scale") for n, e in parts.items()}
    joined = joined.withColumns(names)
    z = sum((F.col(n) for n in names), F.lit(0.0))
    half = F.lit(z_value((1 + spec.interval) / 2)) * F.col("sigma") * F.col("scale")
    link = F.expm1 if spec.mode == "multiplicative" else (lambda c: c)
    made = {"yhat": link(z), "yhat_lower": link(z - half), "yhat_upper": link(z + half)}
    out = joined.withColumns(made)
    extra = [F.col(f"c_{n}").alias(n) for n in parts] if components else []
    return out.select(*rows.columns, *made, *extra)


def future_rows(models: DataFrame, keys: Sequence[str], periods: int, freq: str = "D") -> DataFrame:
    """(keys, ds) of the next ``periods`` steps after the last day of each model."""
    steps = {
        "D": lambda i: F.date_add("last_ds", i),
        "W": lambda i: F.date_add("last_ds", i * 7),
        "M": lambda i: F.add_months("last_ds", i),
    }
    dates = F.transform(F.sequence(F.lit(1), F.lit(periods)), steps[freq])
    return models.where(F.col("last_ds").isNotNull()).select(*keys, F.explode(dates).alias("ds"))


def forecast_additive(
    df: DataFrame,
    keys: Sequence[str],
    periods: int = 30,
    freq: str = "D",
    spec: AdditiveSpec = AdditiveSpec(),
    regressors: Sequence[str] = (),
    future: DataFrame | None = None,
    holidays: DataFrame | None = None,
    include_history: bool = True,
    components: bool = False,
) -> DataFrame:
    """(keys, ds, y, yhat, yhat_lower, yhat_upper, status, error) for history and future of every series.

    ``df`` has keys, ds, y and regressors.  With regressors, ``future`` must
    hold their coming values.  ``holidays`` holds (ds, holiday) days.  A series
    that cannot be fitted has one row with its status and error.  The history
    is reduced once, and the model table, one row per series, written once.
    """
    if regressors and future is None and periods:
        raise ValueError("regressors need a future table with their values")
    names = category_values(holidays, "holiday") if holidays is not None else None
    history, flags = with_holidays(df, holidays, names)
    daily = settle(one_per_day(history, keys, ["y", *regressors, *flags]), "daily")
    models = settle(fit_additive(daily, keys, spec, regressors, flags), "additive-models")
    rows = daily if include_history else None
    if periods:
        ahead = future.select(*keys, "ds", *regressors) if future is not None else future_rows(models, keys, periods, freq)
        ahead, _ = with_holidays(ahead, holidays, names)
        rows = ahead if rows is None else rows.unionByName(ahead, allowMissingColumns=True)
    if "y" not in rows.columns:
        rows = rows.withColumn("y", F.lit(None).cast("double"))
    scored = score_additive(rows, models, keys, spec, regressors, flags, components)
    shown = ["trend", "weekly", "yearly", "holidays", "regressors"] if components else []
    out = scored.select(*keys, "ds", "y", "yhat", "yhat_lower", "yhat_upper", *shown, F.lit("ok").alias("status"), F.lit(None).cast("string").alias("error"))
    return out.unionByName(models.where(F.col("status") != "ok").select(*keys, "status", "error"), allowMissingColumns=True)


def forecast_components(df: DataFrame, keys: Sequence[str], spec: AdditiveSpec = AdditiveSpec(), **options) -> DataFrame:
    """(keys, ds, trend, weekly, yearly, holidays, regressors, status, error) over the history."""
    out = forecast_additive(df, keys, 0, spec=spec, components=True, **options)
    return out.select(*keys, "ds", "trend", "weekly", "yearly", "holidays", "regressors", "status", "error")


def param_grid(grid: Mapping[str, Sequence]) -> list[dict]:
    """All combinations of a parameter grid, in order."""
    return [dict(zip(grid, combo)) for combo in itertools.product(*grid.values())]


#: Settings that change the design of a fit; the others only change its penalty.
_SHAPE = ("mode", "changepoints", "changepoint_range", "weekly_order", "yearly_order")


class _Prefixes:
    """Sums over the first rows of a series from which the normal equations of any cutoff follow.

    Every column of the design is fixed but the hinges, whose places move with
    the cutoff.  A hinge is d - k beyond its place k, so its products are
    differences of the sums of 1 and d times each column, up to the cutoff
    and up to the hinge.
    """

    def __init__(self, days, y, spec: AdditiveSpec, extra_h, extra_r, cutoffs: Sequence[float]):
        self.days, self.spec, self.first = days, spec, days[0]
        with np.errstate(all="ignore"):
            self.z = np.log1p(y) if spec.mode == "multiplicative" else y
        self.bad = ~np.isfinite(self.z) | ((y <= -1) if spec.mode == "multiplicative" else False)
        fixed = [_fourier(days, WEEK, spec.weekly_order), _fourier(days, YEAR, spec.yearly_order), extra_h, extra_r]
        self.widths = [b.shape[1] for b in fixed]
        d = days - self.first
        self.basis = np.hstack([np.ones((len(d), 1)), d[:, None], *fixed])
        self.plans = {c: self._plan(int(np.searchsorted(days, c, "right"))) for c in cutoffs}
        wanted = np.unique(np.concatenate([[0], *[np.append(at, n) for n, _, _, _, at in self.plans.values()]])).astype(int)
        self.row = {int(n): i for i, n in enumerate(wanted)}
        full = np.column_stack([self.basis, np.where(self.bad, 0.0, self.z)])
        self.sums = np.zeros((len(wanted), full.shape[1], full.shape[1]))
        for i in range(1, len(wanted)):
            part = full[wanted[i - 1] : wanted[i]]
            self.sums[i] = self.sums[i - 1] + part.T @ part

    def _plan(self, n: int):
        """(rows, span, knots, places of the hinges in days, rows up to each) of a fit on the first n rows."""
        span = max(float(self.days[n - 1] - self.first), 1.0) if n else 1.0
        count = max(0, min(self.spec.changepoints, n // 3))
        knots = np.linspace(0.0, self.spec.changepoint_range, count + 1)[1:] if count else np.zeros(0)
        places = knots * span
        return n, span, knots, places, np.searchsorted(self.days - self.first, places, "right")

    def equations(self, cutoff: float) -> dict:
        """Everything a solve at this cutoff needs, independent of the penalty."""
        n, span, knots, k, at = self.plans[cutoff]
        if self.bad[:n].any():
            raise ValueError("values that are not finite" if self.spec.mode == "additive" else "multiplicative mode needs values above -1")
        scale = float(np.max(np.abs(self.z[:n]))) or 1.0
        total, upto = self.sums[self.row[n]], self.sums[[self.row[int(i)] for i in at]]
        past = total[None] - upto  # sums over the rows beyond each hinge
        cross = (past[:, 1, :] - k[:, None] * past[:, 0, :]) / span
        later = np.maximum.outer(np.arange(len(k)), np.arange(len(k)))
        beyond = past[later]
        both = (beyond[..., 1, 1] - np.add.outer(k, k) * beyond[..., 0, 1] + np.multiply.outer(k, k) * beyond[..., 0, 0]) / span**2
        level, rest = total.copy(), list(range(2, total.shape[0]))
        level[1, :] /= span
        level[:, 1] /= span
        cross[:, 1] /= span
        order = [0, 1], rest
        top = np.hstack([level[np.ix_(order[0], order[0])], cross[:, order[0]].T, level[np.ix_(order[0], order[1])]])
        mid = np.hstack([cross[:, order[0]], both, cross[:, order[1]]])
        low = np.hstack([level[np.ix_(order[1], order[0])], cross[:, order[1]].T, level[np.ix_(order[1], order[1])]])
        gram = np.vstack([top, mid, low])
        gram[-1, :] /= scale
        gram[:, -1] /= scale
        return {"n": n, "span": span, "scale": scale, "knots": knots, "gram": gram, "mean": float(self.z[:n].mean()) / scale, "widths": [2 + len(k), *self.widths]}


def _solve_equations(eq: dict, spec: AdditiveSpec) -> dict:
    """The ridge fit of ``_solve`` from its normal equations; the last row and column are the values'."""
    gram, moment, squares, n = eq["gram"][:-1, :-1], eq["gram"][:-1, -1], float(eq["gram"][-1, -1]), eq["n"]
    prior, cuts = _prior(eq["widths"], spec)
    noise = max(squares / n - eq["mean"] ** 2, 1e-12)
    for _ in range(2):
        beta = np.linalg.solve(gram + np.diag(noise / prior**2 + 1e-10), moment)
        left = max(squares - 2 * float(beta @ moment) + float(beta @ gram @ beta), 0.0)
        noise = max(left / n, 1e-12)
    return _state(beta, cuts, eq["knots"], eq["span"], eq["scale"], left, n)


def _cutoffs(days: np.ndarray, initial: int, period: int, horizon: int) -> list[float]:
    """Cutoffs from the last possible one backwards, with ``initial`` days of history and rows on both sides."""
    out, cutoff = [], (days[-1] - horizon if len(days) else -1.0)
    while len(days) and cutoff >= days[0] + initial:
        past = int(np.searchsorted(days, cutoff, "right"))
        if past >= 2 and past < np.searchsorted(days, cutoff + horizon, "right"):
            out.append(float(cutoff))
        cutoff -= period
    return out


def _day(number: float) -> _date:
    return _date.fromordinal(EPOCH.toordinal() + int(number))


def _rolling_origin(
    df: DataFrame, keys, specs: Sequence[AdditiveSpec], regressors, holidays, initial: int, period: int, horizon: int
) -> DataFrame:
    """(keys, status, error, param_id, cutoff, ds, y, yhat, yhat_lower, yhat_upper): fits of every series at every cutoff and setting.

    A series is read once: prefix sums give the normal equations of every
    cutoff, which go out as one row each.  These rows are dealt anew, so
    (series, cutoff) pairs are solved in parallel, whatever the series.
    """
    keys, regressors, holidays, specs = list(keys), list(regressors), list(holidays), list(specs)
    daily = one_per_day(df, keys, ["y", *holidays, *regressors])
    head = [df.schema[k] for k in keys]
    shapes = list(dict.fromkeys(tuple(getattr(s, f) for f in _SHAPE) for s in specs))
    by_shape = {i: [(j, s) for j, s in enumerate(specs) if tuple(getattr(s, f) for f in _SHAPE) == shape] for i, shape in enumerate(shapes)}
    middle = T.StructType([*head, *T.StructType.fromDDL("status string, error string, shape int, cutoff date, equations binary").fields])
    tail = "status string, error string, param_id int, cutoff date, ds date, y double, yhat double, yhat_lower double, yhat_upper double"
    schema = T.StructType([*head, *T.StructType.fromDDL(tail).fields])

    def prepare(pdf: pd.DataFrame) -> pd.DataFrame:
        days, y, eh, er = _series_arrays(pdf, holidays, regressors)
        cutoffs = _cutoffs(days, initial, period, horizon)
        rows = [] if cutoffs else [("too_short", f"{len(y)} rows, no cutoff", None, None, None)]
        for i, members in by_shape.items() if cutoffs else ():
            sums = _Prefixes(days, y, members[0][1], eh, er, cutoffs)
            for cutoff in cutoffs:
                ahead = (days > cutoff) & (days <= cutoff + horizon)
                try:
                    eq = {**sums.equations(cutoff), "first": days[0], "days": days[ahead], "y": y[ahead], "eh": eh[ahead], "er": er[ahead]}
                    rows.append(("ok", None, i, _day(cutoff), pickle.dumps(eq)))
                except ValueError as e:
                    rows.append(("failed", str(e), i, _day(cutoff), None))
        out = pd.DataFrame(rows, columns=middle.fieldNames()[len(keys) :])
        for k in keys:
            out[k] = pdf[k].iloc[0]
        return out[middle.fieldNames()]

    def solved(row) -> Iterator[tuple]:
        for i, spec in by_shape[int(row.shape)] if row.status != "too_short" else [(None, None)]:
            if row.status != "ok":
                yield (row.status, row.error, i, row.cutoff, None, None, None, None, None)
                continue
            eq = pickle.loads(row.equations)
            try:
                state = _solve_equations(eq, spec)
            except np.linalg.LinAlgError as e:
                yield ("failed", str(e), i, row.cutoff, None, None, None, None, None)
                continue
            half = z_value((1 + spec.interval) / 2) * state["sigma"]
            three = [_predict(eq["days"], eq["first"], state, spec, eq["eh"], eq["er"], shift) for shift in (0.0, -half, half)]
            for d, y, *yhat in zip(eq["days"], eq["y"], *three):
                yield ("ok", None, i, row.cutoff, _day(d), y, *yhat)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row, key in zip(batch[middle.fieldNames()[len(keys) :]].itertuples(index=False), batch[keys].itertuples(index=False, name=None)):
                yield pd.DataFrame([(*key, *r) for r in solved(row)], columns=schema.fieldNames())

    prepared = daily.groupBy(*keys).applyInPandas(prepare, middle)
    return prepared.repartition(*keys, "cutoff", "shape").mapInPandas(solve, schema)


def backtest(
    df: DataFrame,
    keys: Sequence[str],
    spec: AdditiveSpec = AdditiveSpec(),
    regressors: Sequence[str] = (),
    holidays: Sequence[str] = (),
    initial: int = 730,
    period: int = 180,
    horizon: int = 30,
) -> DataFrame:
    """(keys, status, error, cutoff, ds, y, yhat, yhat_lower, yhat_upper) of rolling-origin refits.

    A series without any cutoff has one row with status too_short; a cutoff that cannot be fitted one with failed.
    """
    return _rolling_origin(df, keys, [spec], regressors, holidays, initial, period, horizon).drop("param_id")


def backtest_metrics(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Errors by days ahead of the cutoff: squared, absolute and relative ones, and the share of actuals inside the interval."""
    known = results.where(F.col("yhat").isNotNull() & F.col("y").isNotNull())
    y, yhat = F.col("y"), F.col("yhat")
    err, middle = yhat - y, (F.abs(y) + F.abs(yhat)) / 2
    share = F.when(y != 0, F.abs(F.try_divide(err, y)))
    ahead = F.datediff("ds", "cutoff").alias("horizon")
    inside = (y >= F.col("yhat_lower")) & (y <= F.col("yhat_upper"))
    return known.groupBy(*by, ahead).agg(
        F.avg(err * err).alias("mse"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(share).alias("mape"),
        F.median(share).alias("mdape"),
        F.avg(F.when(middle != 0, F.try_divide(F.abs(err), middle))).alias("smape"),
        F.avg(inside.cast("double")).alias("coverage"),
        F.count(F.lit(1)).alias("rows"),
    )


def grid_search(
    df: DataFrame,
    keys: Sequence[str],
    grid: Mapping[str, Sequence],
    base: AdditiveSpec = AdditiveSpec(),
    regressors: Sequence[str] = (),
    holidays: Sequence[str] = (),
    initial: int = 730,
    period: int = 180,
    horizon: int = 30,
) -> DataFrame:
    """(keys, status, parameters, rmse, rank) per series: mean over cutoffs of the RMSE, best first.

    A series without any cutoff has one row with status too_short; a setting
    that fails at every cutoff has a row with failed, without a rank.
    """
    combos = param_grid(grid)
    specs = [replace(base, **c) for c in combos]
    results = _rolling_origin(df, keys, specs, regressors, holidays, initial, period, horizon)
    err = F.col("yhat") - F.col("y")
    per_cutoff = results.groupBy(*keys, "param_id", "cutoff").agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.min("status").alias("status"))
    # a setting counts where it could be fitted
    status = F.when(F.count("rmse") > 0, "ok").otherwise(F.max("status"))
    scores = per_cutoff.groupBy(*keys, "param_id").agg(F.avg("rmse").alias("rmse"), status.alias("status"))
    settings = [asdict(s) for s in specs]
    for name in grid:
        choices = F.array(*[F.lit(s[name]) for s in settings])
        scores = scores.withColumn(name, F.get(choices, F.col("param_id")))
    order = Window.partitionBy(*keys).orderBy(F.col("rmse").asc_nulls_last(), "param_id")
    rank = F.when(F.col("rmse").isNotNull(), F.row_number().over(order))
    return scores.withColumn("rank", rank).select(*keys, "status", *grid, "rmse", "rank")
