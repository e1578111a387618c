"""Vector autoregression per series: order selection, coefficients, forecasts, responses.

Every fit is one small least-squares problem per key in a grouped map whose
input is one row per day.  The fitted model is a row of arrays; forecasts and
responses are computed from the model table without touching the history again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandloom.functions.distributions import f_tail, unit_root_tail
from demandloom.functions.exprs import z_value
from demandloom.operators.calendar import calendar_fill

# Order limit, criteria, level of tests, and the published response surfaces of
# the critical values of the unit-root test with a constant.
MAX_LAGS = 12
CRITERIA = ("aic", "bic", "hqic")
ALPHA = 0.05
ADF_CRITICAL = {0.01: (-3.4335, -5.999, -29.25), 0.05: (-2.8621, -2.738, -8.36), 0.10: (-2.5671, -1.438, -4.48)}

#: What becomes of days without rows between a series' first and last: lags and horizons both count days then.
GAPS = ("interpolate", "zero", "ignore")

_DOUBLES = T.ArrayType(T.DoubleType())
_STATE = [
    T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("lag_order", T.IntegerType()),
    T.StructField("diff_order", T.ArrayType(T.IntegerType())),
    T.StructField("coef", T.ArrayType(_DOUBLES)),
    T.StructField("sigma", T.ArrayType(_DOUBLES)),
    T.StructField("recent", T.ArrayType(_DOUBLES)),
    T.StructField("last_level", _DOUBLES),
    T.StructField("last_step", _DOUBLES),
    T.StructField("last_ds", T.DateType()),
    T.StructField("scores", T.MapType(T.StringType(), _DOUBLES)),
]


def _ols(x: np.ndarray, y: np.ndarray):
    beta, *_ = np.linalg.lstsq(x, y, rcond=None)
    return beta, y - x @ beta


def adf(y: np.ndarray, alpha: float = ALPHA) -> tuple[float, int, float]:
    """(t statistic, lags, critical value) of the unit-root regression with a constant; NaN where the level has no table."""
    n = len(y)
    top = min(int(math.ceil(12.0 * (n / 100.0) ** 0.25)), n // 2 - 3)
    if top < 0 or np.ptp(y) == 0:
        return float("nan"), 0, float("nan")
    dy = np.diff(y)

    def design(lags: int, start: int):
        rows = np.arange(start, len(dy))
        cols = [y[rows], np.ones(len(rows)), *[dy[rows - k] for k in range(1, lags + 1)]]
        return np.column_stack(cols), dy[rows]

    best, order = math.inf, 0
    for lags in range(top + 1):
        x, d = design(lags, top)
        _, e = _ols(x, d)
        aic = len(d) * math.log(max(float(e @ e), 1e-300) / len(d)) + 2 * x.shape[1]
        if aic < best:
            best, order = aic, lags
    x, d = design(order, order)
    beta, e = _ols(x, d)
    spread = float(e @ e) / (len(d) - x.shape[1])
    se = math.sqrt(max(spread * np.linalg.pinv(x.T @ x)[0, 0], 1e-300))
    c0, c1, c2 = ADF_CRITICAL.get(alpha, (math.nan,) * 3)
    m = len(d)
    return float(beta[0] / se), order, c0 + c1 / m + c2 / m**2


def _is_stationary(y: np.ndarray, alpha: float = ALPHA) -> bool:
    return unit_root_tail(adf(y, alpha)[0]) < alpha


def _lag_matrix(z: np.ndarray, p: int, start: int) -> np.ndarray:
    rows = np.arange(start, len(z))
    return np.hstack([np.ones((len(rows), 1)), *[z[rows - k] for k in range(1, p + 1)]])


def _order_scores(z: np.ndarray, max_lags: int) -> dict[str, list[float]]:
    """Criteria for orders 0..max_lags, all on the same rows."""
    k = z.shape[1]
    out: dict[str, list[float]] = {c: [] for c in CRITERIA}
    for p in range(max_lags + 1):
        x, y = _lag_matrix(z, p, max_lags), z[max_lags:]
        _, e = _ols(x, y)
        n = len(y)
        _, logdet = np.linalg.slogdet(e.T @ e / n + 1e-12 * np.eye(k))
        terms = k * (k * p + 1)
        out["aic"].append(logdet + 2.0 * terms / n)
        out["bic"].append(logdet + math.log(n) * terms / n)
        out["hqic"].append(logdet + 2.0 * math.log(math.log(n)) * terms / n)
    return out


def _fit(z_raw: np.ndarray, max_lags: int, ic: str, difference: bool, alpha: float = ALPHA) -> dict:
    orders, columns = [], []
    for j in range(z_raw.shape[1]):
        y, d = z_raw[:, j], 0
        while difference and d < 2 and not _is_stationary(y, alpha):
            y, d = np.diff(y), d + 1
        orders.append(d)
        columns.append(y)
    size = min(len(c) for c in columns)
    z = np.column_stack([c[-size:] for c in columns])
    k = z.shape[1]
    top = max(1, min(max_lags, (size - 2) // (k + 1) - 1))
    scores = _order_scores(z, top)
    p = int(np.argmin(scores[ic])) or 1
    x, y = _lag_matrix(z, p, p), z[p:]
    beta, e = _ols(x, y)
    freedom = max(len(y) - x.shape[1], 1)
    return {
        "lag_order": p, "diff_order": orders, "coef": beta.T.tolist(), "sigma": (e.T @ e / freedom).tolist(),
        "recent": z[-p:].tolist(), "last_level": z_raw[-1].tolist(), "last_step": (z_raw[-1] - z_raw[-2]).tolist(),
        "scores": scores,
    }


def _daily(df: DataFrame, keys, columns, date: str, gaps: str) -> DataFrame:
    """One row per series and day; days and values that are missing in between are filled as ``gaps`` says."""
    if gaps not in GAPS:
        raise ValueError(f"gaps is one of {GAPS}")
    finite = lambda c: F.avg(F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c)))
    days = df.groupBy(*keys, F.col(date).cast("date").alias("ds")).agg(*[finite(c).alias(c) for c in columns]).where(F.col("ds").isNotNull())
    return days if gaps == "ignore" else calendar_fill(days, keys, "ds", columns, method=gaps)


def var_fit(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    date: str = "date",
    max_lags: int = MAX_LAGS,
    ic: str = "aic",
    difference: bool = True,
    min_rows: int = 20,
    gaps: str = "interpolate",
    alpha: float = ALPHA,
) -> DataFrame:
    """Model table: one row per key.  Columns with a unit root at level ``alpha`` are differenced up to twice; order 0 becomes 1.

    Missing days between a series' first and last are filled (``gaps``:
    interpolate, zero or ignore), so that a lag is a day; NaN and infinite
    values are missing.  A series that cannot be fitted has status too_short or
    failed, with the reason in ``error``.
    """
    keys, columns = list(keys), list(columns)
    if ic not in CRITERIA:
        raise ValueError(f"unknown criterion: {ic}")
    schema = T.StructType([*[df.schema[k] for k in keys], *_STATE])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        row = dict.fromkeys(schema.fieldNames())
        row.update({k: pdf[k].iloc[0] for k in keys})
        pdf = pdf.dropna(subset=columns).sort_values("ds")
        row.update(status="ok", n=len(pdf))
        if len(pdf):
            row.update(last_ds=pdf["ds"].iloc[-1])
        if len(pdf) < min_rows:
            row.update(status="too_short", error=f"{len(pdf)} rows")
        else:
            try:
                row.update(_fit(pdf[columns].to_numpy(float), max_lags, ic, difference, alpha))
            except (np.linalg.LinAlgError, ValueError) as e:
                row.update(status="failed", error=str(e))
        return pd.DataFrame([row], columns=schema.fieldNames())

    return _daily(df, keys, columns, date, gaps).groupBy(*keys).applyInPandas(fit, schema)


def _matrix(value) -> np.ndarray:
    return np.array([list(r) for r in value], dtype=float)


def _undo(path: np.ndarray, order: int, level: float, step: float) -> np.ndarray:
    if order == 0:
        return path
    if order == 1:
        return level + np.cumsum(path)
    return level + np.cumsum(step + np.cumsum(path))


def _from_models(models: DataFrame, keys, tail: str, rows_of) -> DataFrame:
    """Expand every fitted model row with ``rows_of(model) -> list of tuples`` in map tasks; no shuffle.

    Models without a fit give one row with their status and error.
    """
    extra = T.StructType.fromDDL(f"{tail}, status string, error string")
    schema = T.StructType([*[models.schema[k] for k in keys], *extra.fields])
    names, width = extra.fieldNames(), len(extra) - 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, model in batch.iterrows():
                ok = model["status"] == "ok"
                rows = [(*r, "ok", None) for r in rows_of(model)] if ok else [(*[None] * width, model["status"], model["error"])]
                out = pd.DataFrame(rows, columns=names)
                for k in keys:
                    out[k] = model[k]
                yield out[schema.fieldNames()]

    return models.mapInPandas(run, schema)


def _moving_average(model, steps: int) -> np.ndarray:
    """The moving-average matrices of steps 0..steps."""
    coef, p = _matrix(model["coef"]), int(model["lag_order"])
    k = coef.shape[0]
    lag_blocks = [coef[:, 1 + i * k : 1 + (i + 1) * k] for i in range(p)]
    psi = [np.eye(k)]
    for s in range(1, steps + 1):
        psi.append(sum(lag_blocks[i] @ psi[s - 1 - i] for i in range(min(p, s))))
    return np.array(psi)


def _spread(model, steps: int) -> np.ndarray:
    """Standard errors [step, variable] of the forecasts of levels.

    An error now moves a differenced variable's level by the running sum of
    its responses, once for each difference; errors of different days add up.
    """
    psi = _moving_average(model, steps - 1)
    for j, order in enumerate(model["diff_order"]):
        for _ in range(int(order)):
            psi[:, j, :] = np.cumsum(psi[:, j, :], axis=0)
    variance = np.einsum("sij,jk,sik->si", psi, _matrix(model["sigma"]), psi)
    return np.sqrt(np.cumsum(variance, axis=0))


def var_forecast(models: DataFrame, columns: Sequence[str], keys: Sequence[str], steps: int | str = 30, level: float = 0.95) -> DataFrame:
    """(keys, ds, variable, yhat, yhat_lower, yhat_upper, status, error): iterated forecasts with differences undone.

    The interval covers the errors to come, not those of the coefficients.
    ``steps`` is a number, or a column of ``models``.
    """
    columns, z, wanted = list(columns), z_value((1 + level) / 2), steps

    def rows(model):
        steps = int(model[wanted]) if isinstance(wanted, str) else wanted
        if steps < 1:
            return []
        coef, past = _matrix(model["coef"]), [list(r) for r in model["recent"]]
        p = int(model["lag_order"])
        path = []
        for _ in range(steps):
            x = np.concatenate([[1.0], *[past[-k] for k in range(1, p + 1)]])
            nxt = coef @ x
            past.append(nxt)
            path.append(nxt)
        path, half = np.array(path), z * _spread(model, steps)
        out = []
        for j, c in enumerate(columns):
            values = _undo(path[:, j], int(model["diff_order"][j]), model["last_level"][j], model["last_step"][j])
            out += [
                (model["last_ds"] + timedelta(days=i + 1), c, float(v), float(v - half[i, j]), float(v + half[i, j])) for i, v in enumerate(values)
            ]
        return out

    return _from_models(models, keys, "ds date, variable string, yhat double, yhat_lower double, yhat_upper double", rows)


def _responses(model, steps: int) -> np.ndarray:
    """Orthogonalised responses [step, response, impulse] from the moving-average form."""
    sigma = _matrix(model["sigma"])
    root = np.linalg.cholesky(sigma + 1e-12 * np.eye(len(sigma)))
    return np.array([m @ root for m in _moving_average(model, steps)])


def var_irf(models: DataFrame, columns: Sequence[str], keys: Sequence[str], steps: int = 10) -> DataFrame:
    """(keys, impulse, response, step, value) for steps 0..steps."""
    columns = list(columns)

    def rows(model):
        theta = _responses(model, steps)
        return [
            (columns[i], columns[r], s, float(theta[s, r, i]))
            for s in range(steps + 1) for r in range(len(columns)) for i in range(len(columns))
        ]

    return _from_models(models, keys, "impulse string, response string, step int, value double", rows)


def var_fevd(models: DataFrame, columns: Sequence[str], keys: Sequence[str], steps: int = 10) -> DataFrame:
    """(keys, variable, impulse, step, share): shares of forecast error variance, summing to 1 over impulses."""
    columns = list(columns)

    def rows(model):
        squared = np.cumsum(_responses(model, steps - 1) ** 2, axis=0)
        share = squared / squared.sum(axis=2, keepdims=True)
        return [
            (columns[r], columns[i], s + 1, float(share[s, r, i]))
            for s in range(steps) for r in range(len(columns)) for i in range(len(columns))
        ]

    return _from_models(models, keys, "variable string, impulse string, step int, share double", rows)


def var_coefficients(models: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """(keys, equation, term, coefficient): the constant, then L1.., one term per lag and variable."""
    names = F.array(*[F.lit(c) for c in columns])
    k = len(columns)
    eqs = models.where(F.col("status") == "ok").select(*keys, F.posexplode("coef").alias("_e", "_row"))
    terms = eqs.select(*keys, names[F.col("_e")].alias("equation"), F.posexplode("_row").alias("_t", "coefficient"))
    lag = (F.floor((F.col("_t") - 1) / F.lit(k)) + 1).cast("string")
    label = F.when(F.col("_t") == 0, "const").otherwise(
        F.concat(F.lit("L"), lag, F.lit("."), F.try_element_at(names, (F.pmod(F.col("_t") - 1, F.lit(k)) + 1).cast("int")))
    )
    return terms.select(*keys, "equation", label.alias("term"), "coefficient")


def var_lag_scores(models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, criterion, lag_order, score, selected)."""
    long = models.where(F.col("status") == "ok").select(*keys, F.explode("scores").alias("criterion", "_s"))
    rows = long.select(*keys, "criterion", F.array_min("_s").alias("_best"), F.posexplode("_s").alias("lag_order", "score"))
    return rows.select(*keys, "criterion", "lag_order", "score", (F.col("score") == F.col("_best")).alias("selected"))


def stationarity(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], date: str = "date", alpha: float = ALPHA, gaps: str = "interpolate"
) -> DataFrame:
    """(keys, variable, statistic, lags, critical_value, p_value, is_stationary) of the unit-root test per series.

    A series is stationary if its p-value is below ``alpha``; too short or
    constant ones have no statistic and are not.  The critical value is NULL at
    levels other than 0.01, 0.05 and 0.1.
    """
    keys, columns = list(keys), list(columns)
    tail = "variable string, statistic double, lags int, critical_value double, p_value double, is_stationary boolean"
    schema = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(tail).fields])

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ds")
        rows = []
        for c in columns:
            stat, order, critical = adf(pdf[c].dropna().to_numpy(float), alpha)
            p = unit_root_tail(stat)
            known = [None if v != v else v for v in (stat, critical, p)]
            rows.append((*[pdf[k].iloc[0] for k in keys], c, known[0], order, *known[1:], p < alpha))
        return pd.DataFrame(rows, columns=schema.fieldNames())

    return _daily(df, keys, columns, date, gaps).groupBy(*keys).applyInPandas(test, schema)


def granger(
    df: DataFrame, cause: str, effect: str, keys: Sequence[str], lags: int = 5, date: str = "date", alpha: float = ALPHA, gaps: str = "interpolate"
) -> DataFrame:
    """(keys, f_statistic, df_num, df_den, p_value, is_cause): does the past of ``cause`` improve the autoregression of ``effect``?

    Series with too few rows have no statistic.
    """
    keys = list(keys)
    tail = "f_statistic double, df_num int, df_den int, p_value double, is_cause boolean"
    schema = T.StructType([*[df.schema[k] for k in keys], *T.StructType.fromDDL(tail).fields])

    def test(pdf: pd.DataFrame) -> pd.DataFrame:
        head = [pdf[k].iloc[0] for k in keys]
        pdf = pdf.dropna(subset=[cause, effect]).sort_values("ds")
        free = len(pdf) - lags - (2 * lags + 1)
        f = p = None
        if free > 0:
            y, x = pdf[[effect]].to_numpy(float), pdf[[effect, cause]].to_numpy(float)
            _, e0 = _ols(_lag_matrix(y, lags, lags), y[lags:])
            _, e1 = _ols(_lag_matrix(x, lags, lags), y[lags:])
            rss0, rss1 = float((e0**2).sum()), float((e1**2).sum())
            if rss1 > 0:
                f = ((rss0 - rss1) / lags) / (rss1 / free)
                p = f_tail(f, lags, free)
        return pd.DataFrame([(*head, f, lags, free, p, None if p is None else p < alpha)], columns=schema.fieldNames())

    return _daily(df, keys, [cause, effect], date, gaps).groupBy(*keys).applyInPandas(test, schema)
