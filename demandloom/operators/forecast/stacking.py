"""Meta-learners over model forecasts (Spark ML), and the choice between combination methods."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.ensemble import ensemble_average, ensemble_median, ensemble_weighted, ensemble_weights
from demandloom.operators.forecast.boosted import assemble, ensure_checkpoint_dir, kept

# Meta-learners and their penalties.
META_LEARNERS = ("ridge", "lasso", "elastic_net", "random_forest", "gradient_boosting")
RIDGE_ALPHA, SPARSE_ALPHA, ELASTIC_RATIO, TREES, SEED = 1.0, 0.1, 0.5, 100, 42
#: Fits at a time: small ones wait for the driver's scheduling rather than for cores.
FITS = 8
METHODS = ("simple_average", "weighted_average", "median", "meta_learner")


def meta_learner(name: str, rows: int = 1, spread: float = 1.0):
    """An unfitted learner.

    Spark averages the loss and divides its squared penalty by the label's
    deviation (``spread``); the penalties are set so that the usual objectives
    result: the summed loss plus alpha |w|^2 for ridge, the mean loss plus
    alpha (ratio |w| + (1 - ratio) |w|^2 / 2) for the sparse ones.
    """
    common = {"featuresCol": "features", "labelCol": "y", "predictionCol": "ensemble"}
    penalties = {
        "ridge": (0.0, RIDGE_ALPHA * spread / max(rows, 1)),
        "lasso": (SPARSE_ALPHA, 0.0),
        "elastic_net": (SPARSE_ALPHA * ELASTIC_RATIO, SPARSE_ALPHA * (1 - ELASTIC_RATIO) * spread),
    }
    if name in penalties:
        absolute, squared = penalties[name]
        total = absolute + squared
        return LinearRegression(
            standardization=False, regParam=total, elasticNetParam=absolute / total if total else 0.0, **common
        )
    if name == "random_forest":
        return RandomForestRegressor(numTrees=TREES, seed=SEED, **common)
    if name == "gradient_boosting":
        return GBTRegressor(maxIter=TREES, stepSize=0.1, maxDepth=3, seed=SEED, **common)
    raise ValueError(f"unknown meta-learner: {name}")


def _ready(wide: DataFrame, models: Sequence[str]) -> DataFrame:
    return assemble(wide.na.drop(subset=["y", *models]), models)


def fit_meta(wide: DataFrame, models: Sequence[str], name: str = "ridge"):
    with kept(_ready(wide, models).select("features", "y")) as ready:
        return _fit(ready, name)


def _fit(ready: DataFrame, name: str):
    ensure_checkpoint_dir(ready.sparkSession)
    if name in ("ridge", "elastic_net"):
        rows, spread = ready.agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
        return meta_learner(name, rows, spread or 1.0).fit(ready)
    return meta_learner(name).fit(ready)


def date_folds(wide: DataFrame, n_splits: int = 5, date: str = "ds") -> list[tuple]:
    """(first test day, last test day) of expanding folds over distinct dates; one small calendar is read."""
    days = [r[0] for r in wide.select(date).distinct().orderBy(date).collect()]
    size = len(days) // (n_splits + 1)
    if size == 0:
        raise ValueError("too few dates for the folds")
    starts = [len(days) - (n_splits - i) * size for i in range(n_splits)]
    return [(days[s], days[s + size - 1]) for s in starts]


def cv_scores(
    wide: DataFrame,
    models: Sequence[str],
    candidates: Sequence[str] = META_LEARNERS,
    n_splits: int = 5,
    date: str = "ds",
    parallelism: int = FITS,
) -> DataFrame:
    """(candidate, rmse, rank): mean test RMSE over time-ordered folds that split by date; ``parallelism`` fits run at a time."""
    # Fits repeat over the same rows: keep just what they read.
    with kept(_ready(wide, models).select(date, "features", "y")) as ready:
        results = _cv(ready, candidates, n_splits, date, parallelism)
    rows = [(n, s, i + 1) for i, (n, s) in enumerate(results)]
    return wide.sparkSession.createDataFrame(rows, "candidate string, rmse double, rank int")


def _cv(ready: DataFrame, candidates: Sequence[str], n_splits: int, date: str, parallelism: int = FITS) -> list[tuple[str, float]]:
    """(candidate, rmse), best first, over rows with ``features``."""
    ready = ready.where(F.col(date).isNotNull())
    folds = date_folds(ready, n_splits, date)
    err = F.col("ensemble") - F.col("y")

    def score(job: tuple[str, tuple]) -> float:
        name, (first, last) = job
        fitted = _fit(ready.where(F.col(date) < F.lit(first)), name)
        tested = fitted.transform(ready.where(F.col(date).between(F.lit(first), F.lit(last))))
        return tested.agg(F.sqrt(F.avg(err * err))).first()[0]

    jobs = [(name, fold) for name in candidates for fold in folds]
    with ThreadPoolExecutor(parallelism) as pool:
        scores = list(pool.map(inheritable_thread_target(score), jobs))
    means = [float(sum(scores[i : i + n_splits]) / n_splits) for i in range(0, len(jobs), n_splits)]
    return sorted(zip(candidates, means), key=lambda r: (r[1], r[0]))


def ensemble_stacked(
    wide: DataFrame,
    models: Sequence[str],
    candidates: Sequence[str] = ("ridge",),
    fit_on: DataFrame | None = None,
    n_splits: int = 5,
    date: str = "ds",
) -> DataFrame:
    """Add the meta-learner's ``ensemble``; several candidates are first compared on time folds.

    Rows that lack a model's forecast get NULL.
    """
    source = fit_on if fit_on is not None else wide
    with kept(_ready(source, models).select(date, "features", "y")) as ready:
        name = candidates[0] if len(candidates) == 1 else _cv(ready, candidates, n_splits, date)[0][0]
        fitted = _fit(ready, name)
    scored = fitted.transform(assemble(wide.na.drop(subset=list(models)), models)).select(*wide.columns, "ensemble")
    missing = reduce(lambda a, b: a | b, [F.col(m).isNull() for m in models])
    return scored.unionByName(wide.where(missing), allowMissingColumns=True)


def stacked_weights(wide: DataFrame, models: Sequence[str], name: str = "ridge") -> DataFrame:
    """(model, weight): coefficients of a linear meta-learner, importances of a tree one."""
    fitted = fit_meta(wide, models, name)
    values = fitted.coefficients if hasattr(fitted, "coefficients") else fitted.featureImportances
    rows = [(m, float(v)) for m, v in zip(models, values.toArray())]
    return wide.sparkSession.createDataFrame(rows, "model string, weight double")


def ensemble_best(
    wide: DataFrame,
    models: Sequence[str],
    methods: Sequence[str] = METHODS,
    holdout: float = 0.2,
    date: str = "ds",
    candidates: Sequence[str] = META_LEARNERS,
) -> DataFrame:
    """(method, rmse, is_best): methods fitted on the earlier dates and compared on the last ``holdout`` share.

    The meta-learner is the best of ``candidates`` on time folds of the earlier
    dates.  What the methods read is kept once for all of them.
    """
    columns = list(dict.fromkeys([date, "y", *models]))
    known = wide.select(*columns).na.drop(subset=["y", *models]).persist()
    err = F.col("ensemble") - F.col("y")
    try:
        days = [r[0] for r in known.select(date).distinct().orderBy(date).collect()]
        cut = F.lit(days[int(len(days) * (1 - holdout))])
        past, ahead = known.where(F.col(date) < cut), known.where(F.col(date) >= cut)
        makers = {
            "simple_average": lambda: ensemble_average(ahead, models),
            "weighted_average": lambda: ensemble_weighted(ahead, models, ensemble_weights(past, models)),
            "median": lambda: ensemble_median(ahead, models),
            "meta_learner": lambda: ensemble_stacked(ahead, models, candidates, fit_on=past, date=date),
        }
        scores = {m: makers[m]().agg(F.sqrt(F.avg(err * err))).first()[0] for m in methods}
    finally:
        known.unpersist()
    best = min(scores, key=lambda m: (scores[m], m))
    rows = [(m, float(v), m == best) for m, v in scores.items()]
    return wide.sparkSession.createDataFrame(rows, "method string, rmse double, is_best boolean")
