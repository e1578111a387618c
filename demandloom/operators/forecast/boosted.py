"""Boosted trees pooled over all series (Spark ML), with direct multi-step forecasts.

Series are put on a calendar without gaps, so that lags and horizon both count
days.  A training row pairs a target day with the history known ``h`` days
earlier.  ``h`` rotates over 1..horizon by a hash of series and day, so every
target is used once and the table is not multiplied by the horizon.  Only the
forecast itself is expanded to the horizon.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom.functions.exprs import numeric_columns, series_window
from demandloom.operators.aggregate import latest_row, row_positions
from demandloom.operators.calendar import calendar_fill
from demandloom.operators.features_time import gbt_date_features
from demandloom.operators.forecast.additive import param_grid
from demandloom.operators.missing import fill_series
from demandloom.sources.io import scratch_path, settle

# Lag offsets, calendar features and booster settings.
LAGS = (1, 7, 14, 28)
DATE_FEATURES = ("day_of_week", "day_of_month", "month", "year")
MAX_ITER, STEP_SIZE, MAX_DEPTH, TRAIN_SHARE = 100, 0.05, 5, 0.8

#: Values of a categorical feature at most: trees keep a bin for each.
MOST_CATEGORIES = 10_000


#: Rows of a fit's partition at least: a booster runs hundreds of jobs, each with two tasks for every partition.
FIT_ROWS = 100_000


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """``rows``, held while fits read them, in as few partitions as their number needs; a lost block is recomputed."""
    held = rows.persist()
    try:
        yield held.coalesce(max(1, -(-held.count() // FIT_ROWS)))
    finally:
        held.unpersist()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let Spark ML cut its lineage in the shared folder the cluster names; a local one only in tests."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))


def lag_names(lags: Sequence[int] = LAGS) -> list[str]:
    return [f"lag_{k}" for k in lags]


def on_calendar(
    df: DataFrame, keys: Sequence[str], features: Sequence[str] = (), categorical: Sequence[str] = (), gaps: str = "interpolate"
) -> DataFrame:
    """(keys, ds, y, known, features, categorical): one row for every day from a series' first to its last.

    Days without a finite value are filled as ``gaps`` says (interpolate, ffill
    or zero) for lags, and are not ``known``: nothing is learnt from them as
    targets.  Other columns keep their last value.
    """
    y = F.col("y").cast("double")
    finite = df.where(F.abs(y) < float("inf"))
    means = [F.avg(c).alias(c) for c in ("y", *features)]
    daily = finite.groupBy(*keys, "ds").agg(*means, *[F.min(F.col(c).cast("string")).alias(c) for c in categorical])
    dense = calendar_fill(daily, keys, "ds", method=None).withColumn("known", F.col("y").isNotNull())
    if features or categorical:
        dense = fill_series(dense, [*features, *categorical], "ffill", keys, "ds", edges=False)
    return fill_series(dense, "y", gaps, keys, "ds", edges=False)


def _lagged(calendar: DataFrame, keys: Sequence[str], lags: Sequence[int], after: int) -> DataFrame:
    """Add ``lag_k``, the value k - ``after`` days before the row."""
    w = series_window(keys, "ds")
    return calendar.withColumns({f"lag_{k}": F.lag("y", k - after).over(w) if k > after else F.col("y") for k in lags})


def training_rows(
    df: DataFrame,
    keys: Sequence[str],
    horizon: int = 30,
    lags: Sequence[int] = LAGS,
    features: Sequence[str] = (),
    categorical: Sequence[str] = (),
    gaps: str = "interpolate",
) -> DataFrame:
    """(keys, ds, y, h, lag_k..., calendar, features, is_validation): one row per known target with complete lags.

    Lags are taken at the origin, ``h`` days before the target, and come by a join on series and day.
    """
    return _training(settle(on_calendar(df, keys, features, categorical, gaps), "calendar"), keys, horizon, lags, [*features, *categorical])


def _training(calendar: DataFrame, keys: Sequence[str], horizon: int, lags: Sequence[int], features: Sequence[str]) -> DataFrame:
    w = series_window(keys, "ds")
    place = {"_k": F.row_number().over(w), "_n": F.count(F.lit(1)).over(Window.partitionBy(*keys))}
    targets = calendar.withColumns(place).where("known")
    targets = targets.withColumn("h", F.pmod(F.hash(*keys, "ds"), F.lit(horizon)) + 1).withColumn("_from", F.date_sub("ds", F.col("h")))
    targets = targets.withColumn("is_validation", F.col("_k") > F.floor(F.col("_n") * F.lit(TRAIN_SHARE))).drop("_k", "_n", "known")
    origins = _lagged(calendar, keys, lags, 1).select(*keys, F.col("ds").alias("_from"), *lag_names(lags))
    rows = gbt_date_features(targets.join(origins, [*keys, "_from"]).drop("_from"), "ds")
    return rows.na.drop(subset=[*lag_names(lags), *features])


def assemble(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="skip").transform(rows)


def model_columns(lags: Sequence[int] = LAGS, features: Sequence[str] = ()) -> list[str]:
    return [*features, *DATE_FEATURES, *lag_names(lags), "h"]


def fit_gbt(
    rows: DataFrame,
    columns: Sequence[str],
    max_iter: int = MAX_ITER,
    step_size: float = STEP_SIZE,
    max_depth: int = MAX_DEPTH,
    early_stopping: bool = True,
    categorical: Sequence[str] = (),
    **settings,
) -> PipelineModel:
    """Pooled booster; with early stopping it watches the last fifth of every series.

    Without, only the first four fifths are used, as the held-out part must
    stay unseen.  ``categorical`` names those of ``columns`` whose values are
    kinds: they are indexed, and trees split on sets of kinds; a kind not seen
    in training is one more.  The result is a pipeline from these columns to
    ``yhat``, which ``write_pooled`` saves whole.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    if not early_stopping:
        rows = rows.where(~F.col("is_validation"))
    stages = []
    if categorical:
        indexer = StringIndexer(
            inputCols=list(categorical), outputCols=[f"{c}_kind" for c in categorical], handleInvalid="keep", stringOrderType="alphabetAsc"
        ).fit(rows)
        kinds = max(len(v) for v in indexer.labelsArray) + 1
        if kinds > MOST_CATEGORIES:
            raise ValueError(f"more than {MOST_CATEGORIES} kinds; encode the column by one_hot_index and give it as a number")
        settings = {"maxBins": max(32, kinds), **settings}
        stages.append(indexer)
    stages.append(VectorAssembler(inputCols=[f"{c}_kind" if c in categorical else c for c in columns], outputCol="features", handleInvalid="skip"))
    gbt = GBTRegressor(
        featuresCol="features", labelCol="y", predictionCol="yhat", maxIter=max_iter, stepSize=step_size, maxDepth=max_depth,
        seed=42, **settings,
    )
    if early_stopping:
        gbt = gbt.setValidationIndicatorCol("is_validation")
    # trees read the vectors once for each level: keep only what they read, until the fit is done
    with kept(PipelineModel(stages).transform(rows.select(*columns, "y", "is_validation")).select("features", "y", "is_validation")) as ready:
        return PipelineModel([*stages, gbt.fit(ready)])


def write_pooled(model: PipelineModel, path: str) -> None:
    """Save a pooled model with its encodings to a folder that all tasks share."""
    model.write().overwrite().save(path)


def read_pooled(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def history_rows(
    df: DataFrame, keys: Sequence[str], lags: Sequence[int] = LAGS, features: Sequence[str] = (), categorical: Sequence[str] = (), gaps: str = "interpolate"
) -> DataFrame:
    """One-step rows: every known value with the days just before it."""
    return _history(on_calendar(df, keys, features, categorical, gaps), keys, lags)


def _history(calendar: DataFrame, keys: Sequence[str], lags: Sequence[int]) -> DataFrame:
    rows = _lagged(calendar, keys, lags, 0).where("known").drop("known").withColumn("h", F.lit(1))
    return gbt_date_features(rows, "ds").na.drop(subset=lag_names(lags))


def future_rows(
    df: DataFrame, keys: Sequence[str], horizon: int = 30, lags: Sequence[int] = LAGS, features: Sequence[str] = (),
    categorical: Sequence[str] = (), gaps: str = "interpolate",
) -> DataFrame:
    """The last days of each series for each of the next ``horizon`` days; other features keep their last value."""
    return _ahead(_last_days(on_calendar(df, keys, features, categorical, gaps), keys, lags), horizon).na.drop(subset=lag_names(lags))


def _last_days(calendar: DataFrame, keys: Sequence[str], lags: Sequence[int]) -> DataFrame:
    return latest_row(_lagged(calendar, keys, lags, 1).drop("known"), keys, "ds")


def _ahead(last: DataFrame, horizon: int) -> DataFrame:
    ahead = last.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    ahead = ahead.withColumns({"ds": F.date_add("ds", F.col("h")), "y": F.lit(None).cast("double")})
    return gbt_date_features(ahead, "ds")


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def forecast_gbt(
    df: DataFrame,
    keys: Sequence[str],
    horizon: int = 30,
    lags: Sequence[int] = LAGS,
    features: Sequence[str] = (),
    model: PipelineModel | None = None,
    categorical: Sequence[str] = (),
    gaps: str = "interpolate",
    **settings,
) -> DataFrame:
    """(keys, ds, y, yhat, status) for history (one step) and future (direct) of every series.

    History begins with the first day that has all lags.  A series whose last
    day lacks a lag or a feature has no future rows, but one row with status
    too_short.
    """
    features, categorical = list(features), list(categorical)
    calendar = settle(on_calendar(df, keys, features, categorical, gaps), "calendar")
    columns = model_columns(lags, [*features, *categorical])
    if model is None:
        model = fit_gbt(_training(calendar, keys, horizon, lags, [*features, *categorical]), columns, categorical=categorical, **settings)
    last = _last_days(calendar, keys, lags)
    needed = [*lag_names(lags), *features, *categorical]
    rows = _history(calendar, keys, lags).unionByName(_ahead(last.where(~_any_null(needed)), horizon))
    scored = model.transform(rows.na.drop(subset=needed)).select(*keys, "ds", "y", "yhat", F.lit("ok").alias("status"))
    short = last.where(_any_null(needed)).select(*keys, F.lit("too_short").alias("status"))
    return scored.unionByName(short, allowMissingColumns=True)


def importance_rows(spark: SparkSession, model, columns: Sequence[str]) -> DataFrame:
    """(feature, importance): one row per model column."""
    values = [float(v) for v in model.featureImportances.toArray()]
    return spark.createDataFrame(list(zip(columns, values)), "feature string, importance double")


def feature_importance(
    df: DataFrame, keys: Sequence[str], horizon: int = 30, features: Sequence[str] = (), categorical: Sequence[str] = (), **settings
) -> DataFrame:
    columns = model_columns(LAGS, [*features, *categorical])
    model = fit_gbt(training_rows(df, keys, horizon, LAGS, features, categorical), columns, categorical=categorical, **settings)
    return importance_rows(df.sparkSession, model.stages[-1], columns).orderBy(F.col("importance").desc(), "feature")


def select_features_model(df: DataFrame, target: str, n: int = 20, features: Sequence[str] | None = None, trees: int = 100) -> DataFrame:
    """(feature, importance) of the features at or above the median forest importance, at most n."""
    features = list(features) if features else numeric_columns(df, {target})
    ensure_checkpoint_dir(df.sparkSession)
    forest = RandomForestRegressor(featuresCol="features", labelCol=target, numTrees=trees, seed=42)
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).na.drop()
    model = forest.fit(assemble(rows, features).select("features", target))
    scores = importance_rows(df.sparkSession, model, features)
    ranked = sorted(float(v) for v in model.featureImportances.toArray())
    mid = len(ranked) // 2
    median = ranked[mid] if len(ranked) % 2 else (ranked[mid - 1] + ranked[mid]) / 2
    return scores.where(F.col("importance") >= median).orderBy(F.col("importance").desc(), "feature").limit(n)


def grid_search_gbt(
    rows: DataFrame,
    columns: Sequence[str],
    grid: Mapping[str, Sequence],
    order: Sequence[str],
    n_splits: int = 5,
    parallelism: int = 4,
    **settings,
) -> DataFrame:
    """(parameters, rmse, rank): mean RMSE over expanding folds of every combination, best first.

    Rows in ``order`` are cut as ``ts_cv_folds`` does, but not copied: each
    carries the number of its block, and a fold is tested on its own block
    after a fit on all blocks before it.  Rows are kept once for all fits, of
    which ``parallelism`` run at a time.
    """
    spark = rows.sparkSession
    size = F.floor(F.col("_total") / F.lit(n_splits + 1))
    start = F.col("_total") - size * n_splits
    block = F.when(F.col("_pos") < start, F.lit(0)).otherwise(F.floor((F.col("_pos") - start) / size) + 1)
    placed = row_positions(rows.select(*dict.fromkeys([*order, *columns, "y"])), order).where(size > 0)
    assembled = assemble(placed.withColumn("block", block.cast("int")), columns).select("block", "features", "y")
    ensure_checkpoint_dir(spark)
    combos = param_grid(grid)

    def score(ready: DataFrame, job: tuple[int, int]) -> float | None:
        combo, fold = job
        gbt = GBTRegressor(featuresCol="features", labelCol="y", predictionCol="yhat", seed=42, **{**settings, **combos[combo]})
        err = F.col("yhat") - F.col("y")
        tested = gbt.fit(ready.where(F.col("block") < fold)).transform(ready.where(F.col("block") == fold))
        return tested.agg(F.sqrt(F.avg(err * err))).first()[0]

    jobs = [(c, f) for c in range(len(combos)) for f in range(1, n_splits + 1)]
    with kept(assembled) as ready:
        if ready.isEmpty():
            raise ValueError("too few rows for the folds")
        with ThreadPoolExecutor(parallelism) as pool:
            scores = list(pool.map(inheritable_thread_target(partial(score, ready)), jobs))
    means = [sum(scores[i * n_splits : (i + 1) * n_splits]) / n_splits for i in range(len(combos))]
    best = sorted(range(len(combos)), key=lambda i: (means[i], i))
    return spark.createDataFrame([(*combos[i].values(), float(means[i]), r + 1) for r, i in enumerate(best)], [*grid, "rmse", "rank"])
