"""Batch scoring against model tables, and scoring of request tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.aggregate import latest_row
from demandloom.operators.forecast.additive import AdditiveSpec, score_additive
from demandloom.operators.forecast.var import var_forecast

# Request defaults, outcomes and kinds of models.
DEFAULT_HORIZON = 30
STATUSES = ("ok", "missing_id", "not_found", "missing_features", "bad_request")
KINDS = ("additive", "pooled", "var")


def write_models(models: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Model table to parquet: a refresh is a new version of this table."""
    models.write.mode(mode).parquet(path)


def read_models(spark, path: str, schema=None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def join_model_state(rows: DataFrame, models: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their model; a series without a model gives no rows.

    The model table grows with the series, so no broadcast is forced.
    """
    return rows.join(models.where(F.col("status") == "ok"), list(keys))


def score_batch(
    rows: DataFrame,
    models: DataFrame,
    keys: Sequence[str],
    horizon: int = DEFAULT_HORIZON,
    date: str = "date",
    spec: AdditiveSpec | None = None,
    future: DataFrame | None = None,
) -> DataFrame:
    """(keys, ds, yhat, yhat_lower, yhat_upper) for the ``horizon`` days after the input's last date.

    Models with regressors or holidays need ``future``: keys, ds and the values
    of these columns.  Settings come from the model table unless ``spec`` is given.
    """
    last = rows.groupBy(*keys).agg(F.max(F.col(date).cast("date")).alias("_last"))
    ahead = last.select(*keys, F.explode(F.sequence(F.date_add("_last", 1), F.date_add("_last", horizon))).alias("ds"))
    if future is not None:
        ahead = ahead.join(future, [*keys, "ds"], "left")
    scored = score_additive(ahead, models, keys, spec)
    return scored.select(*keys, "ds", "yhat", "yhat_lower", "yhat_upper")


def score_batch_var(
    rows: DataFrame, models: DataFrame, columns: Sequence[str], keys: Sequence[str], horizon: int = DEFAULT_HORIZON, date: str = "date"
) -> DataFrame:
    """(keys, ds, variable, yhat, yhat_lower, yhat_upper, status, error) of the ``horizon`` days after the input's last date.

    The autoregression goes on from its own last day, so days up to the input's are iterated but not returned.
    """
    last = rows.groupBy(*keys).agg(F.max(F.col(date).cast("date")).alias("_last"))
    ahead = models.join(last, list(keys)).withColumn("_steps", F.greatest(F.datediff("_last", "last_ds"), F.lit(0)) + F.lit(horizon))
    out = var_forecast(ahead, columns, keys, "_steps").join(last, list(keys))
    wanted = F.col("ds").isNull() | F.col("ds").between(F.date_add("_last", 1), F.date_add("_last", horizon))
    return out.where(wanted).drop("_last")


def score_batch_pooled(
    rows: DataFrame, model, keys: Sequence[str], features: Sequence[str], horizon: int = DEFAULT_HORIZON, date: str = "date"
) -> DataFrame:
    """(keys, ds, yhat): the pooled model's prediction for the last row, repeated on each future day.

    ``model`` is the pipeline of ``fit_gbt`` over ``features``, as ``read_pooled`` gives it.
    """
    last = latest_row(rows.select(*keys, date, *features), keys, date)
    scored = model.transform(last)
    days = F.explode(F.sequence(F.date_add(date, 1), F.date_add(date, horizon))).alias("ds")
    return scored.select(*keys, days, "yhat")


def score_requests(
    requests: DataFrame,
    models: DataFrame,
    spec: AdditiveSpec | None = None,
    needs_features: int = 0,
    var_models: DataFrame | None = None,
    var_columns: Sequence[str] = (),
    pooled=None,
    pooled_features: Sequence[str] = (),
) -> DataFrame:
    """One row per request and forecast day, with ``status``; failed requests give one row without a forecast.

    ``requests`` has request_id, model_id and may have horizon (30), freq
    (D, W or M), include_history (false), features and model_type (additive,
    pooled or var).  ``models`` and ``var_models`` are model tables with
    model_id.  ``pooled`` is the pipeline that serves all ids: its request
    gives the values of ``pooled_features`` in order and gets one row without a
    day.  A var request gets a row for each of ``var_columns`` and day, named in
    ``variable``.
    """
    r = requests
    defaults = {"horizon": F.lit(DEFAULT_HORIZON), "freq": F.lit("D"), "include_history": F.lit(False), "model_type": F.lit("additive")}
    for name, value in defaults.items():
        r = r.withColumn(name, F.coalesce(F.col(name), value) if name in r.columns else value)
    if "features" not in r.columns:
        r = r.withColumn("features", F.lit(None).cast("array<double>"))
    fitted = models.where(F.col("status") == "ok")
    known = fitted.select("model_id", F.lit("additive").alias("model_type"), "first_ds", "last_ds")
    if var_models is not None:
        own = var_models.where(F.col("status") == "ok").select("model_id", F.lit("var").alias("model_type"), F.lit(None).cast("date").alias("first_ds"), "last_ds")
        known = known.unionByName(own)
    joined = r.join(known.withColumn("_found", F.lit(True)), ["model_id", "model_type"], "left")
    kind = F.col("model_type")
    given = F.coalesce(F.size("features"), F.lit(-1))
    short = F.when(kind == "pooled", given != len(pooled_features)).otherwise(given < needs_features if needs_features else F.lit(False))
    served = [k for k, there in zip(KINDS, (True, pooled is not None, var_models is not None)) if there]
    status = (
        F.when(F.col("model_id").isNull(), "missing_id")
        .when(~kind.isin(*served), "bad_request")
        .when((kind != "pooled") & F.col("_found").isNull(), "not_found")
        .when(short, "missing_features")
        .when((F.col("horizon") < 0) | ~F.col("freq").isin("D", "W", "M"), "bad_request")
        .otherwise("ok")
    )
    joined = joined.withColumn("status", status)

    def step(i):
        by_day = F.date_add("last_ds", i * F.when(F.col("freq") == "W", 7).otherwise(1))
        return F.when(F.col("freq") == "M", F.add_months("last_ds", i)).otherwise(by_day)

    none = F.array().cast("array<date>")
    ahead = F.when(F.col("horizon") > 0, F.transform(F.sequence(F.lit(1), F.greatest("horizon", F.lit(1))), step)).otherwise(none)
    past = F.when(F.col("include_history"), F.sequence("first_ds", "last_ds")).otherwise(none)
    answered = joined.where(F.col("status") == "ok")
    ok = answered.where(kind == "additive").withColumn("_dates", F.concat(past, ahead))
    # History is shown in full, then the horizon.
    rows = ok.select("request_id", "model_id", F.explode("_dates").alias("ds"))
    out = score_additive(rows, models, ["model_id"], spec).withColumn("status", F.lit("ok"))
    out = out.select("request_id", "model_id", "ds", "yhat", "yhat_lower", "yhat_upper", "status")
    # a horizon of 0 without history asks for nothing, and says so in one row
    idle = ok.where(F.size("_dates") == 0).select("request_id", "model_id", "status")
    failed = joined.where(F.col("status") != "ok").select("request_id", "model_id", "status")
    rest = failed.unionByName(idle)
    if var_models is not None:
        asked = answered.where(kind == "var")
        rest = rest.unionByName(asked.where("horizon = 0").select("request_id", "model_id", "status"))
        states = var_models.join(asked.where("horizon > 0").select("request_id", "model_id", F.col("horizon").alias("_steps")), "model_id")
        out = out.unionByName(var_forecast(states, var_columns, ["request_id", "model_id"], "_steps").drop("error"), allowMissingColumns=True)
    if pooled is not None:
        values = [F.get("features", i).alias(c) for i, c in enumerate(pooled_features)]
        one = answered.where(kind == "pooled").select("request_id", "model_id", "status", *values)
        out = out.unionByName(pooled.transform(one).select("request_id", "model_id", "yhat", "status"), allowMissingColumns=True)
    return out.unionByName(rest, allowMissingColumns=True)
