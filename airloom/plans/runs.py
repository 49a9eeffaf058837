"""User-level runs: landed payloads to features, features to a registered model."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.atmosphere import ESTIMATE_POLLUTANTS, estimate_columns
from airloom.ml.models import MODELS
from airloom.ml.validate import Fitted, score, train_best
from airloom.operators import ranges
from airloom.operators.joins import dedup_latest
from airloom.operators.windows import ema
from airloom.plans.carry import Carry, refreshed
from airloom.plans.features import feature_frame, training_columns
from airloom.schemas import SERIES, TARGET, TIME, nan_to_null, observation_rules, validate
from airloom.sources import payloads, tables


def observations(
    weather: DataFrame, readings: DataFrame | None = None, payload: str = "payload", zone: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Archive payloads to clean hourly observations, and the rejected rows.

    The payloads' times are local to ``zone``; observations hold instants.
    A target the payload lacks is estimated from the weather and the station's
    reading, one row per series, where there is one.  Repeated hours collapse.
    """
    rows = nan_to_null(payloads.hourly_archive(weather, payload, [SERIES], zone))
    names = (TARGET, *ESTIMATE_POLLUTANTS)
    if readings is None:
        known = {k: F.lit(None).cast("double") for k in names}
    else:
        chosen = readings.select(SERIES, *[F.col(k).alias(f"_now_{k}") for k in names])
        rows = rows.join(chosen.dropDuplicates([SERIES]), SERIES, "left")
        known = {k: F.col(f"_now_{k}") for k in names}
    estimates = estimate_columns(known[TARGET], known)
    record = rows.withColumns({k: estimates[k] for k in names})
    flat = payloads.flatten_observations(record, [SERIES])
    valid, rejects = validate(flat, observation_rules())
    return dedup_latest(valid, [SERIES, TIME], ["source"]), rejects


def historical(
    rows: DataFrame, start: dt.datetime, end: dt.datetime, output: str | None = None, context: bool = True
) -> DataFrame:
    """Features of the observations in [start, end], written where asked.

    An hour's features are those of any other run: earlier rows are read as context. Without
    ``context`` the series starts at ``start``.
    """
    if context:
        features = with_context(rows, start, end)
    else:
        features = feature_frame(ranges.between(rows, TIME, start, end))
    if output is not None:
        tables.write_features(features, output, TIME, mode="overwrite")
    return features


def backfill(rows: DataFrame, end: dt.datetime, years: int = 2, output: str | None = None) -> DataFrame:
    return historical(rows, *ranges.backfill_bounds(end, years), output)


def with_context(rows: DataFrame, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Features of [start, end], with the rows before it as context.

    Lags and windows need a bounded number of earlier rows; the exponential
    averages need all of them, for which three columns of the history are read
    (``refresh`` goes on from stored states instead).
    """
    features = ranges.with_lookback(rows, [SERIES], [TIME], start, end, feature_frame)
    history = nan_to_null(rows.filter(F.col(TIME) <= F.lit(end)).select(SERIES, TIME, TARGET))
    averages = ema(history, TARGET, [SERIES], [TIME]).filter(F.col(TIME) >= F.lit(start)).drop(TARGET)
    partial = [c for c in averages.columns if c not in (SERIES, TIME)]
    return features.drop(*partial).join(averages, [SERIES, TIME], "left").select(*features.columns)


def incremental(rows: DataFrame, end: dt.datetime, hours: int = 24, output: str | None = None) -> DataFrame:
    """Features of the last hours, with the rows before them as context."""
    features = with_context(rows, *ranges.incremental_bounds(end, hours))
    if output is not None:
        tables.upsert_days(features, output, [SERIES, TIME], TIME)
    return features


def refresh(
    spark: SparkSession, fresh: DataFrame, history: str, states: str, output: str | None = None,
    compute: Callable[[DataFrame], DataFrame] = feature_frame, lookback: int = ranges.LOOKBACK_ROWS,
) -> DataFrame:
    """Bring stored observations and features up to date with newly arrived rows, late ones included.

    The averages go on from the ``states`` by day kept beside the ``history``; of it only the
    changed days and those that lags and windows look back on are read.
    """
    tables.upsert_days(fresh, history, [SERIES, TIME], TIME)
    changed = fresh.groupBy(SERIES).agg(F.min(TIME).alias("_since"))
    carry = Carry(states, [SERIES], TIME, TARGET)
    out = refreshed(spark.read.parquet(history), changed, carry, lookback, compute)
    if output is not None:
        tables.upsert_days(out, output, [SERIES, TIME], TIME)
    return out


def training(
    spark: SparkSession, features: DataFrame, registry: str, model_path: str,
    order: Sequence[str] = (TIME, SERIES), models: Mapping = MODELS, folds: int = 5,
    leave_out: Sequence[str] = (SERIES, "event_date"),
) -> dict:
    """Compare the models, save and register the best one."""
    columns = training_columns(features, leave_out)
    results, best, fitted = train_best(features, columns, TARGET, order, models, folds)
    tables.write_results(results, f"{model_path}/results")
    score = results.filter(F.col("model") == best).first()
    metrics = {"rmse": score["rmse_mean"], "mae": score["mae_mean"], "r2": score["r2_mean"]}
    version = save_and_register(spark, fitted, registry, model_path, best, metrics, "best of the comparison")
    return {"best_model": best, "version": version, "n_features": len(columns), **metrics}


def save_and_register(
    spark: SparkSession, fitted: Fitted, registry: str, model_path: str, name: str,
    metrics: Mapping[str, float], description: str = "",
) -> int:
    """Save a model in a folder of its own version, then register it; returns the version."""
    version = tables.free_version(spark, registry, name)
    path = f"{model_path}/{name}/version={version}"
    fitted.save(path)
    return tables.register_model(spark, registry, name, metrics, description, path, version)


def load_model(spark: SparkSession, registry: str, name: str, version: int | None = None) -> Fitted:
    """A registered model, the newest of its name unless a version is given."""
    return Fitted.load(tables.registered_path(spark, registry, name, version))


def scoring(
    spark: SparkSession, features: DataFrame, registry: str, name: str, version: int | None = None,
    leave_out: Sequence[str] = (SERIES, "event_date"),
) -> DataFrame:
    """Predictions of a registered model beside the feature rows."""
    return score(features, load_model(spark, registry, name, version), training_columns(features, leave_out))
