"""Top-k, deterministic samples, long and wide forms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.operators.windows import latest, newest_rows

HISTORY = 20
SAMPLE_ROWS = 100
TOP_FEATURES = 15


def top_rows(df: DataFrame, by: str, count: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``count`` largest rows, found per task and merged."""
    return df.orderBy(F.desc_nulls_last(by), *ties).limit(count)


def head(df: DataFrame, order: Sequence[str], count: int = 10) -> DataFrame:
    return df.orderBy(*order).limit(count)


def newest_alerts(alerts: DataFrame, order: Sequence[str], keys: Sequence[str] = (), count: int = HISTORY) -> DataFrame:
    """Bounded alert history, for all alerts or per key."""
    if keys:
        return newest_rows(alerts, keys, order, count)
    return alerts.orderBy(*[F.desc(c) for c in order]).limit(count)


def seeded_sample(df: DataFrame, key: str, count: int = SAMPLE_ROWS, seed: int = 42) -> DataFrame:
    """The same ``count`` rows for the same seed, wherever the rows lie."""
    mixed = F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary"))
    return df.orderBy(mixed, key).limit(count)


def latest_long(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], default: float | None = 0.0) -> DataFrame:
    """Newest row of each series as (series, name, value)."""
    present = [c for c in columns if c in df.columns]
    newest = latest(df.select(*keys, *order, *present), keys, order)
    long = newest.unpivot(list(keys), present, "name", "value")
    if default is None:
        return long
    return long.withColumn("value", F.coalesce("value", F.lit(default)))


def results_long(df: DataFrame, results: str) -> DataFrame:
    """Map of model name to metrics struct as one row per model."""
    return df.select(F.explode(results).alias("model", "metrics")).select("model", "metrics.*")


def importance_wide(long: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per model, one column per feature."""
    return long.groupBy("model").pivot("feature", list(features)).agg(F.first("importance"))


def importance_long(wide: DataFrame, features: Sequence[str]) -> DataFrame:
    return wide.unpivot(["model"], list(features), "feature", "importance")


def ranked_results(results: DataFrame) -> DataFrame:
    """Models by error; failed ones, without an error value, come last."""
    return results.orderBy(F.asc_nulls_last("rmse_mean"), "model")


def best_model(results: DataFrame) -> DataFrame:
    usable = results.filter(F.col("error").isNull() & F.col("rmse_mean").isNotNull())
    return usable.agg(
        F.min_by("model", F.struct("rmse_mean", "model")).alias("best_model"),
        F.min("rmse_mean").alias("best_rmse"),
    )
