"""Forecasts several steps ahead: labels, seasonal baseline, intervals."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions import bands
from airloom.ml.prepare import LABEL, column_medians
from airloom.ml.validate import ROW, fit, fold_bounds
from airloom.operators.cuts import OWN, ROWS_PER_CUT, arrange
from airloom.operators.quantiles import quantiles
from airloom.operators.windows import latest, newest_rows, with_position
from airloom.schemas import check_hours_ahead, finite
from airloom.session import materialise

FORECAST_HOURS = 72  # fixed value: default horizon
SEASON = 24


def horizon_labels(
    df: DataFrame, target: str, keys: Sequence[str], order: Sequence[str],
    horizons: Sequence[int], rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    """The target ``h`` rows later as ``target_ahead_<h>`` for each horizon."""
    for h in horizons:
        check_hours_ahead(h)
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    w = arranged.window()
    rows = arranged.extend(after=max(horizons)).select(
        "*", *[F.lead(target, h).over(w).alias(f"{target}_ahead_{h}") for h in horizons]
    )
    return rows.filter(OWN).drop(OWN, "_cut")


def horizons_long(df: DataFrame, target: str, horizons: Sequence[int]) -> DataFrame:
    """One row per observation and horizon."""
    labels = [c for c in df.columns if c.startswith(f"{target}_ahead_")]
    pairs = F.array(
        *[
            F.struct(F.lit(h).alias("horizon"), F.col(f"{target}_ahead_{h}").alias("actual"))
            for h in horizons
        ]
    )
    kept = [c for c in df.columns if c not in labels]
    return df.select(*kept, F.inline(pairs))


def seasonal_naive(
    df: DataFrame, target: str, keys: Sequence[str], order: Sequence[str],
    season: int = SEASON, rows_per_cut: int = ROWS_PER_CUT, longest: int | None = None,
) -> DataFrame:
    """Baseline: the value one season earlier, as ``prediction``."""
    arranged = arrange(df, keys, order, rows_per_cut, longest)
    rows = arranged.extend(before=season).withColumn(
        "prediction", F.lag(target, season).over(arranged.window())
    )
    return rows.filter(OWN).drop(OWN, "_cut")


def labelled_ahead(
    df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], order: Sequence[str],
    horizons: Sequence[int], longest: int | None = None,
) -> DataFrame:
    """One written frame of (observation, horizon): position in time, when its label is known, label."""
    time = order[0]
    for h in horizons:
        check_hours_ahead(h)
    arranged = arrange(df, keys, order, ROWS_PER_CUT, longest)
    w = arranged.window()
    pairs = F.array(*[
        F.struct(
            F.lit(h).alias("horizon"), F.lead(target, h).over(w).cast("double").alias(LABEL),
            F.lead(time, h).over(w).alias("_known"),
        )
        for h in horizons
    ])
    rows = arranged.extend(after=max(horizons)).select("*", pairs.alias("_ahead")).filter(OWN)
    cleaned = rows.select(*keys, *order, *[finite(F.col(c).cast("double")).alias(c) for c in features], "_ahead")
    placed = with_position(cleaned, [], [*order, *keys], ROW)
    return materialise(
        placed.select(*keys, *order, *features, ROW, F.inline("_ahead")).filter(F.col(LABEL).isNotNull()), "ahead"
    )


def held_out_residuals(
    ahead: DataFrame, features: Sequence[str], time: str, factory: Callable, horizon: int, folds: int
) -> DataFrame:
    """(horizon, residual) of rows that the model they are predicted with has not seen.

    The origin rolls forward over the folds. A fold's model is trained on what was known at its
    origin: rows whose label lies before the first held-out row.
    """
    rows = ahead.filter(F.col("horizon") == horizon)
    out = None
    for _, start, end in fold_bounds(ahead.agg(F.max(ROW)).first()[0] + 1, folds):
        held = rows.filter(F.col(ROW).between(start, end - 1))
        origin = held.agg(F.min(time)).first()[0]
        train = rows.filter(F.col("_known") < F.lit(origin))
        if origin is None or train.isEmpty():
            continue
        fitted = fit(train, column_medians(train, features), factory)
        part = fitted.transform(held).select("horizon", (F.col(LABEL) - F.col("prediction")).alias("residual"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError(f"too few rows for residuals {horizon} ahead")
    return out


def with_intervals(forecasts: DataFrame, residuals: DataFrame, horizons: Sequence[int], coverage: float) -> DataFrame:
    """Band around ``prediction`` from the quantiles of the residuals of each horizon."""
    names = {h: f"_r{h}" for h in horizons}
    wide = residuals.select(*[F.when(F.col("horizon") == h, F.col("residual")).alias(n) for h, n in names.items()])
    ends = quantiles(wide, list(names.values()), [(1 - coverage) / 2, (1 + coverage) / 2])
    bands = forecasts.sparkSession.createDataFrame(
        [(h, *ends[n]) for h, n in names.items()], "hours_ahead int, _low double, _high double"
    )
    return forecasts.join(F.broadcast(bands), "hours_ahead").withColumns(
        {"lower": F.col("prediction") + F.col("_low"), "upper": F.col("prediction") + F.col("_high")}
    ).drop("_low", "_high")


def forecast(
    df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str],
    order: Sequence[str], factory: Callable, horizons: Sequence[int],
    coverage: float | None = 0.9, longest: int | None = None, folds: int = 3,
) -> DataFrame:
    """Direct forecasts from each series' newest row, one model per horizon.

    The interval of a horizon comes from held-out residuals of rolling origins at that horizon.
    """
    ahead = labelled_ahead(df, features, target, keys, order, horizons, longest)
    newest = latest(df, keys, order).withColumns({c: finite(F.col(c).cast("double")) for c in features})
    out = residuals = None
    for h in horizons:
        train = ahead.filter(F.col("horizon") == h)
        fitted = fit(train, column_medians(train, features), factory)
        part = fitted.transform(newest).select(
            *keys, *order, F.lit(h).alias("hours_ahead"), "prediction"
        )
        out = part if out is None else out.unionByName(part)
        if coverage is not None:
            past = held_out_residuals(ahead, features, order[0], factory, h, folds)
            residuals = past if residuals is None else residuals.unionByName(past)
    if coverage is None:
        return out
    shown = [*keys, *order, "hours_ahead", "prediction", "lower", "upper"]
    return with_intervals(out, materialise(residuals, "residuals"), horizons, coverage).select(*shown)


def seasonal_forecast(
    df: DataFrame, target: str, keys: Sequence[str], time: str, hours: int = FORECAST_HOURS, season: int = SEASON
) -> DataFrame:
    """The last season repeated: hourly (keys, ``time``, hours_ahead, prediction) after each series' end."""
    check_hours_ahead(hours)
    tail = newest_rows(df.select(*keys, time, target), keys, [time], season)
    backwards = Window.partitionBy(*keys).orderBy(F.desc(time))
    last = tail.select(
        *keys, target, F.max(time).over(Window.partitionBy(*keys)).alias("_end"),
        (season - F.row_number().over(backwards)).alias("_place"),
    )
    ahead = F.explode(F.filter(F.sequence(F.lit(1), F.lit(hours)), lambda h: (h - 1) % season == F.col("_place")))
    return last.select(*keys, "_end", F.col(target).alias("prediction"), ahead.alias("hours_ahead")).select(
        *keys, (F.col("_end") + F.make_dt_interval(F.lit(0), F.col("hours_ahead"))).alias(time), "hours_ahead", "prediction"
    )


def daily_alerts(forecasts: DataFrame, keys: Sequence[str], time: str, thresholds=None) -> DataFrame:
    """Each forecast day's highest prediction, its level and whether it calls for a banner."""
    days = forecasts.groupBy(*keys, F.to_date(time).alias("day")).agg(F.max("prediction").alias("highest"))
    level = bands.alert(F.col("highest"), thresholds or bands.THRESHOLDS)["level"]
    return days.select(
        *keys, bands.day_text(F.col("day")).alias("day"), bands.weekday_text(F.col("day")).alias("day_name"),
        "highest", level.alias("level"), F.coalesce(bands.is_banner(level), F.lit(False)).alias("has_alert"),
    )


def ensemble(predictions: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Average of several models' predictions for the same rows."""
    stacked = predictions[0].select(*keys, "prediction")
    for other in predictions[1:]:
        stacked = stacked.unionByName(other.select(*keys, "prediction"))
    return stacked.groupBy(*keys).agg(F.avg("prediction").alias("prediction"))
