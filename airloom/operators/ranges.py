"""Time ranges: chunks, trailing slices, look-back slices, date spines."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators.windows import latest, newest_rows

CHUNK_DAYS = 30
# Rows before a slice that its features look back on.
LOOKBACK_ROWS = 2160


def chunks(bounds: DataFrame, start: str, end: str, days: int = CHUNK_DAYS) -> DataFrame:
    """Half-open chunks [chunk_start, chunk_end) covering each row's range."""
    width = F.make_dt_interval(F.lit(days))
    starts = F.sequence(F.col(start), F.col(end), width)
    return (
        bounds.filter(F.col(start) < F.col(end))
        .withColumn("chunk_start", F.explode(starts))
        .filter(F.col("chunk_start") < F.col(end))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + width, F.col(end)))
    )


def between(df: DataFrame, time: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Closed range; a plain filter, so it reaches the scan."""
    return df.filter(F.col(time).between(F.lit(start), F.lit(end)))


def backfill_bounds(end: dt.datetime, years: int = 2) -> tuple[dt.datetime, dt.datetime]:
    return end - dt.timedelta(days=365 * years), end


def incremental_bounds(end: dt.datetime, hours: int = 24) -> tuple[dt.datetime, dt.datetime]:
    return end - dt.timedelta(hours=hours), end


def recent(df: DataFrame, time: str, end: dt.datetime, hours: int = 24 * 30) -> DataFrame:
    start = end - dt.timedelta(hours=hours)
    return df.filter((F.col(time) > F.lit(start)) & (F.col(time) <= F.lit(end)))


def last_days(df: DataFrame, time: str, days: int = 7) -> DataFrame:
    """Rows strictly later than the newest time minus ``days``.

    The newest time becomes a literal, so the filter reaches the scan.
    """
    newest = df.agg(F.max(time)).first()[0]
    if newest is None:
        return df
    return df.filter(F.col(time) > F.lit(newest - dt.timedelta(days=days)))


def tail(df: DataFrame, keys: Sequence[str], order: Sequence[str], period: int = 24) -> DataFrame:
    """The last ten periods of every series."""
    return newest_rows(df, keys, order, period * 10)


def with_lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    start: dt.datetime,
    end: dt.datetime,
    compute: Callable[[DataFrame], DataFrame],
    rows: int = LOOKBACK_ROWS,
) -> DataFrame:
    """``compute`` on a slice plus the rows before it, cut back to the slice.

    Per series only the ``rows`` newest earlier rows are kept, chosen before
    the shuffle, so lags and long means at the slice's start are those of the
    whole series.
    """
    time = order[0]
    inside = df.filter(F.col(time).between(F.lit(start), F.lit(end)))
    earlier = newest_rows(df.filter(F.col(time) < F.lit(start)), keys, order, rows)
    return compute(earlier.unionByName(inside)).filter(F.col(time) >= F.lit(start))


def date_spine(df: DataFrame, day: str, days: int = 3) -> DataFrame:
    """``days`` consecutive dates from each row's date on."""
    step = F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("day_ahead")
    return df.select("*", step).withColumn(
        "forecast_date", F.date_add(F.to_date(day), F.col("day_ahead"))
    )


def hour_spine(spark: SparkSession, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Every hour in [start, end]."""
    hours = int((end - start).total_seconds() // 3600) + 1
    origin = F.lit(start)
    return spark.range(hours).select(
        (origin + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datetime")
    )


def hourly_grid(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Complete hourly grid per series: absent hours become rows of NULLs.

    Rows off the full hour stand for their hour, the newest of it counts.
    """
    stamped = df.withColumn("_hour", F.date_trunc("hour", F.col(time)))
    spans = stamped.groupBy(*keys).agg(F.min("_hour").alias("_from"), F.max("_hour").alias("_to"))
    grid = spans.select(
        *keys,
        F.explode(F.sequence("_from", "_to", F.expr("interval 1 hour"))).alias(time),
    )
    newest = latest(stamped, [*keys, "_hour"], [time])
    return grid.join(newest.drop(time).withColumnRenamed("_hour", time), [*keys, time], "left")
