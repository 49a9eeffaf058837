"""Calendar and cyclical features of a time column, as plain expressions."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
WEEKEND_DAYS = (5, 6)
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
MONSOON_MONTHS = (6, 7, 8, 9)
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (5, 6, 7)
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
CYCLE_PERIODS = {
    "hour": 24,
    "day_of_week": 7,
    "day_of_month": 31,
    "month": 12,
    "day_of_year": 365,
    "week_of_year": 52,
}
CYCLE_DEFAULTS = ("hour", "day_of_week", "month", "day_of_year", "week_of_year")
# Public holidays of 2024 and 2025.
HOLIDAYS = (
    "2024-03-23", "2024-04-10", "2024-04-11", "2024-04-12", "2024-06-16",
    "2024-06-17", "2024-06-18", "2024-08-14", "2024-09-06", "2024-11-09",
    "2025-03-23", "2025-03-30", "2025-03-31", "2025-04-01", "2025-06-06",
    "2025-06-07", "2025-06-08", "2025-08-14", "2025-09-06", "2025-11-09",
)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def require(df: DataFrame, *columns: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"column(s) {', '.join(absent)} not found")


def parsed_time(df: DataFrame, column: str) -> Column:
    """The time column as it is, or parsed where it was read as text."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column)


def time_columns(t: Column) -> dict[str, Column]:
    hour, weekday = F.hour(t), F.weekday(t)
    return {
        "hour": hour,
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(t),
        "month": F.month(t),
        "day_of_year": F.dayofyear(t),
        "year": F.year(t),
        "week_of_year": F.weekofyear(t),
        "is_weekend": flag(weekday.isin(*WEEKEND_DAYS)),
        "is_rush_hour": flag(hour.isin(*RUSH_HOURS)),
    }


def add_time_features(df: DataFrame, time: str = "datetime", zone: str | None = None) -> DataFrame:
    """Calendar columns; with ``zone`` they are those of local time."""
    require(df, time)
    t = parsed_time(df, time)
    if zone:
        t = F.from_utc_timestamp(t, zone)
    return df.withColumns(time_columns(t))


def cyclical_columns(
    columns: Iterable[str], values: dict[str, Column] | None = None
) -> dict[str, Column]:
    out = {}
    for name in columns:
        value = (values or {}).get(name, F.col(name))
        angle = value * (2 * math.pi) / CYCLE_PERIODS[name]
        out[f"{name}_sin"] = F.sin(angle)
        out[f"{name}_cos"] = F.cos(angle)
    return out


def add_cyclical(df: DataFrame, columns: Sequence[str] = CYCLE_DEFAULTS) -> DataFrame:
    """Sine and cosine of each calendar column present in the frame."""
    return df.withColumns(cyclical_columns([c for c in columns if c in df.columns]))


def season_columns(month: Column) -> dict[str, Column]:
    return {
        "is_monsoon": flag(month.isin(*MONSOON_MONTHS)),
        "is_winter": flag(month.isin(*WINTER_MONTHS)),
        "is_summer": flag(month.isin(*SUMMER_MONTHS)),
    }


def season_number(month: Column) -> Column:
    """0 winter, 1 spring, 2 summer, 3 autumn."""
    return F.floor(F.pmod(month, F.lit(12)) / 3).cast("int")


def holiday_flag(t: Column, holidays: Sequence[str] = HOLIDAYS) -> Column:
    days = [F.lit(dt.date.fromisoformat(d)) for d in holidays]
    return flag(F.to_date(t).isin(*days))


def holiday_table(spark, holidays: Sequence[str] = HOLIDAYS) -> DataFrame:
    """One row per distinct holiday, for semi and anti joins."""
    rows = [(dt.date.fromisoformat(d),) for d in holidays]
    return spark.createDataFrame(rows, "holiday date").dropDuplicates()


def add_holiday(df: DataFrame, time: str = "datetime") -> DataFrame:
    if time not in df.columns:
        return df
    return df.withColumn("is_holiday", holiday_flag(parsed_time(df, time)))


def on_holidays(df: DataFrame, time: str, keep: bool = True) -> DataFrame:
    """Rows that fall on a holiday (``keep``) or on no holiday."""
    days = F.broadcast(holiday_table(df.sparkSession))  # twenty fixed rows
    condition = F.to_date(F.col(time)) == F.col("holiday")
    return df.join(days, condition, "left_semi" if keep else "left_anti")
