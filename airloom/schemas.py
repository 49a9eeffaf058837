"""Declared schemas, NaN clean-up, and validation into valid and reject rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = "series_key"
TIME = "datetime"
TARGET = "aqi"
WEATHER = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
    "wind_direction_10m", "pressure_msl", "cloud_cover",
)
POLLUTANTS = ("pm25", "pm10", "no2", "o3")
OBSERVATION_COLUMNS = (TIME, *WEATHER, TARGET, *POLLUTANTS, "source")


def _doubles(names) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


OBSERVATION = T.StructType(
    [
        T.StructField(SERIES, T.StringType(), False),
        T.StructField(TIME, T.TimestampType()),
        *_doubles(WEATHER),
        *_doubles((TARGET, *POLLUTANTS)),
        T.StructField("source", T.StringType()),
    ]
)

LOCATION = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("country", T.StringType()),
    ]
)

REGISTRY = T.StructType(
    [
        T.StructField("model_name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("registered_at", T.TimestampType()),
        T.StructField("description", T.StringType()),
        T.StructField("model_path", T.StringType()),
    ]
)

HOURS_AHEAD = (1, 168)  # fixed values: allowed forecast horizon


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers as NULL: NaN would sort above every threshold."""
    doubles = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns({c: F.nullif(F.col(c), F.lit(float("nan"))) for c in doubles})


def finite(x: Column) -> Column:
    """NULL for NaN and both infinities."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


def check_hours_ahead(hours: int) -> int:
    low, high = HOURS_AHEAD
    if not low <= hours <= high:
        raise ValueError(f"hours_ahead must lie in [{low}, {high}]")
    return hours


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows by named rules; rejects carry the names of the broken ones.

    A rule that is NULL for a row counts as broken.
    """
    checked = with_reasons(df, rules)
    good = F.size("reasons") == 0
    return checked.filter(good).drop("reasons"), checked.filter(~good)


def with_reasons(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    broken = [
        F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()
    ]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def observation_rules() -> dict[str, Column]:
    return {
        "datetime_required": F.col(TIME).isNotNull(),
        "aqi_required": F.col(TARGET).isNotNull(),
    }


def request_rules() -> dict[str, Column]:
    low, high = HOURS_AHEAD
    return {
        "hours_ahead_required": F.col("hours_ahead").isNotNull(),
        "hours_ahead_range": F.col("hours_ahead").isNull()
        | F.col("hours_ahead").between(low, high),
    }


def with_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Declared defaults for missing fields, adding absent columns."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
            for name, value in defaults.items()
        }
    )

