"""Binding of the given tables to the library, and one form for all results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.schemas import OBSERVATION_COLUMNS, SERIES

# Half-way cases differ in the last bit between engines; a nudge far above that
# noise and far below the shown digits sends both to the same side.
NUDGE = 1e-9
DIGITS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its zone-less times are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(x: Column, digits: int = DIGITS) -> Column:
    return F.round(x.cast("double") + NUDGE, digits) + 0.0


def R(sql: str, digits: int = DIGITS) -> str:
    """The same rounding in SQL."""
    return f"(round(({sql})::DOUBLE + {NUDGE!r}, {digits}) + 0.0)"


def present(df: DataFrame, digits: int = DIGITS, **per_column: int) -> DataFrame:
    """Wide integers, rounded doubles, times as text."""
    columns = []
    for field in df.schema.fields:
        x, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            x = rounded(x, per_column.get(field.name, digits))
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            x = x.cast("bigint")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            x = F.date_format(x, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DateType):
            x = F.date_format(x, "yyyy-MM-dd")
        columns.append(x.alias(field.name))
    return df.select(*columns)


def TS(sql: str) -> str:
    return f"strftime({sql}, '%Y-%m-%d %H:%M:%S')"


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as hourly observations per event type: one row per type and hour."""
    k = F.get_json_object("props", "$.k").cast("double")
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("event_type").alias(SERIES), F.date_trunc("hour", "ts").alias("datetime")
        )
        .agg(
            (F.avg("value") / 2).alias("temperature_2m"),
            F.avg(k).alias("relative_humidity_2m"),
            (F.min(k) / 10).alias("precipitation"),
            (F.min("value") / 2).alias("wind_speed_10m"),
            (F.max(k) * 3.6).alias("wind_direction_10m"),
            (F.max(k) / 5 + 1000).alias("pressure_msl"),
            F.max(k).alias("cloud_cover"),
            F.avg("value").alias("aqi"),
            F.min("value").alias("pm25"),
            F.max("value").alias("pm10"),
            F.min(k).alias("no2"),
            F.max(k).alias("o3"),
            F.lit("events").alias("source"),
        )
        .select(SERIES, *OBSERVATION_COLUMNS)
    )


HOURLY_SQL = """
SELECT event_type AS series_key, date_trunc('hour', ts) AS datetime,
       avg(value) / 2 AS temperature_2m, avg(k) AS relative_humidity_2m,
       min(k) / 10 AS precipitation, min(value) / 2 AS wind_speed_10m,
       max(k) * 3.6::DOUBLE AS wind_direction_10m, max(k) / 5 + 1000 AS pressure_msl,
       max(k) AS cloud_cover, avg(value) AS aqi, min(value) AS pm25, max(value) AS pm10,
       min(k) AS no2, max(k) AS o3, 'events' AS source
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
GROUP BY 1, 2
"""


def weather_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items read as observations of weather and pollutants."""
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        c("l_quantity").alias("temperature_2m"),
        (c("l_tax") * 1000).alias("relative_humidity_2m"),
        F.when(c("l_discount") > 0.05, 0.0).otherwise(c("l_discount")).alias("precipitation"),
        (c("l_discount") * 100).alias("wind_speed_10m"),
        F.when(c("l_quantity") > 45, F.lit(None)).otherwise(c("l_extendedprice") / 250)
        .alias("wind_direction_10m"),
        (c("l_quantity") + 990).alias("pressure_msl"),
        (c("l_tax") * 1000).alias("cloud_cover"),
        (c("l_extendedprice") / 10).alias("visibility"),
        c("l_quantity").alias("pm25"),
        F.when(c("l_quantity") > 45, F.lit(None)).otherwise(c("l_quantity") * 2 + 1).alias("pm10"),
        (c("l_discount") * 100).alias("no2"),
        (c("l_tax") * 100 + 1).alias("o3"),
        (c("l_extendedprice") / 200).alias("aqi"),
    )


WEATHER_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity AS temperature_2m,
       l_tax * 1000 AS relative_humidity_2m,
       CASE WHEN l_discount > 0.05::DOUBLE THEN 0.0 ELSE l_discount END AS precipitation,
       l_discount * 100 AS wind_speed_10m,
       CASE WHEN l_quantity > 45 THEN NULL ELSE l_extendedprice / 250 END AS wind_direction_10m,
       l_quantity + 990 AS pressure_msl, l_tax * 1000 AS cloud_cover,
       l_extendedprice / 10 AS visibility, l_quantity AS pm25,
       CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity * 2 + 1 END AS pm10,
       l_discount * 100 AS no2, l_tax * 100 + 1 AS o3, l_extendedprice / 200 AS aqi
FROM lineitem
"""
