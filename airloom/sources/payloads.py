"""Provider payloads, landed as one JSON text per row, into typed rows.

Every reader takes the frame, the JSON column and the columns to keep beside
the parsed ones.  Unreadable times come out NULL and are left to validation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.schemas import OBSERVATION_COLUMNS, POLLUTANTS, WEATHER

# Payload schemas and the source name of each provider.
HOURLY_SCHEMA = "hourly struct<time array<string>, {}>".format(
    ", ".join(f"{c} array<double>" for c in WEATHER)
)
CURRENT_SCHEMA = "current struct<time string, {}>".format(
    ", ".join(f"{c} double" for c in WEATHER)
)
STATION_SCHEMA = (
    "status string, data struct<aqi double, time struct<s string>, dominentpol string, "
    "iaqi map<string,string>, forecast struct<daily string>>"
)
POLLUTION_SCHEMA = (
    "list array<struct<dt bigint, main struct<aqi int>, components struct<pm2_5 double, "
    "pm10 double, no2 double, o3 double, so2 double, co double>>>"
)
DETAIL_SCHEMA = (
    "current struct<last_updated string, temp_c double, humidity double, pressure_mb double, "
    "wind_kph double, wind_degree double, cloud double, vis_km double, "
    "air_quality map<string,double>>"
)
STATION_POLLUTANTS = ("pm25", "pm10", "no2", "o3", "so2", "co")


def _instant(text: Column, zone: str | None) -> Column:
    """A time given as text; without an offset of its own it is local to ``zone`` (None: the session's)."""
    time = F.try_to_timestamp(text)
    if zone is None:
        return time
    has_offset = text.rlike(r"(Z|[+-]\d{2}:?\d{2})$") & text.contains(":")
    return F.when(has_offset, time).otherwise(F.to_utc_timestamp(F.from_utc_timestamp(time, F.current_timezone()), zone))


def _parsed(df: DataFrame, payload: str, schema: str, keep: Sequence[str]) -> DataFrame:
    return df.select(*keep, F.from_json(payload, schema).alias("_p"))


def hourly_archive(
    df: DataFrame, payload: str, keep: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    """Parallel arrays to one row per hour; absent or short arrays pad with NULL.

    Times without an offset are local to ``zone``, as the payload was asked for.
    """
    fields = ("time", *WEATHER)
    zipped = F.arrays_zip(
        *[
            F.coalesce(F.col(f"_p.hourly.{c}"), F.array().cast(
                "array<string>" if c == "time" else "array<double>")).alias(c)
            for c in fields
        ]
    )
    rows = _parsed(df, payload, HOURLY_SCHEMA, keep).select(*keep, F.inline(zipped))
    rows = rows.toDF(*keep, *fields)
    return rows.filter("time IS NOT NULL").select(
        *keep,
        _instant(F.col("time"), zone).alias("datetime"),
        *WEATHER,
        F.lit("open-meteo").alias("source"),
    )


def current_weather(
    df: DataFrame, payload: str, keep: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    current = F.col("_p.current")
    return _parsed(df, payload, CURRENT_SCHEMA, keep).select(
        *keep,
        F.when(current["time"].isNull(), F.current_timestamp())
        .otherwise(_instant(current["time"], zone))
        .alias("datetime"),
        *[current[c].alias(c) for c in WEATHER],
        F.lit("open-meteo").alias("source"),
    )


def _accepted() -> Column:
    return F.coalesce(F.col("_p.status") == "ok", F.lit(False))


def station_status(df: DataFrame, payload: str) -> tuple[DataFrame, DataFrame]:
    """Accepted payloads (status ok) and the rest."""
    parsed = df.select("*", F.from_json(payload, STATION_SCHEMA).alias("_p"))
    return parsed.filter(_accepted()).drop("_p"), parsed.filter(~_accepted()).drop("_p")


def station_aqi(
    df: DataFrame, payload: str, keep: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    """Station payloads; a pollutant is a number or an object with field ``v``.

    The text is parsed once, and each pollutant once.
    """
    data = F.col("_p.data")

    def amount(v: Column) -> Column:
        return F.coalesce(F.get_json_object(v, "$.v"), v).try_cast("double")

    rows = _parsed(df, payload, STATION_SCHEMA, keep).filter(_accepted()).select(
        *keep, data.alias("_data"), F.transform_values(data["iaqi"], lambda _, v: amount(v)).alias("pollutants")
    )
    data = F.col("_data")
    return rows.select(
        *keep,
        F.when(data["time"]["s"].isNull(), F.current_timestamp())
        .otherwise(_instant(data["time"]["s"], zone))
        .alias("datetime"),
        data["aqi"].alias("aqi"),
        *[F.try_element_at("pollutants", F.lit(p)).alias(p) for p in STATION_POLLUTANTS],
        data["dominentpol"].alias("main_pollutant"),
        "pollutants",
        data["forecast"]["daily"].alias("forecast"),
        F.lit("aqicn").alias("source"),
    )


def _pollution(item: Column, names: Sequence[str]) -> list[Column]:
    parts = item["components"]
    return [
        F.timestamp_seconds(item["dt"]).alias("datetime"),
        item["main"]["aqi"].cast("double").alias("aqi"),
        *[parts["pm2_5" if n == "pm25" else n].alias(n) for n in names],
        F.lit("openweathermap").alias("source"),
    ]


def pollution_current(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """First element of the list; an empty list gives no row."""
    rows = _parsed(df, payload, POLLUTION_SCHEMA, keep).select(
        *keep, F.get("_p.list", F.lit(0)).alias("item")
    )
    rows = rows.filter("item IS NOT NULL")
    return rows.select(*keep, *_pollution(F.col("item"), STATION_POLLUTANTS))


def pollution_forecast(df: DataFrame, payload: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per list element."""
    rows = _parsed(df, payload, POLLUTION_SCHEMA, keep).select(
        *keep, F.explode("_p.list").alias("item")
    )
    return rows.select(*keep, *_pollution(F.col("item"), POLLUTANTS))


def current_detail(
    df: DataFrame, payload: str, keep: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    """Detail payload; a visibility of nothing or zero counts as 10 km."""
    c = F.col("_p.current")
    km = F.when(c["vis_km"].isNull() | (c["vis_km"] == 0), 10.0).otherwise(c["vis_km"])
    return _parsed(df, payload, DETAIL_SCHEMA, keep).select(
        *keep,
        _instant(c["last_updated"], zone).alias("datetime"),
        c["temp_c"].alias("temperature_2m"),
        c["humidity"].alias("relative_humidity_2m"),
        c["pressure_mb"].alias("pressure_msl"),
        c["wind_kph"].alias("wind_speed_10m"),
        c["wind_degree"].alias("wind_direction_10m"),
        c["cloud"].alias("cloud_cover"),
        (km * 1000).alias("visibility"),
        c["air_quality"].alias("air_quality"),
        F.lit("weatherapi").alias("source"),
    )


def _path(df: DataFrame, *paths: str) -> Column:
    """First of the given column paths that the schema has, else NULL."""
    found = []
    for path in paths:
        fields, present = df.schema, True
        for step in path.split("."):
            names = fields.names if hasattr(fields, "names") else []
            if step not in names:
                present = False
                break
            fields = fields[step].dataType
        if present and not hasattr(fields, "names"):
            found.append(F.col(path))
    return F.coalesce(*found) if found else F.lit(None)


def flatten_observations(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat or nested records to the 14 observation columns.

    Weather is read from the top level, else from ``weather``; the target from
    ``aqi.aqi``, ``aqi.aqi_value`` or a scalar ``aqi``.
    """
    time = _path(df, "datetime")
    if dict(df.dtypes).get("datetime") == "string":
        time = F.try_to_timestamp(time)
    out = {"datetime": time.cast("timestamp")}
    for name in WEATHER:
        out[name] = _path(df, name, f"weather.{name}").cast("double")
    out["aqi"] = _path(df, "aqi.aqi", "aqi.aqi_value", "aqi", "aqi_value").cast("double")
    for name in POLLUTANTS:
        out[name] = _path(df, f"aqi.{name}", name).cast("double")
    out["source"] = F.coalesce(_path(df, "source", "weather.source"), F.lit("unknown"))
    return df.select(*keep, *[out[c].alias(c) for c in OBSERVATION_COLUMNS])
