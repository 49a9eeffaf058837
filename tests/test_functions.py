"""Hand-computed cases of the row-wise functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from airloom import schemas
from airloom.functions import atmosphere, bands, calendar


def column(spark, values, kind="double", name="v"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


def test_category_edges(spark):
    df = bands.add_category_flags(
        column(spark, [50.0, 50.1, 100.0, 150.0, 200.0, 300.0, 300.1, None], name="aqi")
    )
    names = list(bands.CATEGORY_EDGES)
    found = [[n for n in names if r[n] == 1] for r in df.collect()]
    expected = ["good", "moderate", "moderate", "unhealthy_sensitive", "unhealthy",
                "very_unhealthy", "hazardous"]
    assert found == [[f"aqi_{e}"] for e in expected] + [[]]


def test_default_alert_ladder(spark):
    df = column(spark, [100.0, 101.0, 150.0, 151.0, 301.0, None])
    rows = df.select(bands.alert(F.col("v")).alias("a")).collect()
    levels = [r.a and r.a.level for r in rows]
    assert levels == ["good", "moderate", "moderate", "hazardous", "hazardous", None]
    assert rows[0].a.message == "✅ GOOD AQI: 100.0 - Air quality is satisfactory."
    assert rows[3].a.type == "error"


def test_raised_thresholds(spark):
    stored = bands.threshold_table(spark, {**bands.THRESHOLDS, "hazardous": 400})
    limits = bands.read_thresholds(stored)
    df = column(spark, [120.0, 160.0, 250.0, 350.0, 401.0])
    levels = [r[0] for r in df.select(bands.alert(F.col("v"), limits)["level"]).collect()]
    assert levels == ["moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy", "hazardous"]
    status = [r[0] for r in df.select(bands.status(F.col("v"), limits)).collect()]
    assert status[1] == "UNHEALTHY FOR SENSITIVE GROUPS"
    advice = [r[0] for r in df.select(bands.advisory(F.col("v"))).collect()]
    assert advice == ["moderate", "unhealthy_sensitive", "unhealthy", "unhealthy", "unhealthy"]


def test_texts(spark):
    row = column(spark, ["unhealthy_sensitive"], "string").select(
        bands.level_title(F.col("v")).alias("t"),
        bands.shortened(F.lit("x" * 100)).alias("s"),
        bands.weekday_text(F.lit(dt.datetime(2024, 1, 1))).alias("d"),
    ).first()
    assert row.t == "Unhealthy Sensitive" and row.s == "x" * 80 + "..."
    assert row.d == "Monday, Jan 01"


def test_calendar(spark):
    rows = [(dt.datetime(2024, 1, 1, 7),), (dt.datetime(2024, 12, 30),), (dt.datetime(2024, 12, 31),),
            (dt.datetime(2024, 3, 23, 5),), (None,)]
    df = spark.createDataFrame(rows, "datetime timestamp")
    out = calendar.add_holiday(calendar.add_cyclical(calendar.add_time_features(df))).collect()
    assert (out[0].day_of_week, out[0].is_rush_hour, out[0].is_weekend) == (0, 1, 0)
    assert out[1].week_of_year == 1 and out[2].day_of_year == 366
    assert out[3].is_holiday == 1 and out[3].is_weekend == 1
    assert math.isclose(out[0].hour_sin, math.sin(2 * math.pi * 7 / 24))
    assert out[4].hour is None and out[4].is_weekend == 0 and out[4].is_rush_hour == 0
    with pytest.raises(ValueError):
        calendar.add_time_features(df, "absent")


def test_text_times_are_parsed(spark):
    df = spark.createDataFrame([("2024-01-06T10:00",), ("never",)], "datetime string")
    out = calendar.add_time_features(df).collect()
    assert out[0].hour == 10 and out[0].is_weekend == 1 and out[1].hour is None


def test_wind_band_and_interactions(spark):
    df = column(spark, [179.9, 180.0, 270.0, 270.1, None], name="wind_direction_10m")
    flags = [r.wind_from_sea for r in atmosphere.add_weather_interactions(df).collect()]
    assert flags == [0, 1, 1, 0, 0]
    df = spark.createDataFrame([(5000.0, -1.0)], "visibility double, relative_humidity_2m double")
    assert atmosphere.add_weather_interactions(df).first().visibility_humidity_interaction is None


def test_composite_without_o3(spark):
    df = spark.createDataFrame([(10.0, 20.0, 30.0)], "pm25 double, pm10 double, no2 double")
    index = atmosphere.add_composite_index(df).first().pollution_index
    assert math.isclose(index, 16 / 0.9)
    assert "pollution_index" not in atmosphere.add_composite_index(column(spark, [1.0])).columns


def test_estimate(spark):
    names = list(atmosphere.ESTIMATE_INPUTS)
    schema = ", ".join(f"{n} double" for n in names)
    df = spark.createDataFrame([(25.0, 50.0, 10.0, 1013.0, 0.0), (None,) * 5, (-900.0, 50.0, 10.0, 1013.0, 0.0)], schema)
    out = df.select(*[x.alias(k) for k, x in atmosphere.estimate_columns(F.lit(120.0)).items()]).collect()
    assert out[0].aqi == 115.0 and out[0].pm25 == 43.1 and out[0].main_pollutant == "pm25"
    assert out[1].aqi == 115.0 and out[2].aqi == 30.0 and out[2].main_pollutant == "o3"


def test_nan_is_missing_and_validation(spark):
    df = column(spark, [float("nan"), 1.0, None], name="aqi").withColumn(
        "datetime", F.lit(dt.datetime(2024, 1, 1))
    )
    clean = schemas.nan_to_null(df)
    assert [r.aqi for r in clean.collect()] == [None, 1.0, None]
    valid, rejects = schemas.validate(clean, schemas.observation_rules())
    assert valid.count() == 1
    assert {tuple(r.reasons) for r in rejects.collect()} == {("aqi_required",)}
    assert schemas.check_hours_ahead(168) == 168
    with pytest.raises(ValueError):
        schemas.check_hours_ahead(169)


def test_finite(spark):
    df = column(spark, [float("inf"), float("-inf"), float("nan"), 2.0, None])
    assert [r[0] for r in df.select(schemas.finite(F.col("v"))).collect()] == [None, None, None, 2.0, None]
