"""From landed payloads to a registered model, on a small fixture."""

import datetime as dt
import json
import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from airloom.functions.calendar import add_time_features
from airloom.ml import models
from airloom.operators import windows
from airloom.plans import runs
from airloom.plans.transformers import (
    CyclicalTimeEncoder, FeatureEngineer, LagFeatureGenerator, RollingFeatureGenerator,
)
from airloom.sources import tables

START = dt.datetime(2024, 1, 1)
HOURS = 240


def payload(first, hours):
    times = [START + dt.timedelta(hours=first + i) for i in range(hours)]
    wave = [math.sin((first + i) / 3.8) + (first + i) % 7 for i in range(hours)]
    return json.dumps({"hourly": {
        "time": [t.isoformat() for t in times],
        "temperature_2m": [20 + 3 * w for w in wave],
        "relative_humidity_2m": [50 + w for w in wave],
        "wind_speed_10m": [5.0 + w for w in wave],
        "pressure_msl": [1013.0] * hours,
    }})


@pytest.fixture(scope="module")
def clean(spark):
    # The chunks share a day, which arrives twice.
    landed = spark.createDataFrame(
        [(k, payload(f, n)) for k in ("x", "y") for f, n in ((0, 132), (108, 132))],
        "series_key string, payload string")
    now = spark.createDataFrame([("x", 150.0, 60.0, 90.0, 40.0, 55.0)],
                                "series_key string, aqi double, pm25 double, pm10 double, no2 double, o3 double")
    rows, rejects = runs.observations(landed, now)
    assert rejects.count() == 0
    return rows.persist()


def test_observations(clean):
    assert clean.count() == 2 * HOURS and len(clean.columns) == 15
    row = clean.filter((F.col("series_key") == "x") & (F.col("datetime") == F.lit(START))).first()
    expected = 150 + (20 - 25) * 0.5 + 0 - 2.5 + 0 - 0
    assert abs(row.aqi - expected) < 0.051 and row.o3 is not None


def test_incremental_equals_whole(spark, clean, tmp_path):
    end = START + dt.timedelta(hours=HOURS - 1)
    whole = runs.backfill(clean, end, 1).select("series_key", "datetime", "aqi_lag_168h", "aqi_ema_24h", "rolling_mean_720h")
    path = str(tmp_path / "f")
    for _ in range(2):
        part = runs.incremental(clean, end, 24, path)
    assert part.count() == 2 * 25 and spark.read.parquet(path).count() == 2 * 25
    both = part.alias("p").join(whole.alias("w"), ["series_key", "datetime"])
    for c in ("aqi_lag_168h", "aqi_ema_24h", "rolling_mean_720h"):
        off = both.filter(F.abs(F.col(f"p.{c}") - F.col(f"w.{c}")) > 1e-6).count()
        assert off == 0, c


def test_incremental_average_looks_back_over_all_rows(spark, clean):
    hours, seen = 2_300, 50
    times = spark.range(hours).select(
        F.lit("x").alias("series_key"),
        (F.lit(START) + F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("datetime"),
        F.when(F.col("id") < seen, F.col("id") * 1.5).alias("aqi"),
    )
    rest = [F.lit(1.0).cast(t).alias(c) if t == "double" else F.lit(None).cast(t).alias(c)
            for c, t in clean.dtypes if c not in times.columns]
    rows = times.select("*", *rest)
    end = START + dt.timedelta(hours=hours - 1)
    names = ("aqi_ema_24h", "aqi_ema_168h")
    part = runs.incremental(rows, end, 2).select("datetime", *names)
    whole = runs.backfill(rows, end, 1).select("datetime", *names)
    both = part.alias("p").join(whole.alias("w"), "datetime").collect()
    assert len(both) == 3
    for row in both:
        assert row[1] is not None and row[1:3] == pytest.approx(row[3:5], rel=1e-12)


def test_a_historical_range_has_the_features_of_the_whole(spark, clean):
    start, end = START + dt.timedelta(days=6), START + dt.timedelta(days=7)
    names = ["aqi_lag_24h", "aqi_rolling_mean_72h", "aqi_ema_168h", "pm25_lag_168h"]
    whole = runs.backfill(clean, START + dt.timedelta(hours=HOURS), 1).select("series_key", "datetime", *names)
    want = {tuple(r)[:2]: tuple(r)[2:] for r in whole.collect()}
    got = runs.historical(clean, start, end).select("series_key", "datetime", *names).collect()
    assert len(got) == 2 * 25
    for r in got:
        for a, b in zip(tuple(r)[2:], want[r[0], r[1]]):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-9))
    alone = runs.historical(clean, start, end, context=False)
    assert alone.filter("aqi_lag_24h IS NULL").count() == 48


@pytest.mark.parametrize("cut", [1_000_000, 50])
def test_averages_go_on_from_a_carry(spark, cut):
    """Any split of a series gives the averages of the whole, also in pieces and from a missing start."""
    x = [None, None, 3.0, None, 5.0, 1.0, None, None, 8.0, *[float(i % 7) for i in range(150)], None, 4.0]
    data = [(s, START + dt.timedelta(hours=i), v if s == "a" else None if i < 100 else v) for s in "ab" for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "series_key string, datetime timestamp, aqi double")
    whole = {tuple(r)[:2]: r.aqi_ema_24h for r in windows.ema(df, "aqi", ["series_key"], ["datetime"], (24,)).collect()}
    for day in (1, 3, 6):
        at = F.lit(START + dt.timedelta(days=day))
        first, state, out = df.filter(F.col("datetime") < at), None, {}
        for part in (first, df.filter(F.col("datetime") >= at)):
            averaged = windows.ema(part, "aqi", ["series_key"], ["datetime"], (24,), rows_per_cut=cut, carry=state)
            out |= {tuple(r)[:2]: r.aqi_ema_24h for r in averaged.collect()}
            days = windows.day_states(averaged, "aqi", ["series_key"], "datetime", (24,), state)
            state = days.groupBy("series_key").agg(F.max_by("gap", "datetime").alias("gap"), F.max_by("mean_24", "datetime").alias("mean_24"))
        assert out.keys() == whole.keys()
        for k, v in whole.items():
            assert (out[k] is None) == (v is None) and (v is None or out[k] == pytest.approx(v, rel=1e-12))


def test_refresh_reads_only_the_days_it_looks_back_on(spark, clean, tmp_path):
    """Rows slipped into an old day are not seen by a refresh of new days; late rows reopen theirs."""
    paths = [str(tmp_path / p) for p in ("history", "states", "out")]

    def compute(rows):
        return windows.ema(windows.lags(rows, ["aqi"], ["series_key"], ["datetime"], (24,)), "aqi", ["series_key"], ["datetime"])

    rows = clean.select("series_key", "datetime", "aqi")
    at = START + dt.timedelta(days=4)
    late = F.col("datetime") == F.lit(START + dt.timedelta(hours=30))
    runs.refresh(spark, rows.filter((F.col("datetime") < F.lit(at)) & ~late), *paths, compute, lookback=24)
    slipped = rows.limit(1).withColumns({"datetime": F.lit(START + dt.timedelta(minutes=5)), "aqi": F.lit(1e9), "event_date": F.to_date(F.lit(START))})
    slipped.write.mode("append").partitionBy("event_date").parquet(paths[0])
    runs.refresh(spark, rows.filter(F.col("datetime") >= F.lit(at)), *paths, compute, lookback=24)
    runs.refresh(spark, rows.filter(late), *paths, compute, lookback=4)
    got = {tuple(r)[:2]: tuple(r)[2:] for r in spark.read.parquet(paths[2]).drop("event_date").select("series_key", "datetime", "aqi_lag_24h", "aqi_ema_24h", "aqi_ema_168h").collect()}
    want = compute(rows).select("series_key", "datetime", "aqi_lag_24h", "aqi_ema_24h", "aqi_ema_168h").collect()
    assert len(got) == len(want)
    for r in want:
        if r.datetime >= at:  # the third run looks back on four rows alone
            assert got[r[0], r[1]] == pytest.approx(tuple(r)[2:], rel=1e-9)
        assert got[r[0], r[1]][1:] == pytest.approx(tuple(r)[3:], rel=1e-9)


def test_training_registers(spark, clean, tmp_path):
    features = runs.historical(clean, START, START + dt.timedelta(hours=HOURS), str(tmp_path / "f"))
    stored = spark.read.parquet(str(tmp_path / "f"))
    assert stored.count() == features.count()
    chosen = {"Ridge": models.ridge, "LightGBM": None}
    out = runs.training(spark, stored, str(tmp_path / "r"), str(tmp_path / "m"), models=chosen, folds=2)
    assert out["best_model"] == "Ridge" and out["version"] == 1 and out["n_features"] == 100
    assert PipelineModel.load(str(tmp_path / "m" / "Ridge" / "version=1")) is not None
    assert tables.read_table(spark, str(tmp_path / "r")).count() == 1
    again = runs.training(spark, stored, str(tmp_path / "r"), str(tmp_path / "m"), models=chosen, folds=2)
    assert again["version"] == 2
    scored = runs.scoring(spark, stored, str(tmp_path / "r"), "Ridge", 1)
    assert scored.filter("prediction IS NULL").count() == 0 and scored.count() == stored.count()
    with pytest.raises(FileNotFoundError):
        runs.load_model(spark, str(tmp_path / "r"), "Ridge", 3)


def test_transformers_save_and_run(spark, clean, tmp_path):
    steps = Pipeline(stages=[
        CyclicalTimeEncoder(columns=["hour"]),
        LagFeatureGenerator(sizes=[1]),
        RollingFeatureGenerator(sizes=[1, 3]),
    ])
    timed = add_time_features(clean)
    steps.fit(timed).write().overwrite().save(str(tmp_path / "p"))
    out = PipelineModel.load(str(tmp_path / "p")).transform(timed)
    assert {"hour_sin", "aqi_lag_1h", "pm25_lag_1h", "aqi_rolling_mean_3h"} <= set(out.columns)
    assert out.count() == 2 * HOURS
    assert len(FeatureEngineer(feature_set="leak_free").fit_transform(clean).columns) < 149
