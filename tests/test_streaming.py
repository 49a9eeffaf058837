"""Streams equal batches on the same rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airloom.operators import windows
from airloom.plans.carry import Carry
from airloom.streaming import features, ingest

SCHEMA = "series_key string, datetime timestamp, aqi double"


def rows(n=120, missing=()):
    start = dt.datetime(2024, 1, 1)
    return [
        (k, start + dt.timedelta(hours=i), None if i in missing else float((i * 37 + len(k)) % 101))
        for i in range(n)
        for k in ("a", "bb")
    ]


def land(spark, path, batches):
    for batch in batches:
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_dedup_over_files(spark, tmp_path):
    data = rows(40)
    land(spark, str(tmp_path / "in"), [data[:50], data[30:], data[-10:]])
    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    once = ingest.dedup(stream, ["series_key", "datetime"], "datetime", "7 days")
    finish(ingest.write_stream(once, str(tmp_path / "out"), str(tmp_path / "c")))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 80 == out.distinct().count()


@pytest.mark.parametrize("files", [1, 4])
def test_stateful_ema(spark, tmp_path, files):
    data = rows(96, missing={0, 30, 31, 50})
    size = len(data) // files
    land(spark, str(tmp_path / "in"), [data[i : i + size] for i in range(0, len(data), size)])
    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    out = features.stateful_ema(stream, "series_key", "datetime", "aqi")
    finish(ingest.write_stream(out, str(tmp_path / "out"), str(tmp_path / "c")))
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values(["series_key", "datetime"])
    pdf = pd.DataFrame(data, columns=["k", "t", "v"]).sort_values(["k", "t"])
    expected = pdf.groupby("k")["v"].transform(lambda s: s.ewm(span=24, adjust=False).mean())
    np.testing.assert_allclose(got["aqi_ema_24h"].astype(float), expected.astype(float), rtol=1e-12)
    assert all(len(r) <= 3 for r in got["recent"])


def test_stateful_ema_with_late_files(spark, tmp_path):
    """Late rows take their place in time; what is older than the watermark leaves the state."""
    data = rows(24 * 12, missing={0, 1, 30, 31, 50, 200})
    when = lambda r: (r[1] - dt.datetime(2024, 1, 1)).total_seconds() / 3600
    late = [r for r in data if int(when(r)) % 24 in (20, 21)]
    days = [[r for r in data if r not in late and d * 24 <= when(r) < d * 24 + 24] for d in range(12)]
    files = []
    for d in range(12):  # the late rows of a day come after the next day's
        files.append(days[d])
        if d:
            files.append([r for r in late if (d - 1) * 24 <= when(r) < d * 24])
    files.append([r for r in late if when(r) >= 264])
    land(spark, str(tmp_path / "in"), files)
    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    out = features.stateful_ema(stream, "series_key", "datetime", "aqi", delay="2 days")
    query = features.upsert_stream(out, str(tmp_path / "out"), str(tmp_path / "c"), ["series_key"], "datetime")
    finish(query)
    got = spark.read.parquet(str(tmp_path / "out")).toPandas().sort_values(["series_key", "datetime"])
    pdf = pd.DataFrame(data, columns=["k", "t", "v"]).sort_values(["k", "t"])
    expected = pdf.groupby("k")["v"].transform(lambda s: s.ewm(span=24, adjust=False).mean())
    np.testing.assert_allclose(got["aqi_ema_24h"].astype(float), expected.astype(float), rtol=1e-12)
    assert all(len(r) <= 3 for r in got["recent"])
    assert ingest.late_rows(spark, query).agg(F.sum("dropped")).first()[0] == 0
    kept = spark.read.format("statestore").load(str(tmp_path / "c")).select(F.size("value.groupState.times")).collect()
    assert kept and all(r[0] <= 3 * 24 + 2 for r in kept)


def test_averages_after_a_state():
    rng = np.random.default_rng(3)
    x = np.where(rng.random(700) < 0.3, np.nan, rng.normal(0, 5, 700))
    x[:5] = np.nan
    whole = pd.Series(x).ewm(span=24, adjust=False).mean().to_numpy()
    np.testing.assert_allclose(features.averages_after(None, 0, x, 0.08)[0], whole, rtol=1e-9, atol=1e-11)
    for cut in (0, 3, 5, 6, 300):
        means, gaps = features.averages_after(None, 0, x[:cut], 0.08)
        mean, gap = (None, 0) if not cut or np.isnan(means[-1]) else (means[-1], int(gaps[-1]))
        np.testing.assert_allclose(features.averages_after(mean, gap, x[cut:], 0.08)[0], whole[cut:], rtol=1e-9, atol=1e-11)


def test_windows_leave_the_state(spark, tmp_path):
    """In update mode the state stays as small as the delay allows, and late rows are counted."""
    data = rows(24 * 8)
    by_day = [data[d * 48 : d * 48 + 48] for d in range(8)]
    late = by_day[0][:6]
    land(spark, str(tmp_path / "in"), [by_day[0][6:], *by_day[1:], late])
    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    means = ingest.window_means(stream, ["series_key"], "datetime", "aqi")
    query = ingest.keyed_stream(means, str(tmp_path / "out"), str(tmp_path / "c"))
    finish(query)
    kept = ingest.newest_versions(spark, str(tmp_path / "out"), means.schema, ["series_key", "window_start"])
    on_time = [r for r in data if r not in late]
    assert kept.count() == len(on_time) == kept.select("series_key", "window_start").distinct().count()
    seen = ingest.late_rows(spark, query)
    assert seen.agg(F.sum("dropped")).first()[0] == len(late)
    assert seen.agg(F.max("state_rows")).first()[0] <= 2 * (24 + 24 + 3)


def test_incremental_features_with_late_rows(spark, tmp_path):
    data = rows(60)
    late = data[20:24]
    first = [r for r in data[:80] if r not in late]
    land(spark, str(tmp_path / "in"), [first, data[80:], late, late])
    paths = [str(tmp_path / p) for p in ("history", "out", "c")]

    def compute(df):
        return windows.lags(df, ["aqi"], ["series_key"], ["datetime"], (1, 24))

    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    finish(features.incremental_features(
        stream, *paths, ["series_key"], "datetime", compute, lookback=24))
    got = spark.read.parquet(paths[1]).toPandas().sort_values(["series_key", "datetime"])
    pdf = pd.DataFrame(data, columns=["k", "t", "v"]).sort_values(["k", "t"])
    assert len(got) == len(pdf)
    for k in (1, 24):
        np.testing.assert_allclose(
            got[f"aqi_lag_{k}h"].astype(float), pdf.groupby("k")["v"].shift(k))


@pytest.mark.parametrize("settings", [{"unbounded": True}, {"carry": True}, {"averages": True, "lookback_days": 1}])
def test_incremental_averages_look_back_over_all_rows(spark, tmp_path, settings):
    """Long gaps: the average stands on rows far before the look-back."""
    data = [r for r in rows(400, missing=range(40, 300)) if not 300 <= (r[1] - dt.datetime(2024, 1, 1)).total_seconds() / 3600 < 350]
    land(spark, str(tmp_path / "in"), [data[:400], data[400:660], data[660:]])
    paths = [str(tmp_path / p) for p in ("history", "out", "c")]

    def average(df):
        return windows.ema(df, "aqi", ["series_key"], ["datetime"], (24,))

    def compute(df):
        return windows.lags(average(df), ["aqi"], ["series_key"], ["datetime"], (24,))

    if "averages" in settings:
        settings = settings | {"averages": lambda df: average(df.select("series_key", "datetime", "aqi")).drop("aqi")}
    if "carry" in settings:
        settings = {"carry": Carry(str(tmp_path / "states"), ["series_key"], "datetime", "aqi", (24,))}
    stream = ingest.table_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1)
    finish(features.incremental_features(
        stream, *paths, ["series_key"], "datetime", compute, lookback=24, **settings))
    order = ["series_key", "datetime"]
    got = spark.read.parquet(paths[1]).toPandas().sort_values(order)
    whole = compute(spark.createDataFrame(data, SCHEMA)).toPandas().sort_values(order)
    for c in ("aqi_ema_24h", "aqi_lag_24h"):
        np.testing.assert_allclose(got[c].astype(float), whole[c].astype(float), rtol=1e-9)


def test_window_means_in_batch_and_alerts(spark):
    from airloom.functions import bands

    df = spark.createDataFrame(rows(30), SCHEMA)
    means = ingest.window_means(df, ["series_key"], "datetime", "aqi", "24 hours", "1 hour")
    assert means.filter("n = 24").count() == 14
    alerts = ingest.alert_stream(df, "aqi", bands.alert(F.col("aqi"), {**bands.THRESHOLDS, "hazardous": 90}))
    assert alerts.count() == df.filter("aqi > 90").count()
