"""The whole feature frame is the same however a series is cut."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.plans.features import feature_frame
from airloom.schemas import OBSERVATION, POLLUTANTS, WEATHER


@pytest.mark.parametrize("feature_set", ["reference", "leak_free"])
def test_cut_equals_plain(spark, feature_set):
    rng = np.random.default_rng(5)
    rows = []
    for key, n in (("long", 420), ("short", 40)):
        for i in range(n):
            aqi = None if rng.random() < 0.1 else float(rng.integers(0, 4000)) / 10
            others = [float(x) for x in rng.uniform(1, 100, len(WEATHER) + len(POLLUTANTS))]
            t = dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)
            rows.append((key, t, *others[: len(WEATHER)], aqi, *others[len(WEATHER):], "x"))
    df = spark.createDataFrame(rows, OBSERVATION).repartition(3)
    order = ["series_key", "datetime"]
    plain = feature_frame(df, feature_set=feature_set).toPandas().sort_values(order)
    cut = feature_frame(df, feature_set=feature_set, rows_per_cut=60).toPandas().sort_values(order)
    assert list(plain.columns) == list(cut.columns) and len(plain) == len(cut) == 460
    for c in plain.columns:
        if plain[c].dtype == object or c == "datetime":
            assert (plain[c].to_numpy() == cut[c].to_numpy()).all(), c
        else:
            np.testing.assert_allclose(
                plain[c].to_numpy(float), cut[c].to_numpy(float), rtol=1e-9, atol=1e-9, err_msg=c
            )


def test_newest_of_repeated_hours(spark):
    t = dt.datetime(2024, 1, 1)
    blank = [None] * len(WEATHER)
    rows = [("s", t, *blank, v, 1.0, 1.0, 1.0, 1.0, src) for v, src in ((10.0, "a"), (90.0, "b"))]
    df = spark.createDataFrame(rows, OBSERVATION)
    out = feature_frame(df, newest=["source"]).collect()
    assert len(out) == 1 and out[0].aqi == 90.0 and out[0].aqi_moderate == 1
    assert out[0].aqi_lag_1h is None
    with pytest.raises(ValueError):
        feature_frame(df, feature_set="other")
    with pytest.raises(ValueError):
        feature_frame(df.select("series_key", F.col("datetime").alias("t")), time="datetime")
