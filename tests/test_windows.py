"""Windows against pandas, plain and cut into small pieces."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from airloom.operators import windows as W
from airloom.operators.cuts import arrange

SCHEMA = T.StructType(
    [
        T.StructField("k", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("v", T.DoubleType()),
    ]
)
KEYS, ORDER = ["k"], ["t"]


def make(lengths, missing=0.15, seed=7):
    rng = np.random.default_rng(seed)
    frames = []
    for i, n in enumerate(lengths):
        v = np.round(rng.uniform(0, 500, n), 2)
        v[rng.random(n) < missing] = np.nan
        t = np.sort(rng.choice(10 * n + 10, n, replace=False))
        frames.append(pd.DataFrame({"k": f"s{i}", "t": t, "v": v}))
    return pd.concat(frames, ignore_index=True)


def to_spark(spark, pdf):
    rows = [
        (r.k, int(r.t), None if np.isnan(r.v) else float(r.v)) for r in pdf.itertuples()
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def collect(df):
    return df.toPandas().sort_values(["k", "t"]).reset_index(drop=True)


# The long series holds well over a third of all rows.
HOT = make([900, 60, 25, 1])


@pytest.mark.parametrize("rows_per_cut", [10_000, 60])
def test_rolling_matches_pandas(spark, rows_per_cut):
    sizes = (1, 3, 6, 12, 24, 48, 72, 120, 168)
    out = collect(
        W.rolling(to_spark(spark, HOT), "v", KEYS, ORDER, sizes, rows_per_cut=rows_per_cut)
    )
    assert len(out) == len(HOT)
    for k in sizes:
        rolled = HOT.groupby("k")["v"].rolling(k, min_periods=1)
        for stat in ("mean", "std", "min", "max"):
            expected = getattr(rolled, stat)().to_numpy()
            np.testing.assert_allclose(
                out[f"v_rolling_{stat}_{k}h"].to_numpy(float), expected, atol=1e-8
            )


@pytest.mark.parametrize("rows_per_cut", [10_000, 50])
def test_long_rolling_lags_and_changes(spark, rows_per_cut):
    sdf = to_spark(spark, HOT)
    grouped = HOT.groupby("k")["v"]
    out = collect(W.long_rolling(sdf, "v", KEYS, ORDER, (72, 720), rows_per_cut=rows_per_cut))
    for k in (72, 720):
        expected = grouped.rolling(k, min_periods=1).mean().to_numpy()
        np.testing.assert_allclose(out[f"rolling_mean_{k}h"], expected, atol=1e-8)
    out = collect(W.lags(sdf, ["v"], KEYS, ORDER, rows_per_cut=rows_per_cut))
    for k in W.LAGS:
        np.testing.assert_allclose(out[f"v_lag_{k}h"], grouped.shift(k).to_numpy())
    out = collect(W.change_rate(sdf, "v", KEYS, ORDER, rows_per_cut=rows_per_cut))
    np.testing.assert_allclose(out["v_change_24h"], grouped.diff(24).to_numpy())
    np.testing.assert_allclose(out["v_change_1h"], grouped.diff(1).to_numpy())


@pytest.mark.parametrize("rows_per_cut", [10_000, 41])
def test_ema_matches_pandas(spark, rows_per_cut):
    out = collect(
        W.ema(to_spark(spark, HOT), "v", KEYS, ORDER, (3, 24, 168), rows_per_cut=rows_per_cut)
    )
    for span in (3, 24, 168):
        expected = (
            HOT.groupby("k")["v"]
            .transform(lambda s: s.ewm(span=span, adjust=False).mean())
            .to_numpy()
        )
        np.testing.assert_allclose(
            out[f"v_ema_{span}h"].to_numpy(float), expected, rtol=1e-10, atol=1e-10
        )


def test_ema_hand_computed(spark):
    pdf = pd.DataFrame({"k": "a", "t": range(5), "v": [np.nan, 1, np.nan, 3, 4]})
    out = collect(W.ema(to_spark(spark, pdf), "v", KEYS, ORDER, (3,)))
    np.testing.assert_allclose(
        out["v_ema_3h"].to_numpy(float), [np.nan, 1, 1, 7 / 3, 19 / 6], atol=1e-12
    )


@pytest.mark.parametrize("rows_per_cut", [10_000, 700])
def test_ema_of_long_gappy_series_of_mixed_magnitude(spark, rows_per_cut):
    rng = np.random.default_rng(5)
    v = rng.normal(size=6_000)
    v[0], v[1:3_000] = 1e20, 0.0
    gappy = np.where(rng.random(6_000) < 0.4, np.nan, v)
    gappy[1_000:4_500] = np.nan
    pdf = pd.concat([
        pd.DataFrame({"k": k, "t": range(6_000), "v": x}) for k, x in (("a", v), ("b", gappy))
    ])
    out = collect(W.ema(to_spark(spark, pdf), "v", KEYS, ORDER, (24, 168), rows_per_cut=rows_per_cut))
    for span in (24, 168):
        expected = pdf.groupby("k")["v"].transform(
            lambda s, span=span: s.ewm(span=span, adjust=False).mean()
        )
        np.testing.assert_allclose(
            out[f"v_ema_{span}h"].to_numpy(float), expected.to_numpy(), rtol=1e-9, atol=1e-9
        )


def test_ema_blocks_of_blocks(spark):
    arranged = W.arrange(to_spark(spark, HOT), KEYS, ORDER, rows_per_cut=9).position("_pos")
    out = collect(W.add_ema(arranged, "v", (24,), block=8).rows)
    expected = HOT.groupby("k")["v"].transform(lambda s: s.ewm(span=24, adjust=False).mean())
    np.testing.assert_allclose(
        out["v_ema_24h"].to_numpy(float), expected.to_numpy(), rtol=1e-10, atol=1e-10
    )


@pytest.mark.parametrize("rows_per_cut", [10_000, 9])
def test_trend_and_position(spark, rows_per_cut):
    pdf = make([400, 50, 10], missing=0.0)
    sdf = to_spark(spark, pdf)
    out = collect(W.trend(sdf, "v", KEYS, ORDER, rows_per_cut=rows_per_cut))
    weights = np.r_[0.5, np.ones(23), 0.5] / 24
    for key, part in pdf.groupby("k"):
        v = part["v"].to_numpy()
        expected = np.full(len(v), np.nan)
        for i in range(12, len(v) - 12):
            expected[i] = v[i - 12 : i + 13] @ weights
        np.testing.assert_allclose(
            out[out["k"] == key]["trend"].to_numpy(float), expected, atol=1e-9
        )
    out = collect(W.with_position(sdf, KEYS, ORDER, rows_per_cut=rows_per_cut))
    assert (out["position"] == pdf.groupby("k").cumcount()).all()
    whole = W.with_position(sdf, [], ["k", "t"], rows_per_cut=rows_per_cut).toPandas()
    whole = whole.sort_values(["k", "t"])
    assert (whole["position"].to_numpy() == np.arange(len(pdf))).all()


def test_long_series_is_cut(spark):
    arranged = arrange(to_spark(spark, HOT), KEYS, ORDER, rows_per_cut=100)
    sizes = arranged.rows.groupBy("_cut").count().toPandas()["count"]
    assert arranged.cuts == 10 and sizes.max() < 300


@pytest.mark.parametrize("rows_per_cut", [10_000, 23])
def test_last_known(spark, rows_per_cut):
    pdf = make([300, 20], missing=0.9)
    arranged = arrange(to_spark(spark, pdf), KEYS, ORDER, rows_per_cut)
    out = collect(arranged.last_known("v", "f").rows)
    np.testing.assert_allclose(
        out["f"].to_numpy(float), pdf.groupby("k")["v"].ffill().to_numpy()
    )


def test_latest_and_newest(spark):
    sdf = to_spark(spark, HOT)
    last = W.latest(sdf, KEYS, ORDER).toPandas().set_index("k")["t"]
    assert (last == HOT.groupby("k")["t"].max()).all()
    newest = W.newest_rows(sdf, KEYS, ORDER, 20).groupBy("k").count().toPandas()
    assert dict(newest.values) == {"s0": 20, "s1": 20, "s2": 20, "s3": 1}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    lengths=st.lists(st.integers(1, 60), min_size=1, max_size=4),
    rows_per_cut=st.integers(1, 25),
    seed=st.integers(0, 99),
)
def test_any_cut_gives_the_plain_lags(spark, lengths, rows_per_cut, seed):
    pdf = make(lengths, seed=seed)
    out = collect(
        W.lags(to_spark(spark, pdf), ["v"], KEYS, ORDER, (1, 7, 30), rows_per_cut=rows_per_cut)
    )
    for k in (1, 7, 30):
        np.testing.assert_allclose(
            out[f"v_lag_{k}h"].to_numpy(float), pdf.groupby("k")["v"].shift(k).to_numpy()
        )


def test_rolling_of_sizes_without_divisors(spark):
    sizes = (13, 97, 331)
    out = collect(W.rolling(to_spark(spark, HOT), "v", KEYS, ORDER, sizes))
    for k in sizes:
        rolled = HOT.groupby("k")["v"].rolling(k, min_periods=1)
        for stat in ("mean", "std", "min", "max"):
            np.testing.assert_allclose(
                out[f"v_rolling_{stat}_{k}h"].astype(float).to_numpy(), getattr(rolled, stat)().to_numpy(), rtol=1e-9)


def test_composition_of_frames():
    built = W.composition([*W.ROLLING_WINDOWS, *W.LONG_WINDOWS])
    assert all(len(set(parts)) == 1 for parts in built.values())
    for sizes in ([*W.ROLLING_WINDOWS, *W.LONG_WINDOWS], [997], [2 * 1009, 31, 5003]):
        built = W.composition(sizes)
        assert set(sizes) <= {1, *built}
        assert all(sum(parts) == size and len(parts) <= W.MAX_PARTS for size, parts in built.items())
        assert len(built) < 12 * len(sizes)
    assert W.composition([168]) == {8: (1,) * 8, 56: (8,) * 7, 168: (56,) * 3}
    assert W.composition([13]) == {6: (1,) * 6, 13: (1,) * 7 + (6,)}


def test_ties_need_no_luck(spark):
    """A third of all rows at one time of one series, told apart by the tiebreak."""
    pdf = pd.DataFrame({"k": "a", "t": np.r_[np.zeros(100), np.arange(200)].astype(int)})
    pdf["id"], pdf["v"] = range(300), np.arange(300.0)
    pdf = pdf.sort_values(["t", "id"])
    df = spark.createDataFrame(pdf).repartition(5)
    out = W.lags(df, ["v"], ["k"], ["t", "id"], (1, 30), rows_per_cut=20).toPandas()
    out = out.sort_values(["t", "id"])
    np.testing.assert_allclose(out["v_lag_30h"], pdf["v"].shift(30))
