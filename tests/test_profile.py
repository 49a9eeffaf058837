"""Profiling against numpy, pandas and hand-computed values."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airloom.operators import decompose, profile
from airloom.operators.quantiles import medians, quantiles

RNG = np.random.default_rng(3)


def frame(spark, **columns):
    names = list(columns)
    rows = [tuple(None if x is None or x != x else float(x) for x in r) for r in zip(*columns.values())]
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


PROBABILITIES = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("direct_rows, accuracy", [(10**6, 10000), (300, 20), (0, 8)])
def test_quantiles(spark, direct_rows, accuracy):
    columns = {
        "spread": np.r_[RNG.normal(0, 1, 1990), [1e12, -1e15] * 5],
        # A third of all rows share one value, the rest lie in a sliver.
        "copies": np.r_[np.full(700, 3.25), 5 + RNG.random(1300) * 1e-9],
        "gappy": np.where(RNG.random(2000) < 0.5, np.nan, RNG.integers(0, 9, 2000)),
        "constant": np.full(2000, 7.5),
        "empty": np.full(2000, np.nan),
    }
    df = frame(spark, **columns).repartition(3)
    found = quantiles(df, list(columns), PROBABILITIES, direct_rows, accuracy)
    for name, x in columns.items():
        x = x[~np.isnan(x)]
        if not len(x):
            assert found[name] == [None] * len(PROBABILITIES)
            continue
        np.testing.assert_allclose(found[name], np.quantile(x, PROBABILITIES), rtol=1e-12)
    assert medians(df, ["empty", "constant"]) == {"empty": None, "constant": 7.5}


def test_quantiles_of_infinities_agree_on_both_paths(spark):
    """Before, the path for many rows never ended on these."""
    limits = {"direct_rows": 100, "accuracy": 25}
    wide = np.r_[RNG.normal(0, 1, 900), RNG.normal(0, 1, 300) * 1e300, RNG.normal(0, 1, 300) * 1e-310]
    columns = {
        "infinite": np.r_[wide, np.full(300, -np.inf), np.full(200, np.inf)],
        "nan": np.r_[wide, np.full(400, np.nan), np.full(100, np.inf)],
        "none_finite": np.r_[np.full(1000, -np.inf), np.full(1000, np.nan)],
    }
    rows = [tuple(map(float, r)) for r in zip(*columns.values())]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in columns)).repartition(3)
    asked = [*PROBABILITIES, 0.1499, 0.15, 0.75, 0.8003, 0.95]
    direct = quantiles(df, list(columns), asked)
    for name, found in quantiles(df, list(columns), asked, **limits).items():
        np.testing.assert_array_equal(found, direct[name])
    assert direct["infinite"][0] == -np.inf and np.isnan(direct["nan"][5])


def test_quantiles_of_more_rows_than_are_held(spark):
    """Beyond the limit with the settings as they are, infinities and NaN included."""
    n = 2_000_001
    x = (F.col("id") * 7919 % n).cast("double")
    x = F.when(F.col("id") == 3, F.lit(float("inf"))).when(F.col("id") == 4, F.lit(float("-inf"))).when(F.col("id") == 5, F.lit(float("nan"))).otherwise(x)
    df = spark.range(n).select(x.alias("x"), F.lit(1.5).alias("same"), (F.col("id") % 3).alias("few"))
    wanted = np.arange(n, dtype=float)
    for i in (3, 4, 5):
        wanted[i * 7919 % n] = {3: np.inf, 4: -np.inf, 5: np.nan}[i]
    wanted = np.sort(wanted)
    found = quantiles(df, ["x", "same", "few"], [0.0, 0.25, 0.5, 0.9, 1.0])
    places = [0, (n - 1) // 4, (n - 1) // 2]
    np.testing.assert_array_equal(found["x"][:3], wanted[places])
    at = 0.9 * (n - 1)
    np.testing.assert_allclose(found["x"][3], np.interp(at, [int(at), int(at) + 1], wanted[int(at) : int(at) + 2]))
    assert np.isnan(found["x"][4]) and found["same"] == [1.5] * 5 and found["few"] == [0, 0, 1, 2, 2]


def test_shape(spark):
    df = frame(spark, v=[1, 2, 4, 9])
    row = profile.shape(df, ["v"]).first()
    assert abs(row.skewness - 0.768417) < 1e-6 and abs(row.kurtosis + 1.0) < 0.01
    assert (row.skew_label, row.tail_label) == ("right-skewed", "platykurtic")
    row = profile.describe(df, ["v"]).first()
    assert (row.q25, row["median"], row.q75) == (1.75, 3.0, 5.25)


def test_ols(spark):
    row = profile.ols_trend(frame(spark, x=[1, 2, 4], y=[2, 3, 9]), "x", "y").first()
    assert abs(row.slope - 2.428571) < 1e-6 and abs(row.intercept + 1) < 1e-9
    assert abs(row.r2 - 0.960133) < 1e-6
    assert profile.ols_trend(frame(spark, x=[1, 1], y=[1, 2]), "x", "y").first().slope is None


def test_correlations_of_many_columns_with_gaps(spark):
    """148 columns against pandas; what is planned grows with the columns, not with their pairs."""
    data = RNG.normal(0, 1, (60, 148)) + 1e6
    data[:, 1::2] = data[:, ::2] * 0.5 + RNG.normal(0, 1, (60, 74))
    data[RNG.random(data.shape) < 0.1] = np.nan
    data[:, 5] = 4.0
    wide = pd.DataFrame(data, columns=[f"c{i}" for i in range(148)])
    df = frame(spark, **wide).repartition(3)
    out = profile.correlation_matrix(df, df.columns)
    found = out.toPandas().pivot(index="x", columns="y", values="r").loc[wide.columns, wide.columns]
    expected = wide.corr()
    expected.loc["c5"] = expected["c5"] = np.nan
    np.testing.assert_allclose(found.to_numpy(float), expected.to_numpy(), atol=1e-7)
    few = profile.correlation_matrix(df.select("c0", "c1", "c2"), ["c0", "c1", "c2"])
    size = lambda d: len(d._jdf.queryExecution().optimizedPlan().toString())
    assert size(out) - size(few) < 148 * 400


def test_correlations(spark):
    df = frame(spark, x=[1, 2, 3, 4], y=[2, np.nan, 7, 1], z=[5, 5, 5, 5])
    found = {(r.x, r.y): r.r for r in profile.correlation_matrix(df, ["x", "y", "z"]).collect()}
    assert abs(found["x", "y"] - 0.033942) < 1e-6 and found["y", "x"] == found["x", "y"]
    assert found["x", "z"] is None and found["z", "z"] is None and found["x", "x"] == 1.0
    # Far from zero, with different gaps in every column.
    x = RNG.normal(1e6, 1, (300, 3)) + RNG.normal(0, 1, (300, 1))
    x[RNG.random(x.shape) < 0.2] = np.nan
    pdf = pd.DataFrame(x, columns=list("abc"))
    found = {(r.x, r.y): r.r for r in profile.correlation_matrix(frame(spark, **pdf), list("abc")).collect()}
    expected = pdf.corr()
    for a in "abc":
        for b in "abc":
            assert abs(found[a, b] - expected.loc[a, b]) < 1e-9


def test_histogram_and_box(spark):
    x = RNG.normal(0, 1, 500)
    df = frame(spark, v=x)
    rows = sorted(profile.histogram(df, "v").collect())
    counts = np.zeros(50)
    for r in rows:
        counts[r["bin"] - 1] = r.n
    np.testing.assert_array_equal(counts, np.histogram(x, 50)[0])
    assert profile.histogram(frame(spark, v=[2, 2, 2]), "v").first().n == 3
    assert profile.histogram(frame(spark, v=[np.nan]), "v").count() == 0
    row = profile.box_stats(df, ["v"]).first()
    q1, q3 = np.quantile(x, [0.25, 0.75])
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert row.lower_whisker == inside.min() and row.outliers == 500 - len(inside)


def test_missing(spark):
    df = frame(spark, a=[1, np.nan, np.nan, 1], b=[1, 1, 1, np.nan], c=[1, 1, 1, 1])
    rows = profile.missing_profile(df).collect()
    assert [(r.column_name, r.missing_count, r.missing_pct) for r in rows] == [("a", 2, 50.0), ("b", 1, 25.0)]
    assert profile.completeness(df).first().completeness_pct == 75.0


@pytest.mark.parametrize("rows_per_cut", [10_000, 90])
def test_decompose_whole(spark, rows_per_cut):
    n, period = 400, 24
    t = np.arange(n)
    v = 0.05 * t + 10 * np.sin(2 * np.pi * t / period) + RNG.normal(0, 1, n)
    df = spark.createDataFrame([("s", int(i), float(x)) for i, x in zip(t, v)], "k string, t int, v double")
    out = decompose.decompose(df, "v", ["k"], ["t"], whole=True, rows_per_cut=rows_per_cut)
    got = out.toPandas().sort_values("t")
    weights = np.r_[0.5, np.ones(23), 0.5] / 24
    trend = np.full(n, np.nan)
    trend[12:-12] = np.convolve(v, weights, "valid")
    means = np.array([np.nanmean((v - trend)[i::period]) for i in range(period)])
    seasonal = np.tile(means - means.mean(), n // period + 1)[:n]
    np.testing.assert_allclose(got["trend"].astype(float), trend, atol=1e-9)
    np.testing.assert_allclose(got["seasonal"].astype(float), seasonal, atol=1e-9)
    np.testing.assert_allclose(got["residual"].astype(float), v - trend - seasonal, atol=1e-9)
    short = decompose.decompose(df.filter("t < 40"), "v", ["k"], ["t"])
    assert short.count() == 0
