"""Models against numpy; splits, neighbours, boosting, explanation."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from airloom.functions import bands
from airloom.ml import explain, forecast, models, validate
from airloom.ml.boost import AdaBoostR2, weighted_median
from airloom.ml.histboost import HistogramBoosting, HistogramBoostingModel
from airloom.ml.neighbours import NearestNeighbours
from airloom.ml.prepare import column_medians, labelled, standard_scale
from airloom.plans.features import feature_frame, training_columns

RNG = np.random.default_rng(11)
N, NAMES = 300, ["a", "b", "c"]
X = RNG.normal(0, 1, (N, 3)) * [1, 5, 0.2] + [0, 100, 3]
Y = X @ [2.0, -0.3, 4.0] + RNG.normal(0, 0.5, N)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, float(y), *map(float, x)) for i, (x, y) in enumerate(zip(X, Y))]
    return spark.createDataFrame(data, "id int, y double, a double, b double, c double").repartition(3)


def scaled(x):
    return (x - x.mean(0)) / x.std(0)


def descend(z, y, l1, l2, steps=3000):
    """Coordinate descent on |y - zw|^2 / 2n + l1 |w| + l2 |w|^2 / 2."""
    w, n = np.zeros(z.shape[1]), len(y)
    for _ in range(steps):
        for j in range(len(w)):
            r = y - z @ w + z[:, j] * w[j]
            c = z[:, j] @ r / n
            w[j] = np.sign(c) * max(abs(c) - l1, 0) / (z[:, j] @ z[:, j] / n + l2)
    return w


def weights(rows, factory):
    clean = labelled(rows, "y", NAMES)
    fitted = validate.fit(clean, column_medians(clean, NAMES), factory)
    return np.array(fitted.model.coefficients), fitted


def test_linear_models(rows, tmp_path):
    z, y = scaled(X), Y - Y.mean()
    w, fitted = weights(rows, models.ridge)
    np.testing.assert_allclose(w, np.linalg.solve(z.T @ z + np.eye(3), z.T @ y), atol=1e-8)
    np.testing.assert_allclose(weights(rows, models.lasso)[0], descend(z, y, 0.1, 0.0), atol=1e-6)
    np.testing.assert_allclose(weights(rows, models.elastic_net)[0], descend(z, y, 0.05, 0.05), atol=1e-6)
    # Saved and loaded again, the pipeline scores raw rows.
    fitted.save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    out = validate.score(rows, loaded, NAMES).select("id", "prediction").toPandas().set_index("id")
    expected = Y.mean() + z @ w
    np.testing.assert_allclose(out["prediction"].sort_index(), expected, atol=1e-8)


def test_missing_and_infinite_inputs(spark, rows):
    dirty = rows.withColumn("a", F.when(F.col("id") == 0, float("inf")).when(F.col("id") == 1, None).otherwise(F.col("a")))
    clean = labelled(dirty, "y", NAMES).withColumn("none", F.lit(None).cast("double"))
    fill = column_medians(clean, [*NAMES, "none"])
    assert abs(fill["a"] - np.median(X[2:, 0])) < 1e-12 and fill["none"] == 0.0
    fitted = validate.fit(clean, fill, models.ridge)
    assert fitted.transform(clean).filter("prediction IS NULL OR isnan(prediction)").count() == 0


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, k double")
    assert [tuple(r) for r in standard_scale(df, ["a", "k"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_folds(spark):
    assert validate.fold_bounds(10) == [(k, 5 + k, 6 + k) for k in range(5)]
    assert validate.fold_bounds(18_120)[0] == (0, 3020, 6040)
    with pytest.raises(ValueError):
        validate.fold_bounds(5)
    df = spark.range(20).withColumnRenamed("id", "t").repartition(4)
    uses = validate.time_split(df, ["t"], rows_per_cut=6).toPandas()
    for k, start, end in validate.fold_bounds(20):
        part = uses[uses["fold"] == k]
        assert sorted(part[part["role"] == "train"]["t"]) == list(range(start))
        assert sorted(part[part["role"] == "test"]["t"]) == list(range(start, end))


def test_cross_validation(rows):
    def broken(train):
        raise RuntimeError("no such solver")

    chosen = {"Ridge": models.ridge, "Broken": broken, "XGBoost": None}
    results, best, fitted = validate.train_best(rows, NAMES, "y", ["id"], chosen, folds=3)
    found = {r.model: r for r in results.collect()}
    assert best == "Ridge" and found["Ridge"].n_folds == 3
    assert found["Broken"].error == "no such solver" and found["Broken"].rmse_mean is None
    assert found["XGBoost"].error == "not available"
    errors = []
    for _, start, end in validate.fold_bounds(N, 3):
        m, s = X[:start].mean(0), X[:start].std(0)
        z, y = (X[:start] - m) / s, Y[:start]
        w = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y - y.mean()))
        errors.append(np.sqrt(np.mean((Y[start:end] - y.mean() - (X[start:end] - m) / s @ w) ** 2)))
    assert abs(found["Ridge"].rmse_mean - np.mean(errors)) < 1e-8
    assert abs(found["Ridge"].rmse_std - np.std(errors)) < 1e-8


def test_folds_are_filled_from_their_own_training_rows(spark):
    """What a fold's gaps are filled with lies among its own values, not among later ones."""
    rows = [(i, None if i % 4 == 0 else float(i if i < 60 else 1e6), float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "id int, b double, y double")
    seen = []

    class Spy:
        def __init__(self, train):
            self.inner = models.ridge(train)

        def fit(self, matrix):
            seen.append({round(float(r.features[0]), 3) for r in matrix.collect()})
            return self.inner.fit(matrix)

    result = validate.cross_validate(df, ["b"], "y", ["id"], {"Ridge": Spy}, folds=3, parallel=1).first()
    # Were the gaps filled with a median of all rows, the first fold's other values would be as one.
    assert result.error is None and len(seen[0]) > 20


def brute(train, labels, queries, k=5):
    out = []
    for q in queries:
        d = np.sqrt(((train - q) ** 2).sum(1))
        near = np.argsort(d, kind="stable")[:k]
        exact = near[d[near] == 0]
        out.append(labels[exact].mean() if len(exact) else np.average(labels[near], weights=1 / d[near]))
    return np.array(out)


@pytest.mark.parametrize("settings", [{}, {"broadcast_values": 0, "fan": 4, "leaf_rows": 12, "chunk_rows": 9}])
def test_neighbours(rows, settings):
    matrix = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows.withColumnRenamed("y", "label"))
    train = matrix.filter("id < 250").unionByName(matrix.filter("id = 7"))
    queries = matrix.filter("id >= 240")
    out = NearestNeighbours(5, **settings).fit(train).transform(queries.select("id", "features")).toPandas()
    expected = brute(np.r_[X[:250], X[7:8]], np.r_[Y[:250], Y[7:8]], X[240:])
    np.testing.assert_allclose(out.sort_values("id")["prediction"], expected, rtol=1e-9)


def test_neighbours_compare_fewer_pairs_than_all(spark):
    """Twice as many rows and queries: the compared pairs grow far less than fourfold."""
    points = np.random.default_rng(5).random((4000, 2))
    pairs = {}
    for n in (2000, 4000):
        df = spark.createDataFrame([(float(a), float(b), float(a + b)) for a, b in points[:n]], "a double, b double, label double")
        matrix = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
        model = NearestNeighbours(5, broadcast_values=0, fan=8, leaf_rows=100).fit(matrix)
        assert model.nodes.filter("leaf").agg(F.max("n")).first()[0] <= 100
        queries = matrix.select(F.monotonically_increasing_id().alias("query"), vector_to_array("features").alias("x"))
        sizes = model.nodes.filter("leaf").select("cell", "n")
        pairs[n] = model.visits(queries).join(sizes, "cell").agg(F.sum("n")).first()[0]
    assert pairs[4000] < 2.8 * pairs[2000] and pairs[4000] < 4000 * 4000 / 8


def test_neighbours_of_equal_rows(spark):
    """Rows that cannot be told apart stay one leaf and are searched in chunks."""
    df = spark.createDataFrame([(1.0, float(i % 2)) for i in range(300)] + [(2.0, 5.0)], "a double, label double")
    matrix = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = NearestNeighbours(3, broadcast_values=0, fan=4, leaf_rows=20, chunk_rows=50).fit(matrix)
    found = {r.a: r.prediction for r in model.transform(matrix.select("a", "features").distinct()).collect()}
    assert 0 <= found[1.0] <= 1 and found[2.0] == 5.0


@pytest.mark.parametrize("name", ["Ridge", "AdaBoost", "KNN", "KNN by cells"])
def test_saved_models_score_as_before(rows, tmp_path, name):
    factory = {
        "Ridge": models.ridge, "AdaBoost": lambda train: AdaBoostR2(rounds=3), "KNN": models.nearest_neighbours,
        "KNN by cells": lambda train: NearestNeighbours(5, broadcast_values=0, fan=4, leaf_rows=40),
    }[name]
    clean = labelled(rows, "y", NAMES, keep=["id"])
    fitted = validate.fit(clean, column_medians(clean, NAMES), factory)
    fitted.save(str(tmp_path / "m"))
    again = validate.Fitted.load(str(tmp_path / "m"))
    before, after = (dict(m.transform(clean).select("id", "prediction").collect()) for m in (fitted, again))
    assert before == pytest.approx(after, rel=1e-12) and len(before) == N


def boosted_by_hand(x, y, rounds, depth, rate, l2):
    """Exhaustive second-order boosting on all distinct values."""
    score = np.full(len(y), y.mean())

    def grow(rows, level, g, out):
        total, n = g[rows].sum(), len(rows)
        best = (1e-12, None)
        for j in range(x.shape[1]):
            for cut in np.unique(x[rows, j])[:-1]:
                left = rows[x[rows, j] <= cut]
                gl, hl = g[left].sum(), len(left)
                gain = round(gl**2 / (hl + l2) + (total - gl) ** 2 / (n - hl + l2) - total**2 / (n + l2), 9)
                if gain > best[0]:
                    best = (gain, (j, cut))
        if level == depth or best[1] is None:
            out[rows] = -rate * total / (n + l2)
            return
        j, cut = best[1]
        grow(rows[x[rows, j] <= cut], level + 1, g, out)
        grow(rows[x[rows, j] > cut], level + 1, g, out)

    for _ in range(rounds):
        step = np.zeros(len(y))
        grow(np.arange(len(y)), 0, score - y, step)
        score = score + step
    return score


def test_histogram_boosting_by_hand(spark, tmp_path):
    """All values have bins of their own, so the trees are those of an exhaustive search."""
    rng = np.random.default_rng(4)
    x = np.c_[rng.integers(0, 20, 200), rng.integers(0, 7, 200), rng.integers(0, 3, 200)].astype(float)
    y = np.where(x[:, 0] > 7, 3.0, -1.0) * (1 + x[:, 1]) + rng.normal(0, 1, 200)
    data = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, label double")
    matrix = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df.repartition(3))
    model = HistogramBoosting(rounds=12, depth=3, rate=0.3, l2=1.0).fit(matrix)
    want = boosted_by_hand(x, y, 12, 3, 0.3, 1.0)
    model.write().overwrite().save(str(tmp_path / "m"))
    for m in (model, HistogramBoostingModel.load(str(tmp_path / "m"))):
        got = m.transform(matrix).select("id", "prediction").toPandas().set_index("id").sort_index()["prediction"]
        np.testing.assert_allclose(got, want, rtol=1e-9)
    constant = HistogramBoosting(rounds=3).fit(matrix.withColumn("label", F.lit(2.5)))
    assert constant.trees == [] and constant.transform(matrix).agg(F.max("prediction")).first()[0] == 2.5


def test_weighted_median(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0],)], "p array<double>")
    assert df.select(weighted_median(F.col("p"), [1.0, 1.0, 1.0])).first()[0] == 2.0
    assert df.select(weighted_median(F.col("p"), [5.0, 1.0, 1.0])).first()[0] == 3.0


def test_boosting_beats_one_tree(rows):
    matrix = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows.withColumnRenamed("y", "label"))
    one = AdaBoostR2(rounds=1).fit(matrix)
    many = AdaBoostR2(rounds=12, rate=1.0).fit(matrix)
    first, second = (validate.error_metrics(m.transform(matrix)).first()["rmse"] for m in (one, many))
    assert len(many.trees) > 1 and second < first


def test_explanation(spark, rows):
    clean = labelled(rows, "y", NAMES, keep=["id"])
    _, fitted = weights(rows, models.ridge)
    table = explain.permuted_columns(clean, NAMES, "id", rows_per_cut=70).toPandas()
    for c in NAMES:  # a permutation that moves every row
        np.testing.assert_allclose(np.sort(table[c]), np.sort(table[f"_other_{c}"]))
        assert (table[c] != table[f"_other_{c}"]).all()
    found = {r.feature: r.importance for r in explain.permutation_importance(clean, fitted, NAMES, "id", "Ridge").collect()}
    assert found["a"] > found["c"] > 0
    shares = {r.feature: r.importance for r in explain.linear_attribution(rows, {"a": 2.0, "b": -0.3}).collect()}
    assert abs(shares["a"] - np.abs(2 * (X[:, 0] - X[:, 0].mean())).mean()) < 1e-9


def test_ensemble(spark):
    a = spark.createDataFrame([(1, 2.0), (2, 4.0)], "k int, prediction double")
    b = spark.createDataFrame([(1, 4.0), (2, 8.0)], "k int, prediction double")
    assert {r.k: r.prediction for r in forecast.ensemble([a, b], ["k"]).collect()} == {1: 3.0, 2: 6.0}


def test_golden_row(spark):
    """One observation with a target only: NULLs stay NULL, flags are 0."""
    import airloom.schemas as schemas

    row = (["s", None] + [None] * 7 + [100.0, 50.0, 80.0, 30.0, 40.0, "x"])
    df = spark.createDataFrame([tuple(row)], schemas.OBSERVATION)
    frame = feature_frame(df)
    assert len(frame.columns) == 149 and len(training_columns(frame, ["series_key"])) == 100
    out = frame.first().asDict()
    assert out["aqi_moderate"] == 1 and out["aqi_good"] == 0 and out["is_weekend"] == 0
    assert out["hour"] is None and out["hour_sin"] is None and out["temp_humidity_interaction"] is None
    for k in (1, 24, 168):
        assert out[f"aqi_rolling_mean_{k}h"] == 100 and out[f"aqi_rolling_std_{k}h"] is None
        assert out[f"aqi_rolling_range_{k}h"] == 0 and out[f"pm25_lag_{k}h"] is None
    assert out["aqi_ema_24h"] == 100 and out["rolling_mean_2160h"] == 100


def test_tree_queries_measure_every_fold(spark):
    from airloom.queries import learning

    rows = learning.QUERIES["random_forest"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.fold for r in rows) == [0, 1, 2, 3, 4]


def test_forecast_intervals_hold_what_they_promise(spark):
    """Noise that grows with the horizon: each horizon's interval covers its share of unseen rows."""
    rng, start, n = np.random.default_rng(8), dt.datetime(2024, 1, 1), 700
    x, level = [], 50.0
    for _ in range(n + 60):
        level = 50 + 0.9 * (level - 50) + rng.normal(0, 2)
        x.append(level)
    known = [("s", start + dt.timedelta(hours=i), float(v), float(x[i - 1] if i else v)) for i, v in enumerate(x[:n])]
    df = spark.createDataFrame(known, "series_key string, datetime timestamp, aqi double, before double")
    features, keys, order = ["aqi", "before"], ["series_key"], ["datetime"]
    found = {r.hours_ahead: r for r in forecast.forecast(df, features, "aqi", keys, order, models.ridge, (1, 6), 0.8).collect()}
    assert found[6].upper - found[6].lower > 1.5 * (found[1].upper - found[1].lower)
    ahead = forecast.labelled_ahead(df, features, "aqi", keys, order, (1, 6))
    for h in (1, 6):
        residuals = forecast.held_out_residuals(ahead, features, "datetime", models.ridge, h, 3).toPandas()["residual"]
        low, high = found[h].lower - found[h].prediction, found[h].upper - found[h].prediction
        assert abs(residuals.between(low, high).mean() - 0.8) < 0.01
        # Rows after the end, predicted as a ridge on everything before would: the width holds there, too.
        spread = 2 * np.sqrt(sum(0.9 ** (2 * k) for k in range(h)))
        assert abs((high - low) / (2 * 1.2816 * spread) - 1) < 0.25


def test_forecast_days_and_alerts(spark):
    start = dt.datetime(2024, 1, 1, 0)
    data = [("s", start + dt.timedelta(hours=i), float(i % 24)) for i in range(60)] + [("t", start, 7.0), ("u", start, None)]
    df = spark.createDataFrame(data, "series_key string, datetime timestamp, aqi double")
    out = forecast.seasonal_forecast(df, "aqi", ["series_key"], "datetime", 48).collect()
    of = {r.datetime: r.prediction for r in out if r.series_key == "s"}
    assert len(of) == 48 and all(v == t.hour for t, v in of.items())
    assert [(r.hours_ahead, r.prediction) for r in out if r.series_key == "t"] == [(24, 7.0), (48, 7.0)]
    alerts = forecast.daily_alerts(df.withColumnRenamed("aqi", "prediction"), ["series_key"], "datetime",
                                   {**bands.THRESHOLDS, "good": 5, "moderate": 8, "unhealthy_sensitive": 10, "unhealthy": 20, "very_unhealthy": 30, "hazardous": 40})
    found = {(r.series_key, r.day): (r.highest, r.has_alert) for r in alerts.collect()}
    assert found["s", "2024-01-01"] == (23.0, True) and found["s", "2024-01-03"] == (11.0, False) and found["u", "2024-01-01"] == (None, False)
