"""Queries: splits, scaling, models, scores, attribution, forecasts."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.ml import explain, forecast, models, validate
from airloom.ml.boost import AdaBoostR2
from airloom.ml.histboost import HistogramBoosting
from airloom.ml.neighbours import NearestNeighbours
from airloom.ml.prepare import LABEL, column_medians, labelled, standard_scale
from airloom.operators import reshape, windows
from airloom.operators.cuts import HOURLY_GRID_ROWS
from airloom.plans import runs
from airloom.plans.features import feature_frame, training_columns
from airloom.queries.common import HOURLY_SQL, R, TS, hourly, present, table
from airloom.schemas import SERIES
from airloom.session import materialise, shared_folder

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


FOLD_SQL = """n AS (SELECT count(*) AS n, count(*) // 6 AS test FROM {src}),
    f AS (SELECT fold, n - (5 - fold) * test AS start, n - (4 - fold) * test AS stop
          FROM n, range(0, 5) r(fold))"""


@query(
    "ts_split",
    f"""WITH e AS (SELECT event_id, value, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events),
        {FOLD_SQL.format(src='e')}
        SELECT fold::BIGINT AS fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role, count(*)::BIGINT AS n,
               min(event_id)::BIGINT AS first_id, max(event_id)::BIGINT AS last_id, {R('avg(value)')} AS mean_value
        FROM e JOIN f ON pos < stop GROUP BY 1, 2""",
)
def ts_split(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    uses = validate.time_split(df, ["ts", "event_id"])
    return present(
        uses.groupBy("fold", "role").agg(
            F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"), F.avg("value").alias("mean_value"),
        )
    )


BASELINE_SQL = f"""p AS (SELECT * FROM (SELECT series_key, datetime, aqi AS y,
        lag(aqi, 24) OVER (PARTITION BY series_key ORDER BY datetime) AS yhat FROM ({HOURLY_SQL}))
        WHERE yhat IS NOT NULL),
    e AS (SELECT *, row_number() OVER (ORDER BY datetime, series_key) - 1 AS pos FROM p),
    {FOLD_SQL.format(src='e')},
    m AS (SELECT fold, sqrt(avg((y - yhat) * (y - yhat))) AS rmse, avg(abs(y - yhat)) AS mae,
                 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, count(*) AS n
          FROM e JOIN f ON pos >= start AND pos < stop GROUP BY 1)"""


def baseline_folds(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    naive = forecast.seasonal_naive(rows, "aqi", ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)
    known = naive.filter("prediction IS NOT NULL").withColumnRenamed("aqi", LABEL)
    uses = validate.time_split(known, ["datetime", "series_key"]).filter("role = 'test'")
    return validate.error_metrics(uses, ["fold"])


@query(
    "fold_metrics",
    f"WITH {BASELINE_SQL} SELECT fold::BIGINT AS fold, {R('rmse')} AS rmse, {R('mae')} AS mae, {R('r2')} AS r2, n::BIGINT AS n FROM m",
)
def fold_metrics(spark, sf_dir):
    return present(baseline_folds(spark, sf_dir))


@query(
    "cv_metrics",
    f"""WITH {BASELINE_SQL} SELECT 'seasonal_naive' AS model, {R('avg(rmse)')} AS rmse_mean, {R('stddev_pop(rmse)')} AS rmse_std,
        {R('avg(mae)')} AS mae_mean, {R('avg(r2)')} AS r2_mean, count(*)::BIGINT AS n_folds FROM m""",
)
def cv_metrics(spark, sf_dir):
    folds = baseline_folds(spark, sf_dir).withColumn("model", F.lit("seasonal_naive"))
    return present(validate.summarise(folds))


@query(
    "standard_scale",
    "SELECT l_orderkey, "
    + ", ".join(
        f"{R(f'({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()')} AS {c}"
        for c in ("l_quantity", "l_discount", "l_tax")
    )
    + " FROM lineitem",
)
def scaled(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_tax")
    return present(standard_scale(df, ["l_quantity", "l_discount", "l_tax"]))


DIRTY = ("speed", "share", "l_tax")
DIRTY_SQL = """SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 45 THEN NULL ELSE l_extendedprice / 1000 END AS price,
    CASE WHEN l_discount = 0 THEN 'Infinity'::DOUBLE ELSE 1 / l_discount END AS speed,
    CASE WHEN l_linenumber = 1 THEN '-Infinity'::DOUBLE WHEN l_linenumber = 2 THEN 'NaN'::DOUBLE
         WHEN l_linenumber = 3 THEN NULL ELSE l_quantity / 50 END AS share, l_tax FROM lineitem"""


def dirty_rows(spark, sf_dir):
    """Line items with infinities, NaN and gaps, some without a target."""
    c, inf = F.col, float("inf")
    line = c("l_linenumber")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(c("l_quantity") <= 45, c("l_extendedprice") / 1000).alias("price"),
        F.when(c("l_discount") == 0, inf).otherwise(F.try_divide(F.lit(1.0), c("l_discount"))).alias("speed"),
        F.when(line == 1, -inf).when(line == 2, float("nan")).when(line != 3, c("l_quantity") / 50).alias("share"), "l_tax",
    )


@query(
    "clean_matrix",
    f"""WITH d AS ({DIRTY_SQL}),
        c AS (SELECT l_orderkey, l_linenumber, price, {', '.join(f"CASE WHEN isfinite({x}) THEN {x} END AS {x}" for x in DIRTY)}
              FROM d WHERE price IS NOT NULL),
        m AS (SELECT {', '.join(f'quantile_cont({x}, 0.5) AS m_{x}' for x in DIRTY)} FROM c),
        f AS (SELECT l_orderkey, l_linenumber, price, {', '.join(f'coalesce({x}, m_{x}) AS {x}' for x in DIRTY)} FROM c, m)
        SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {R('price')} AS label,
               {', '.join(f"{R(f'({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()')} AS {x}" for x in DIRTY)} FROM f""",
)
def clean_matrix(spark, sf_dir):
    """The training matrix: rows with a target, infinities and gaps filled with medians, all scaled."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array

    from airloom.ml.prepare import matrix_stages, scaling

    clean = labelled(dirty_rows(spark, sf_dir), "price", DIRTY, keep=["l_orderkey", "l_linenumber"])
    fill = column_medians(clean, DIRTY)
    matrix = PipelineModel(matrix_stages(fill, scaling(clean, fill))).transform(clean)
    x = vector_to_array("features")
    return present(matrix.select("l_orderkey", "l_linenumber", LABEL, *[F.get(x, F.lit(i)).alias(c) for i, c in enumerate(DIRTY)]))


# --- linear models ----------------------------------------------------------

def price_rows(spark, sf_dir, features):
    """Line price in thousands, to be predicted from the other measures."""
    df = table(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice") / 1000)
    return labelled(df, "price", features)


def weights(spark, sf_dir, factory, features):
    rows = price_rows(spark, sf_dir, features)
    fitted = validate.fit(rows, column_medians(rows, features), factory)
    found = [*zip(features, map(float, fitted.model.coefficients)), ("intercept", float(fitted.model.intercept))]
    return present(spark.createDataFrame(found, "feature string, weight double"))


MOMENTS = """s AS (SELECT count(*) AS n, avg(y) AS ym, corr(a, b) AS r,
    covar_pop(a, y) / stddev_pop(a) AS ca, covar_pop(b, y) / stddev_pop(b) AS cb
    FROM (SELECT l_quantity AS a, l_tax AS b, l_extendedprice / 1000 AS y FROM lineitem))"""


def weight_rows(**parts) -> str:
    return " UNION ALL ".join(f"SELECT '{k}' AS feature, {R(x)} AS weight FROM s" for k, x in parts.items())


@query(
    "ridge",
    f"WITH {MOMENTS} " + weight_rows(
        l_quantity="((n + 1) * n * ca - n * r * n * cb) / ((n + 1) * (n + 1) - n * r * n * r)",
        l_tax="((n + 1) * n * cb - n * r * n * ca) / ((n + 1) * (n + 1) - n * r * n * r)",
        intercept="ym",
    ),
)
def ridge(spark, sf_dir):
    return weights(spark, sf_dir, models.ridge, ["l_quantity", "l_tax"])


@query("lasso", f"WITH {MOMENTS} " + weight_rows(l_quantity="sign(ca) * greatest(abs(ca) - 0.1, 0)", intercept="ym"))
def lasso(spark, sf_dir):
    return weights(spark, sf_dir, models.lasso, ["l_quantity"])


@query(
    "elastic_net",
    f"WITH {MOMENTS} " + weight_rows(
        l_quantity="sign(ca) * greatest(abs(ca) - 0.05, 0) / (1 + 0.05)", intercept="ym"
    ),
)
def elastic_net(spark, sf_dir):
    return weights(spark, sf_dir, models.elastic_net, ["l_quantity"])


@query(
    "linear_attribution",
    "SELECT 'linear' AS model, feature, importance FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {R(f'avg(abs({c} - m) * {w})')} AS importance "
        f"FROM lineitem, (SELECT avg({c}) AS m FROM lineitem)"
        for c, w in (("l_quantity", 1.5), ("l_tax", 20.0))
    )
    + ")",
)
def linear_attribution(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    return present(explain.linear_attribution(df, {"l_quantity": 1.5, "l_tax": 20.0}))


# --- nearest neighbours -----------------------------------------------------

NEAR = ("pm25", "pm10", "no2")
NEAREST_SQL = f"""WITH h AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY datetime, series_key) - 1 AS pos
        FROM ({HOURLY_SQL})),
    c AS (SELECT count(*) - count(*) // 6 AS start FROM h),
    d AS (SELECT q.series_key, q.datetime, t.aqi AS y, sqrt(power(q.pm25 - t.pm25, 2) + power(q.pm10 - t.pm10, 2)
          + power(q.no2 - t.no2, 2)) AS d FROM h q, h t, c WHERE q.pos >= start AND t.pos < start
          QUALIFY row_number() OVER (PARTITION BY q.series_key, q.datetime ORDER BY d) <= 5)
    SELECT series_key, {TS('datetime')} AS datetime,
           {R('coalesce(avg(y) FILTER (d = 0), sum(y / d) FILTER (d > 0) / sum(1 / d) FILTER (d > 0))', 3)} AS prediction
    FROM d GROUP BY 1, 2"""


def predicted_by_neighbours(spark, sf_dir, **settings):
    """The newest sixth of the hours from its five nearest earlier ones."""
    rows = windows.with_position(
        hourly(spark, sf_dir), [], ["datetime", "series_key"], "pos"
    )
    n = rows.count()
    start = n - n // 6
    from pyspark.ml.feature import VectorAssembler

    matrix = VectorAssembler(inputCols=list(NEAR), outputCol="features").transform(
        rows.withColumn(LABEL, F.col("aqi"))
    )
    fitted = NearestNeighbours(k=5, **settings).fit(matrix.filter(F.col("pos") < start))
    asked = matrix.filter(F.col("pos") >= start).select("series_key", "datetime", "features")
    return present(fitted.transform(asked).drop("features"), digits=3)


@query("knn", NEAREST_SQL)
def knn(spark, sf_dir):
    return predicted_by_neighbours(spark, sf_dir)


@query("knn_by_cells", NEAREST_SQL)
def knn_by_cells(spark, sf_dir):
    """The search used where the training rows are too many to broadcast."""
    return predicted_by_neighbours(spark, sf_dir, broadcast_values=0, fan=16, leaf_rows=200, chunk_rows=400)


# --- trees and comparison ---------------------------------------------------

LAGGED = ["aqi_lag_1h", "aqi_lag_24h", "aqi_rolling_mean_24h", "pm25", "no2"]


def training_rows(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi", "pm25", "no2")
    arranged = windows.arrange(rows, ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)
    out = arranged.extend(before=25).select("*", *windows.lag_columns(arranged, ["aqi"], (1, 24)))
    out = windows.add_rolling(out, arranged, "aqi", (24,), ("mean",), offset=1)
    return out.filter("_own").drop("_own")


def fitted_metrics(spark, sf_dir, name):
    """Fit on the hours before each of the five test folds, measured on the fold."""
    rows = training_rows(spark, sf_dir)
    uses = validate.time_split(rows, ["datetime", "series_key"], folds=validate.FOLDS)
    clean = materialise(labelled(uses, "aqi", LAGGED, keep=["fold", "role"]), "folds")
    out = []
    for fold in range(validate.FOLDS):
        train = clean.filter((F.col("fold") == fold) & (F.col("role") == "train"))
        held = clean.filter((F.col("fold") == fold) & (F.col("role") == "test"))
        fitted = validate.fit(train, column_medians(train, LAGGED), models.MODELS[name])
        scores = validate.error_metrics(fitted.transform(held))
        out.append(scores.withColumns({"model": F.lit(name), "fold": F.lit(fold)}))
    return present(reduce(DataFrame.unionByName, out), digits=2)


def _register(name, model):
    @query(name)
    def run(spark, sf_dir):
        return fitted_metrics(spark, sf_dir, model)

    return run


for _name, _model in (
    ("random_forest", "RandomForest"), ("gradient_boosting", "GradientBoosting"),
    ("extra_trees", "ExtraTrees"), ("ada_boost", "AdaBoost"),
    ("column_sampled_boosting", "ColumnSampledBoosting"),
):
    _register(_name, _model)


STEPS_SQL = "CASE WHEN l_quantity > 25 THEN 10 ELSE 2 END + CASE WHEN l_tax > 0.04::DOUBLE THEN 5 ELSE 0 END"


@query(
    "step_boosting",
    f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {R(STEPS_SQL)} AS prediction FROM lineitem",
)
def step_boosting(spark, sf_dir):
    """Trees of two levels give a target of two steps back exactly."""
    df = table(spark, sf_dir, "lineitem")
    steps = F.when(F.col("l_quantity") > 25, 10.0).otherwise(2.0) + F.when(F.col("l_tax") > 0.04, 5.0).otherwise(0.0)
    features = ["l_quantity", "l_tax", "l_discount"]
    rows = labelled(df.withColumn("steps", steps), "steps", features, keep=["l_orderkey", "l_linenumber"])
    fitted = validate.fit(
        rows, column_medians(rows, features), lambda train: HistogramBoosting(rounds=2, depth=2, rate=1.0, l2=0.0)
    )
    return present(fitted.transform(rows).select("l_orderkey", "l_linenumber", "prediction"))


@query("leaderboard")
def leaderboard(spark, sf_dir):
    """Cross-validated linear models; unavailable ones are listed with a reason."""
    chosen = {k: models.MODELS[k] for k in ("Ridge", "Lasso", "ElasticNet", "XGBoost", "LightGBM")}
    rows = training_rows(spark, sf_dir)
    results = validate.cross_validate(rows, LAGGED, "aqi", ["datetime", "series_key"], chosen)
    return present(reshape.ranked_results(results))


@query("best_model")
def best_model(spark, sf_dir):
    """The best of all models, each over five folds."""
    rows = training_rows(spark, sf_dir)
    return present(
        reshape.best_model(validate.cross_validate(rows, LAGGED, "aqi", ["datetime", "series_key"]))
    )


def _linear(spark, sf_dir):
    clean = labelled(training_rows(spark, sf_dir), "aqi", LAGGED, keep=["series_key", "datetime"])
    return clean, validate.fit(clean, column_medians(clean, LAGGED), models.ridge)


@query("batch_scores")
def batch_scores(spark, sf_dir):
    """Predictions for every hourly row, raw columns in."""
    _, fitted = _linear(spark, sf_dir)
    scored = validate.score(training_rows(spark, sf_dir), fitted, LAGGED)
    return present(scored.select("series_key", "datetime", "prediction"))


@query(
    "saved_models",
    " UNION ALL ".join(
        f"""SELECT '{m}' AS model, {v}::BIGINT AS version, count(*)::BIGINT AS n, count(*)::BIGINT AS alike
            FROM (SELECT DISTINCT event_type, date_trunc('hour', ts) FROM events)"""
        for m, v in (("AdaBoost", 1), ("KNN", 1), ("Ridge", 1), ("Ridge", 2))
    ),
)
def saved_models(spark, sf_dir):
    """Models saved, registered, loaded by name and version, and scored as before they were saved."""
    rows = materialise(training_rows(spark, sf_dir), "scored")
    clean = labelled(rows, "aqi", LAGGED)
    place = f"{shared_folder(spark)}/airloom/models-{uuid.uuid4().hex}"
    factories = {"AdaBoost": lambda train: AdaBoostR2(rounds=5), "KNN": models.nearest_neighbours, "Ridge": models.ridge}
    out = []
    for name, times in (("AdaBoost", 1), ("KNN", 1), ("Ridge", 2)):
        fitted = validate.fit(clean, column_medians(clean, LAGGED), factories[name])
        for _ in range(times):
            version = runs.save_and_register(spark, fitted, f"{place}/registry", place, name, {"n": float(times)})
            again = runs.load_model(spark, f"{place}/registry", name, version)
            before, after = (
                validate.score(rows, m, LAGGED).select("series_key", "datetime", F.col("prediction").alias(p))
                for m, p in ((fitted, "before"), (again, "after"))
            )
            both = before.join(after, ["series_key", "datetime"])
            out.append(both.agg(
                F.lit(name).alias("model"), F.lit(version).alias("version"), F.count(F.lit(1)).alias("n"),
                F.count_if(F.abs(F.col("before") - F.col("after")) < 1e-9).alias("alike"),
            ))
    return present(reduce(DataFrame.unionByName, out))


@query(
    "train_and_score",
    """SELECT event_type AS series_key, 'Ridge' AS model, 1::BIGINT AS version, 100::BIGINT AS features,
       count(DISTINCT date_trunc('hour', ts))::BIGINT AS scored FROM events GROUP BY 1""",
)
def train_and_score(spark, sf_dir):
    """Observations to features, to a trained and registered model, to its scores."""
    frame = feature_frame(hourly(spark, sf_dir), longest=HOURLY_GRID_ROWS)
    place = f"{shared_folder(spark)}/airloom/trained-{uuid.uuid4().hex}"
    features = materialise(frame, "features")
    out = runs.training(
        spark, features, f"{place}/registry", place, models={"Ridge": models.ridge, "XGBoost": None}, leave_out=[SERIES]
    )
    scored = runs.scoring(spark, features, f"{place}/registry", out["best_model"], out["version"], [SERIES])
    return present(
        scored.groupBy(SERIES).agg(
            F.lit(out["best_model"]).alias("model"), F.lit(out["version"]).alias("version"),
            F.lit(out["n_features"]).alias("features"), F.count("prediction").alias("scored"),
        )
    )


@query("tree_importance")
def tree_importance(spark, sf_dir):
    clean = labelled(training_rows(spark, sf_dir), "aqi", LAGGED)
    fitted = validate.fit(clean, column_medians(clean, LAGGED), models.random_forest)
    long = explain.tree_importance(spark, {"RandomForest": fitted.model}, LAGGED)
    return present(reshape.top_rows(long, "importance", reshape.TOP_FEATURES, ["feature"]))


@query("permutation_importance")
def permutation_importance(spark, sf_dir):
    clean, fitted = _linear(spark, sf_dir)
    keyed = clean.withColumn("row_key", F.concat_ws("|", "series_key", F.col("datetime").cast("string")))
    return present(explain.permutation_importance(keyed, fitted, LAGGED, "row_key", "Ridge"))


class Formula:
    """A linear model with given weights, scored like a fitted one."""

    def __init__(self, weights, intercept):
        self.weights, self.intercept = weights, intercept

    def transform(self, df):
        total = reduce(lambda a, b: a + b, [F.col(c) * w for c, w in self.weights.items()])
        return df.withColumn("prediction", total + self.intercept)


LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
FORMULA = {"l_quantity": 1.5, "l_tax": 20.0, "l_discount": -4.0}


def formula_sql(swapped=None) -> str:
    """RMSE of the formula, one column swapped with the next row's in hash order."""
    y = " + ".join(f"{w} * {'o_' if c == swapped else ''}{c}" for c, w in FORMULA.items())
    return f"(SELECT sqrt(avg(power(y - ({y}), 2))) FROM x)"


@query(
    "permutation_importance_linear",
    f"""WITH k AS (SELECT *, l_extendedprice / 1000 AS y, concat_ws('|', {', '.join(LINE_KEY)}) AS key FROM lineitem),
        o AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || key), key) AS n, count(*) OVER () AS total FROM k),
        x AS (SELECT a.*, {', '.join(f'b.{c} AS o_{c}' for c in FORMULA)} FROM o a JOIN o b ON b.n = a.n % a.total + 1) """
    + " UNION ALL ".join(
        f"SELECT 'Formula' AS model, '{c}' AS feature, {R(f'{formula_sql(c)} - {formula_sql()}')} AS importance" for c in FORMULA
    ),
)
def permutation_importance_linear(spark, sf_dir):
    """A model whose errors under swapped columns SQL can say."""
    rows = table(spark, sf_dir, "lineitem").withColumns({
        LABEL: F.col("l_extendedprice") / 1000, "row_key": F.concat_ws("|", *LINE_KEY),
    })
    return present(explain.permutation_importance(rows, Formula(FORMULA, 0.0), list(FORMULA), "row_key", "Formula"))


@query("model_forecast")
def model_forecast(spark, sf_dir):
    """One, twenty-four and seventy-two hours ahead of each series' newest hour."""
    rows = training_rows(spark, sf_dir).select("series_key", "datetime", "aqi", *LAGGED)
    return present(
        forecast.forecast(
            rows, LAGGED, "aqi", ["series_key"], ["datetime"], models.ridge, (1, 24, 72),
            longest=HOURLY_GRID_ROWS,
        )
    )


@query(
    "training_columns",
    "SELECT 100::BIGINT AS features, count(*)::BIGINT AS rows FROM (SELECT DISTINCT event_type, date_trunc('hour', ts) FROM events)",
)
def count_training_columns(spark, sf_dir):
    """How many columns of the feature frame enter training, and on how many rows."""
    frame = feature_frame(hourly(spark, sf_dir), longest=HOURLY_GRID_ROWS)
    chosen = training_columns(frame, leave_out=["series_key"])
    matrix = labelled(frame, "aqi", chosen)
    return present(matrix.agg(F.lit(len(chosen)).alias("features"), F.count(F.lit(1)).alias("rows")))
