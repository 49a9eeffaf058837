"""Expanding-window cross-validation, metrics, results and best model."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.ml.models import MODELS
from airloom.ml.prepare import (
    FEATURES, LABEL, column_medians, label_spread, labelled, matrix_stages, scaling,
)
from airloom.operators.cuts import ROWS_PER_CUT
from airloom.operators.windows import with_position
from airloom.schemas import finite
from airloom.session import materialise

FOLDS = 5
ROWS_PER_TASK = 50_000
ROW = "_row"
RESULT_SCHEMA = (
    "model string, rmse_mean double, rmse_std double, mae_mean double, r2_mean double, "
    "n_folds int, error string"
)


def fold_bounds(n: int, folds: int = FOLDS) -> list[tuple[int, int, int]]:
    """(fold, first validation row, end of validation rows); training is all before."""
    test = n // (folds + 1)
    if test == 0:
        raise ValueError(f"{n} rows are too few for {folds} folds")
    return [
        (k, n - (folds - k) * test, n - (folds - k - 1) * test) for k in range(folds)
    ]


def time_split(df: DataFrame, order: Sequence[str], folds: int = FOLDS, rows_per_cut: int = ROWS_PER_CUT) -> DataFrame:
    """Each row once per fold that uses it, with its role there."""
    placed = with_position(df, [], order, ROW, rows_per_cut)
    bounds = fold_bounds(df.count(), folds)
    uses = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(ROW) < end,
                    F.struct(
                        F.lit(k).alias("fold"),
                        F.when(F.col(ROW) < start, "train").otherwise("test").alias("role"),
                    ),
                )
                for k, start, end in bounds
            ]
        )
    )
    return placed.withColumn("_use", F.explode(uses)).select(*df.columns, "_use.*")


def error_metrics(predicted: DataFrame, by: Sequence[str] = (), label: str = LABEL) -> DataFrame:
    """RMSE, MAE and R2 in one aggregate."""
    y, guess = F.col(label), F.col("prediction")
    squares = F.sum((y - guess) * (y - guess))
    spread = F.var_pop(y) * F.count(y)
    return predicted.groupBy(*by).agg(
        F.sqrt(F.avg((y - guess) * (y - guess))).alias("rmse"),
        F.avg(F.abs(y - guess)).alias("mae"),
        (1 - F.try_divide(squares, spread)).alias("r2"),
        F.count(y).alias("n"),
    )


def summarise(fold_metrics: DataFrame) -> DataFrame:
    """Mean metrics per model; the deviation over folds is the population one."""
    return fold_metrics.groupBy("model").agg(
        F.avg("rmse").alias("rmse_mean"),
        F.stddev_pop("rmse").alias("rmse_std"),
        F.avg("mae").alias("mae_mean"),
        F.avg("r2").alias("r2_mean"),
        F.count("rmse").cast("int").alias("n_folds"),
    )


def fit(train: DataFrame, fill: Mapping[str, float], factory: Callable):
    """Scaler and model fitted on the rows given; returns a function that scores."""
    stages = PipelineModel(matrix_stages(fill, scaling(train, fill)))
    # Trees and boosting pass over the matrix many times: it is cached, and a
    # small one is kept in few partitions, since every pass costs a task each.
    rows = stages.transform(train).select(FEATURES, LABEL).persist(StorageLevel.MEMORY_AND_DISK)
    few = max(1, math.ceil(rows.count() / ROWS_PER_TASK))
    matrix = rows.coalesce(few) if few < rows.rdd.getNumPartitions() else rows
    try:
        return Fitted(stages, factory(train).fit(matrix))
    finally:
        rows.unpersist()


class Fitted:
    """Matrix stages and model that score together and save together."""

    def __init__(self, stages: PipelineModel, model):
        self.stages, self.model = stages, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.stages.transform(df))

    def save(self, path: str) -> None:
        PipelineModel([*self.stages.stages, self.model]).write().overwrite().save(path)

    @classmethod
    def load(cls, path: str) -> Fitted:
        *stages, model = PipelineModel.load(path).stages
        return cls(PipelineModel(stages), model)


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    order: Sequence[str],
    models: Mapping[str, Callable | None] = MODELS,
    folds: int = FOLDS,
    rows_per_cut: int = ROWS_PER_CUT,
    parallel: int = 4,
) -> DataFrame:
    """One result row per model; a model that fails is reported, not raised.

    The cleaned matrix is written once with its row numbers, and every fold is
    a range filter on it.
    """
    spark = df.sparkSession
    clean = labelled(df, target, features, keep=[c for c in order if c not in features])
    rows = materialise(with_position(clean, [], order, ROW, rows_per_cut), "folds")
    n, _ = label_spread(rows)
    bounds = fold_bounds(n, folds)
    # Each fold's missing values are filled from its own training rows.
    fills = {start: column_medians(rows.filter(F.col(ROW) < start), features) for _, start, _ in bounds}

    def compare(entry: tuple[str, Callable | None]) -> tuple:
        name, factory = entry
        if factory is None:
            return name, None, None, None, None, 0, "not available"
        try:
            scores = []
            for _, start, end in bounds:
                fitted = fit(rows.filter(F.col(ROW) < start), fills[start], factory)
                held = rows.filter((F.col(ROW) >= start) & (F.col(ROW) < end))
                scores.append(error_metrics(fitted.transform(held)).first())
            table = spark.createDataFrame(
                [(name, s["rmse"], s["mae"], s["r2"]) for s in scores],
                "model string, rmse double, mae double, r2 double",
            )
            s = summarise(table).first()
        except Exception as error:  # noqa: BLE001 - one model must not end the comparison
            return name, None, None, None, None, 0, str(error)
        return name, s["rmse_mean"], s["rmse_std"], s["mae_mean"], s["r2_mean"], s["n_folds"], None

    # The driver only waits for each fit, so several models share the cluster.
    with ThreadPoolExecutor(parallel) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(compare), models.items()))
    return spark.createDataFrame(results, RESULT_SCHEMA)


def train_best(
    df: DataFrame, features: Sequence[str], target: str, order: Sequence[str],
    models: Mapping[str, Callable | None] = MODELS, folds: int = FOLDS,
) -> tuple[DataFrame, str, Fitted]:
    """Compare, choose the lowest error and refit the winner on all rows."""
    results = cross_validate(df, features, target, order, models, folds)
    usable = [r for r in results.collect() if r["rmse_mean"] is not None]
    if not usable:
        raise RuntimeError("every model failed")
    best = min(usable, key=lambda r: (r["rmse_mean"], r["model"]))["model"]
    clean = labelled(df, target, features)
    return results, best, fit(clean, column_medians(clean, features), models[best])


def score(df: DataFrame, fitted, features: Sequence[str]) -> DataFrame:
    """Predictions beside the input columns, with the training clean-up."""
    cleaned = df.withColumns({c: finite(F.col(c).cast("double")) for c in features})
    return fitted.transform(cleaned).drop("features")
