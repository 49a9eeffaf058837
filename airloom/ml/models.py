"""The regressors that are compared, as factories taking the training rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.base import Estimator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame

from airloom.ml.boost import AdaBoostR2
from airloom.ml.histboost import HistogramBoosting
from airloom.ml.neighbours import NearestNeighbours
from airloom.ml.prepare import FEATURES, LABEL, label_spread

SEED = 42
COLUMNS = {"featuresCol": FEATURES, "labelCol": LABEL}


def ridge(train: DataFrame, alpha: float = 1.0) -> Estimator:
    """Minimises |y - Xw|^2 + alpha |w|^2.

    The solver divides the label by its deviation and the loss by n, so the
    penalty is alpha / n times that deviation.
    """
    n, spread = label_spread(train)
    return LinearRegression(
        solver="normal", elasticNetParam=0.0, regParam=alpha / n * spread,
        standardization=False, **COLUMNS,
    )


def lasso(train: DataFrame, alpha: float = 0.1) -> Estimator:
    """Minimises |y - Xw|^2 / 2n + alpha |w|."""
    return LinearRegression(
        solver="normal", elasticNetParam=1.0, regParam=alpha, standardization=False,
        maxIter=1000, tol=1e-9, **COLUMNS,
    )


def elastic_net(train: DataFrame, alpha: float = 0.1, l1_ratio: float = 0.5) -> Estimator:
    """Minimises |y - Xw|^2 / 2n + alpha (ratio |w| + (1 - ratio) |w|^2 / 2)."""
    _, spread = label_spread(train)
    first, second = alpha * l1_ratio, alpha * (1 - l1_ratio) * spread
    return LinearRegression(
        solver="normal", regParam=first + second, elasticNetParam=first / (first + second),
        standardization=False, maxIter=1000, tol=1e-9, **COLUMNS,
    )


def random_forest(train: DataFrame) -> Estimator:
    return RandomForestRegressor(
        numTrees=100, maxDepth=10, minInstancesPerNode=2, featureSubsetStrategy="all",
        seed=SEED, **COLUMNS,
    )


def extra_trees(train: DataFrame) -> Estimator:
    """Stand-in: unbagged trees on a third of the features per split."""
    return RandomForestRegressor(
        numTrees=100, maxDepth=10, bootstrap=False, subsamplingRate=1.0,
        featureSubsetStrategy="onethird", seed=SEED, **COLUMNS,
    )


def gradient_boosting(train: DataFrame) -> Estimator:
    return GBTRegressor(
        maxIter=100, maxDepth=5, stepSize=0.1, subsamplingRate=0.8, seed=SEED, **COLUMNS
    )


def column_sampled_boosting(train: DataFrame) -> Estimator:
    """Boosting on 80 % of rows and columns, depth 6."""
    return GBTRegressor(
        maxIter=100, maxDepth=6, stepSize=0.1, subsamplingRate=0.8,
        featureSubsetStrategy="0.8", seed=SEED, **COLUMNS,
    )


def nearest_neighbours(train: DataFrame) -> Estimator:
    return NearestNeighbours(k=5)


def ada_boost(train: DataFrame) -> Estimator:
    return AdaBoostR2(rounds=50, rate=0.1, depth=3, seed=SEED)


def histogram_boosting(train: DataFrame) -> Estimator:
    """Second-order boosting on binned features, depth 6, l2 of 1.

    A job a level and tree: worth its start-up on large tables, and not among the models that
    are compared by default.
    """
    return HistogramBoosting(rounds=100, depth=6, rate=0.1, l2=1.0)


# Model names.  XGBoost and LightGBM, which are not at hand here,
# are left unavailable rather than passed off as the MLlib variant.
MODELS: dict[str, Callable[[DataFrame], Estimator] | None] = {
    "RandomForest": random_forest,
    "Ridge": ridge,
    "Lasso": lasso,
    "ElasticNet": elastic_net,
    "GradientBoosting": gradient_boosting,
    "ExtraTrees": extra_trees,
    "KNN": nearest_neighbours,
    "AdaBoost": ada_boost,
    "XGBoost": None,
    "LightGBM": None,
    "ColumnSampledBoosting": column_sampled_boosting,
}
