"""Matrix preparation: finite values, median fill, scaling, assembly."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.operators.quantiles import medians
from airloom.schemas import finite

FEATURES = "features"
LABEL = "label"


def labelled(df: DataFrame, target: str, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows with a target; features as finite doubles, infinities as NULL."""
    return df.filter(F.col(target).isNotNull()).select(
        *keep,
        F.col(target).cast("double").alias(LABEL),
        *[finite(F.col(c).cast("double")).alias(c) for c in features],
    )


def column_medians(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without values is filled with zero."""
    return {c: 0.0 if m is None else m for c, m in medians(df, features).items()}


def scaling(df: DataFrame, fill: dict[str, float]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of each filled column; no spread scales by 1."""
    filled = {c: F.coalesce(F.col(c), F.lit(m)) for c, m in fill.items()}
    row = df.agg(
        *[F.avg(x).alias(f"{c}_mean") for c, x in filled.items()],
        *[F.stddev_pop(x).alias(f"{c}_std") for c, x in filled.items()],
    ).first()
    # Spread at the level of rounding noise counts as none.
    return {
        c: (
            row[f"{c}_mean"],
            row[f"{c}_std"] if row[f"{c}_std"] > 1e-12 * abs(row[f"{c}_mean"]) else 1.0,
        )
        for c in fill
    }


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with mean 0 and population deviation 1."""
    scale = scaling(df, {c: None for c in columns})
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in scale.items()})


def _number(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def matrix_stages(fill: dict[str, float], scale: dict[str, tuple[float, float]] | None) -> list:
    """Stages from cleaned columns to the feature vector; they save with the model."""
    scaled = []
    for c, m in fill.items():
        x = f"coalesce(`{c}`, {_number(m)})"
        if scale is not None:
            mean, deviation = scale[c]
            x = f"({x} - {_number(mean)}) / {_number(deviation)}"
        scaled.append(f"{x} AS `_x_{c}`")
    return [
        SQLTransformer(statement=f"SELECT *, {', '.join(scaled)} FROM __THIS__"),
        VectorAssembler(inputCols=[f"_x_{c}" for c in fill], outputCol=FEATURES),
        SQLTransformer(
            statement=f"SELECT * EXCEPT ({', '.join(f'`_x_{c}`' for c in fill)}) FROM __THIS__"
        ),
    ]


def scaled_pipeline(train: DataFrame, fill: dict[str, float], estimator: Estimator) -> Pipeline:
    return Pipeline(stages=[*matrix_stages(fill, scaling(train, fill)), estimator])


def label_spread(train: DataFrame) -> tuple[int, float]:
    """Row count and population deviation of the label."""
    row = train.agg(F.count(LABEL).alias("n"), F.stddev_pop(LABEL).alias("sd")).first()
    spread = row["sd"] or 0.0
    return row["n"], spread if math.isfinite(spread) and spread > 0 else 1.0
