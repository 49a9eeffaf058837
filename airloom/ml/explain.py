"""Feature attribution: tree importance, exact linear shares, permutation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.ml.prepare import LABEL
from airloom.ml.validate import error_metrics
from airloom.operators.cuts import OWN, ROWS_PER_CUT, arrange

IMPORTANCE_SCHEMA = "model string, feature string, importance double"


def tree_importance(spark, models: Mapping[str, object], features: Sequence[str]) -> DataFrame:
    """Split importance of fitted tree models as (model, feature, importance)."""
    rows = [
        (name, feature, float(value))
        for name, model in models.items()
        for feature, value in zip(features, model.featureImportances.toArray())
    ]
    return spark.createDataFrame(rows, IMPORTANCE_SCHEMA)


def linear_attribution(df: DataFrame, weights: Mapping[str, float], model: str = "linear") -> DataFrame:
    """Mean absolute contribution w * (x - mean) of each column, over all rows."""
    means = df.agg(*[F.avg(c).alias(c) for c in weights]).first()
    wide = df.agg(
        *[F.avg(F.abs((F.col(c) - F.lit(means[c])) * w)).alias(c) for c, w in weights.items()]
    )
    return wide.select(
        F.lit(model).alias("model"),
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance"))
                    for c in weights
                ]
            )
        ),
    )


def mean_absolute(long: DataFrame, contribution: str = "contribution") -> DataFrame:
    return long.groupBy("model", "feature").agg(
        F.avg(F.abs(F.col(contribution))).alias("importance")
    )


def permuted_columns(
    df: DataFrame, features: Sequence[str], key: str, seed: int = 42,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Beside each feature the value of another row, ``_other_<feature>``.

    Rows are put in the order of a hash of seed and key, and every row takes its successor's
    values; the last one takes the first one's.  That is a permutation without a local sort
    of everything.
    """
    mixed = df.withColumn("_mix", F.md5(F.concat_ws(":", F.lit(seed), F.col(key)).cast("binary")))
    arranged = arrange(mixed, [], ["_mix", key], rows_per_cut)
    first = arranged.rows.agg(
        F.min_by(F.struct(*features), F.struct("_mix", key)).alias("_first")
    ).first()["_first"]
    w = arranged.window()
    rows = arranged.extend(after=1).select(
        "*", F.lead(F.struct(*features)).over(w).alias("_next")
    )
    last = F.col("_next").isNull()
    return rows.filter(OWN).select(
        *df.columns,
        *[
            F.when(last, F.lit(first[c])).otherwise(F.col("_next")[c]).alias(f"_other_{c}")
            for c in features
        ],
    )


def swapped_rows(rows: DataFrame, features: Sequence[str], label: str = LABEL) -> DataFrame:
    """Each row as it is (``feature`` NULL) and once per feature with that one's other value."""
    versions = [F.struct(F.lit(None).cast("string").alias("feature"), *[F.col(c) for c in features])]
    versions += [
        F.struct(F.lit(one).alias("feature"), *[F.col(f"_other_{c}" if c == one else c).alias(c) for c in features])
        for one in features
    ]
    return rows.select(label, F.explode(F.array(*versions)).alias("_row")).select(label, "_row.*")


def permutation_importance(
    df: DataFrame, fitted, features: Sequence[str], key: str, model: str, seed: int = 42
) -> DataFrame:
    """Increase of the RMSE when one feature's values are permuted.

    Every row is scored with each feature swapped in turn, in one job; the errors are one
    aggregate by feature.
    """
    rows = permuted_columns(df, features, key, seed)
    errors = error_metrics(fitted.transform(swapped_rows(rows, features)), ["feature"]).select("feature", "rmse")
    base = errors.filter("feature IS NULL").select(F.col("rmse").alias("base"))
    worse = errors.filter("feature IS NOT NULL").crossJoin(F.broadcast(base))  # one row
    return worse.select(
        F.lit(model).alias("model"), "feature", (F.col("rmse") - F.col("base")).alias("importance")
    )
