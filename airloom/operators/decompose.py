"""Additive seasonal decomposition of ordered series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.operators.cuts import OWN, ROWS_PER_CUT, arrange
from airloom.operators.ranges import tail
from airloom.operators.windows import centred_trend

PERIOD = 24
TAIL_PERIODS = 10


def decompose(
    df: DataFrame,
    column: str,
    keys: Sequence[str],
    order: Sequence[str],
    period: int = PERIOD,
    whole: bool = False,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Trend, seasonal and residual part per row.

    By default the last ten periods of each series are decomposed; ``whole``
    takes all rows.  Rows without a value are left out, and a series shorter
    than two periods gives no rows.
    """
    source = df.filter(F.col(column).isNotNull())
    bound = None
    if not whole:
        source = tail(source, keys, order, period)
        bound = period * TAIL_PERIODS
    placed = arrange(source, keys, order, rows_per_cut, longest=bound).position("_pos")
    rows = (
        placed.extend(before=period // 2, after=period // 2)
        .withColumn("trend", centred_trend(column, placed, period))
        .filter(OWN)
        .drop(OWN, "_cut")
        .withColumn("_phase", F.col("_pos") % period)
    )
    # One row per series and phase: the means are combined before the shuffle.
    by_series = Window.partitionBy(*(keys or [F.lit(0)]))
    phases = (
        rows.groupBy(*keys, "_phase")
        .agg(
            F.avg(F.col(column) - F.col("trend")).alias("_mean"),
            F.count(F.lit(1)).alias("_n"),
        )
        .withColumn("seasonal", F.col("_mean") - F.avg("_mean").over(by_series))
        .withColumn("_rows", F.sum("_n").over(by_series))
        .filter(F.col("_rows") >= 2 * period)
        .select(*keys, "_phase", "seasonal")
    )
    joined = rows.join(phases, [*keys, "_phase"])
    return joined.withColumn(
        "residual", F.col(column) - F.col("trend") - F.col("seasonal")
    ).drop("_phase", "_pos")


def strengths(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Trend and seasonal strength in [0, 1] and the residual deviation."""

    def strength(component: str):
        noise = F.var_samp("residual")
        return F.greatest(
            F.lit(0.0),
            1 - F.try_divide(noise, F.var_samp(F.col(component) + F.col("residual"))),
        )

    return parts.groupBy(*keys).agg(
        strength("trend").alias("trend_strength"),
        strength("seasonal").alias("seasonal_strength"),
        F.stddev_samp("residual").alias("residual_std"),
    )
