"""Profiling: overview, missing values, distribution, correlation, trend line."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.bands import shape_labels
from airloom.functions.calendar import WEEKDAY_NAMES
from airloom.operators.quantiles import quantiles, quantiles_with

HISTOGRAM_BINS = 50
QUARTILES = (0.25, 0.5, 0.75)


def numeric_columns(df: DataFrame, leave_out: Sequence[str] = ("datetime", "Unnamed: 0")) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in leave_out
    ]


def overview(df: DataFrame, time: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    ).withColumn("features", F.lit(len(df.columns)))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Missing values per column, one pass over the data."""
    columns = list(columns or df.columns)
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return wide.unpivot(["_rows"], columns, "column_name", "missing_count").select(
        "column_name",
        "missing_count",
        F.try_divide(F.col("missing_count") * 100.0, F.col("_rows")).alias("missing_pct"),
        F.col("_rows").alias("total_rows"),
    )


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values, most missing first."""
    return (
        missing_counts(df, columns)
        .filter("missing_count > 0")
        .drop("total_rows")
        .orderBy(F.desc("missing_count"), "column_name")
    )


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cells = F.sum("total_rows")
    missing = F.sum("missing_count")
    return missing_counts(df, columns).agg(
        F.max("total_rows").alias("total_records"),
        F.count(F.lit(1)).alias("total_features"),
        (F.try_divide(cells - missing, cells) * 100.0).alias("completeness_pct"),
    )


DESCRIPTION = "column_name string, count long, mean double, std double, min double, q25 double, median double, q75 double, max double"


def describe(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    Everything but the quartiles' brackets is one aggregate, whose one row is laid out here.
    """
    wanted = []
    for i, name in enumerate(columns):
        x = F.col(f"`{name}`")
        number = x.cast("double")
        wanted += [
            F.count(x).alias(f"n{i}"), F.avg(x).cast("double").alias(f"mean{i}"), F.stddev_samp(x).alias(f"std{i}"),
            F.min(number).alias(f"min{i}"), F.max(number).alias(f"max{i}"),
        ]
    quarter, row = quantiles_with(df, columns, QUARTILES, wanted, **limits)
    rows = [
        (name, row[f"n{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], *quarter[name], row[f"max{i}"])
        for i, name in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(rows, DESCRIPTION)


def shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population skewness and excess kurtosis with their interpretation."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.skewness(c).alias("skewness"),
                F.kurtosis(c).alias("kurtosis"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = wide.select(F.inline(F.array(*[F.col(c) for c in columns])))
    skew, tails = shape_labels(F.col("skewness"), F.col("kurtosis"))
    return rows.select("*", skew.alias("skew_label"), tails.alias("tail_label"))


PAIR_SUMS = "x int, y int, n long, sx double, sy double, xx double, yy double, xy double, lx double, hx double, ly double, hy double"


def pair_sums(numbers: DataFrame, centre: Sequence[float]) -> DataFrame:
    """Sums over the rows in which both columns of a pair (x <= y, by number) are present.

    A task holds its matrices of counts, sums and products of deviations from ``centre`` and
    adds every batch to them by matrix products of (present, deviation); at its end it gives
    one row a pair. What is planned does not depend on the number of pairs.
    """
    middle, width = np.array(centre, float), len(centre)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares, products = (np.zeros((width, width)) for _ in range(4))
        low, high = np.full((width, width), np.inf), np.full((width, width), -np.inf)
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            there = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            present, off = there.astype(float), np.where(there, raw - middle, 0.0)
            n += present.T @ present
            sums += off.T @ present
            squares += (off * off).T @ present
            products += off.T @ off
            # Extremes of x where y is present: once for each way of being present.
            ways, which = np.unique(there, axis=1, return_inverse=True)
            for k in range(ways.shape[1]):
                rows = ways[:, k]
                if rows.any():
                    of = np.flatnonzero(which == k)
                    part, ok = raw[rows], there[rows]
                    low[:, of] = np.minimum(low[:, of], np.where(ok, part, np.inf).min(axis=0)[:, None])
                    high[:, of] = np.maximum(high[:, of], np.where(ok, part, -np.inf).max(axis=0)[:, None])
        x, y = np.triu_indices(width)
        columns = [
            pa.array(x, pa.int32()), pa.array(y, pa.int32()), pa.array(n[x, y].astype(np.int64)),
            *(pa.array(m) for m in (
                sums[x, y], sums[y, x], squares[x, y], squares[y, x], products[x, y],
                low[x, y], high[x, y], low[y, x], high[y, x],
            )),
        ]
        yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PAIR_SUMS.split(", ")])

    return numbers.mapInArrow(run, PAIR_SUMS)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson correlations (x, y, r), both triangles.

    A first pass finds the mean of every column, the second the sums of products of
    deviations from the means, so nothing cancels (see ``pair_sums``). A column that is
    constant over a pair's rows has no correlation. NaN and infinities of a pair give NULL.
    """
    if not columns:
        raise ValueError("a correlation matrix needs columns")
    c = F.col
    numbers = df.select(*[c(f"`{name}`").cast("double").alias(name) for name in columns])
    means = numbers.agg(*[F.avg(f"`{name}`").alias(f"m{i}") for i, name in enumerate(columns)]).first()
    centre = [m if m is not None and math.isfinite(m) else 0.0 for m in means]
    together = [F.sum(name).alias(name) for name in ("n", "sx", "sy", "xx", "yy", "xy")]
    together += [F.min(name).alias(name) for name in ("lx", "ly")] + [F.max(name).alias(name) for name in ("hx", "hy")]
    sums = pair_sums(numbers, centre).groupBy("x", "y").agg(*together)
    spread = F.sqrt(F.greatest(c("xx") - c("sx") * c("sx") / c("n"), F.lit(0.0))) * F.sqrt(
        F.greatest(c("yy") - c("sy") * c("sy") / c("n"), F.lit(0.0))
    )
    r = F.when(c("x") == c("y"), 1.0).when(
        spread > 0, F.least(F.lit(1.0), F.greatest(F.lit(-1.0), (c("xy") - c("sx") * c("sy") / c("n")) / spread))
    )
    varied = (c("n") > 0) & (c("lx") < c("hx")) & (c("ly") < c("hy")) & (F.abs("xx") + F.abs("yy") < F.lit(math.inf))
    names = F.array(*[F.lit(name) for name in columns])
    cells = sums.select("x", "y", F.when(varied, r).alias("r"))
    both = F.array(F.struct("x", "y"), F.struct(c("y").alias("x"), c("x").alias("y")))
    ways = F.when(c("x") == c("y"), F.slice(both, 1, 1)).otherwise(both)
    return cells.select(F.explode(ways).alias("way"), "r").select(
        F.get(names, "way.x").alias("x"), F.get(names, "way.y").alias("y"), "r"
    )


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Counts per equal-width bin; the largest value falls in the last bin."""
    x = F.col(column).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.select(F.lit(1).alias("bin"), x.alias("lower"), x.alias("upper"),
                         F.lit(0).cast("bigint").alias("n")).limit(0)
    width = (high - low) / bins
    slot = F.lit(1)
    if high > low:
        slot = F.least(F.width_bucket(x, F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return (
        df.filter(x.isNotNull())
        .groupBy(slot.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.lit(low) + width * (F.col("bin") - 1)).alias("lower"),
            (F.lit(low) + width * F.col("bin")).alias("upper"),
            "n",
        )
    )


def box_stats(df: DataFrame, columns: Sequence[str], **limits) -> DataFrame:
    """Quartiles, whiskers (last values inside 1.5 IQR) and outlier counts."""
    quarter = quantiles(df, columns, QUARTILES, **limits)
    parts = []
    for c in columns:
        q1, median, q3 = quarter[c]
        low = None if q1 is None else q1 - 1.5 * (q3 - q1)
        high = None if q1 is None else q3 + 1.5 * (q3 - q1)
        x = F.col(c).cast("double")
        inside = F.when(x.between(F.lit(low), F.lit(high)), x)
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(q1).cast("double").alias("q1"),
                F.lit(median).cast("double").alias("median"),
                F.lit(q3).cast("double").alias("q3"),
                F.min(inside).alias("lower_whisker"),
                F.max(inside).alias("upper_whisker"),
                F.count_if((x < F.lit(low)) | (x > F.lit(high))).alias("outliers"),
            ).alias(c)
        )
    return df.agg(*parts).select(F.inline(F.array(*[F.col(c) for c in columns])))


def outliers(df: DataFrame, column: str, **limits) -> DataFrame:
    q1, _, q3 = quantiles(df, [column], QUARTILES, **limits)[column]
    if q1 is None:
        return df.filter(F.lit(False))
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def ols_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``; NULL slope for a constant ``x``."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("n"),
    )


def mean_by(df: DataFrame, value: str, part: Column, name: str) -> DataFrame:
    return df.groupBy(part.alias(name)).agg(F.avg(value).alias(f"mean_{value}"))


def hourly_mean(df: DataFrame, time: str, value: str) -> DataFrame:
    return mean_by(df, value, F.hour(time), "hour")


def monthly_mean(df: DataFrame, time: str, value: str) -> DataFrame:
    return mean_by(df, value, F.month(time), "month")


def weekday_mean(df: DataFrame, time: str, value: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    means = mean_by(df, value, F.weekday(time), "day_of_week")
    return means.withColumn("day_name", F.get(names, F.col("day_of_week")))


def target_stats(df: DataFrame, target: str) -> DataFrame:
    return df.agg(
        F.count(target).alias("n"),
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
    )
