"""Exact quantiles of whole columns with bounded memory, in two scans.

``percentile`` keeps every distinct value of a column in one task. Here it is given the column
clipped to a narrow bracket around each wanted rank: values below the bracket count as its
lower end, those above as its upper end, so ranks stay what they are and only the distinct
values inside are kept. The brackets come from one aggregate of mergeable quantile sketches
over all columns. The scan that takes the percentiles also counts the rows on both sides, which
proves that each bracket holds its rank; one that does not is made wider and taken again.

A column of at most ``direct_rows`` rows is not clipped. Where a bracket would hold more than
``direct_rows`` rows, it is sketched again within itself, two scans for each factor of
``accuracy`` / 4. Both ways give what ``percentile`` gives: NaN is the largest value, missing values are
left out, and values between two ranks are interpolated.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

DIRECT_ROWS = 1_000_000
# Relative rank error of a sketch is one in this.
ACCURACY = 10_000
INFINITY, NAN = math.inf, math.nan
LARGEST = 1.7976931348623157e308


@dataclass
class _Bracket:
    """Values among which the rank of one probability lies, ends included."""

    low: float = -INFINITY
    high: float = NAN
    slack: float = 0.0  # share of the ranks on either side that is allowed for
    inside: int = 0  # rows that may lie within

    def clip(self, x: Column) -> Column:
        if self.low == -INFINITY and math.isnan(self.high):
            return x
        return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(self.low)), F.lit(self.high)))

    def holds(self, x: Column) -> Column:
        return (x >= F.lit(self.low)) & (x <= F.lit(self.high))


def _finite(x: Column) -> Column:
    """In the order of the values, without what a sketch cannot rank."""
    return F.when(F.isnan(x) | (x == F.lit(INFINITY)), F.lit(LARGEST)).when(
        x == F.lit(-INFINITY), F.lit(-LARGEST)
    ).otherwise(x)


def _ends(low: float, high: float) -> tuple[float, float]:
    """What lies at the ends of the finite values may be infinite or no number."""
    return (-INFINITY if low <= -LARGEST else low), (NAN if high >= LARGEST else high)


def _ranks(p: float, n: int) -> tuple[int, int]:
    at = p * (n - 1)
    return max(0, math.floor(at) - 1), min(n - 1, math.ceil(at) + 1)


def _sketched(
    numbers: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int, slack: float
) -> tuple[dict[str, int], dict[tuple[str, float], _Bracket]]:
    """Rows of each column and a bracket for each probability: one scan."""
    wanted = F.array(*[F.lit(min(1.0, max(0.0, q))) for p in probabilities for q in (p - slack, p + slack)])
    row = numbers.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(_finite(F.col(c)), wanted, accuracy).alias(f"q{i}") for i, c in enumerate(columns)],
    ).first()
    sizes, brackets = {}, {}
    for i, c in enumerate(columns):
        sizes[c] = row[f"n{i}"]
        for k, p in enumerate(probabilities):
            if sizes[c]:
                low, high = _ends(*row[f"q{i}"][2 * k : 2 * k + 2])
                brackets[c, p] = _Bracket(low, high, slack, math.ceil(4 * slack * sizes[c]))
    return sizes, brackets


def _counted(x: Column, b: _Bracket) -> list[Column]:
    """Rows below the bracket and rows up to its end."""
    return [F.count_if(x < F.lit(b.low)), F.count_if(x <= F.lit(b.high))]


def _narrower(numbers: DataFrame, sizes, brackets: dict, accuracy: int) -> bool:
    """Sketch the brackets within themselves: two scans. False if none became narrower."""
    keys = list(brackets)
    row = numbers.agg(
        *[x.alias(f"{side}{i}") for i, key in enumerate(keys)
          for side, x in zip("ab", _counted(F.col(key[0]), brackets[key]), strict=True)]
    ).first()
    step, sketches = 2 / accuracy, []
    for i, (c, p) in enumerate(keys):
        below, inside = row[f"a{i}"], row[f"b{i}"] - row[f"a{i}"]
        low, high = ((rank - below) / max(1, inside) for rank in _ranks(p, sizes[c]))
        ends = F.array(*[F.lit(min(1.0, max(0.0, q))) for q in (low - step, high + step)])
        held = F.when(brackets[c, p].holds(F.col(c)), _finite(F.col(c)))
        sketches.append(F.percentile_approx(held, ends, accuracy).alias(f"q{i}"))
        brackets[c, p].inside = math.ceil(4 * step * inside) + 1
    row, changed = numbers.agg(*sketches).first(), False
    for i, key in enumerate(keys):
        if row[f"q{i}"] is None:
            continue
        b = brackets[key]
        low, high = _ends(*row[f"q{i}"])
        moved = low > b.low or high < b.high or (math.isnan(b.high) and not math.isnan(high))
        changed |= moved
        if moved:
            b.low = max(b.low, low)
            b.high = high if math.isnan(b.high) or high < b.high else b.high
    return changed


def quantiles_with(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], wanted: Sequence[Column] = (),
    direct_rows: int = DIRECT_ROWS, accuracy: int = ACCURACY,
) -> tuple[dict[str, list[float | None]], Row]:
    """Linearly interpolated quantiles per column, and a row of the ``wanted`` aggregates of ``df``.

    The wanted aggregates, by names of their own, are taken in the quantiles' last scan.
    """
    inner = [f"_quantile_{i}" for i in range(len(columns))]
    numbers = df.select("*", *[F.col(f"`{c}`").cast("double").alias(x) for c, x in zip(columns, inner, strict=True)])
    slack = 2 / accuracy
    if not columns:
        return {}, numbers.agg(F.count(F.lit(1)).alias("_rows"), *wanted).first()
    sizes, brackets = _sketched(numbers, inner, probabilities, accuracy, slack)
    open_ = set(brackets)
    for key in brackets:
        if sizes[key[0]] <= direct_rows:
            brackets[key] = _Bracket()
    while True:
        wide = {k: b for k, b in brackets.items() if b.inside > direct_rows}
        while wide and _narrower(numbers, sizes, wide, accuracy):
            wide = {k: b for k, b in wide.items() if b.inside > direct_rows}
        exprs, checks = [], []
        together = {
            c: [p for x, p in sorted(open_) if x == c and not brackets[c, p].slack] for c in inner
        }
        # The ranks of a column that is not clipped share one map of its values.
        exprs += [
            F.percentile(F.col(c), F.array(*[F.lit(float(p)) for p in ps])).alias(f"_all{c}")
            for c, ps in together.items() if ps
        ]
        for i, (c, p) in enumerate(sorted(open_)):
            if brackets[c, p].slack:
                exprs.append(F.percentile(brackets[c, p].clip(F.col(c)), F.lit(float(p))).alias(f"_p{i}"))
            if brackets[c, p].slack:
                below, up_to = _counted(F.col(c), brackets[c, p])
                checks += [below.alias(f"_a{i}"), up_to.alias(f"_b{i}")]
        row = numbers.agg(F.count(F.lit(1)).alias("_rows"), *exprs, *checks, *wanted).first()
        found = {
            (c, p): row[f"_p{i}"] if brackets[c, p].slack else row[f"_all{c}"][together[c].index(p)]
            for i, (c, p) in enumerate(sorted(open_))
        }
        missed = []
        for i, (c, p) in enumerate(sorted(open_)):
            at = p * (sizes[c] - 1)
            if brackets[c, p].slack and not (row[f"_a{i}"] <= math.floor(at) and row[f"_b{i}"] > math.ceil(at)):
                missed.append((c, p))
        if not missed:
            return {
                c: [found.get((x, p)) for p in probabilities] for c, x in zip(columns, inner, strict=True)
            }, row
        # A sketch was further off than it promises: all brackets again, twice as wide.
        slack *= 2
        _, again = _sketched(numbers, inner, probabilities, accuracy, slack)
        for key in missed:
            brackets[key] = again[key] if slack < 0.5 else _Bracket()


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
    direct_rows: int = DIRECT_ROWS, accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; missing values are left out, NaN is largest."""
    return quantiles_with(df, columns, probabilities, (), direct_rows, accuracy)[0]


def medians(df: DataFrame, columns: Sequence[str], **limits) -> dict[str, float | None]:
    """Exact median per column, NULL for a column without values."""
    return {c: q[0] for c, q in quantiles(df, columns, [0.5], **limits).items()}
