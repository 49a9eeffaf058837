"""Source merge, as-of join, de-duplication and median fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.operators.cuts import ROWS_PER_CUT, arrange
from airloom.operators.windows import latest


def merge_sources(
    first: DataFrame, second: DataFrame, keys: Sequence[str], null_overwrites: bool = False
) -> DataFrame:
    """Outer merge by key in which the second source takes precedence.

    With ``null_overwrites`` a column the second source has replaces the first
    source's even by NULL, wherever the second has a row.
    """
    shared = [c for c in first.columns if c in second.columns and c not in keys]
    there = second.withColumn("_there", F.lit(True))
    joined = first.alias("a").join(there.alias("b"), list(keys), "full")

    def merged(name: str) -> Column:
        mine, theirs = F.col(f"a.{name}"), F.col(f"b.{name}")
        if null_overwrites:
            return F.when(F.col("_there"), theirs).otherwise(mine)
        return F.coalesce(theirs, mine)

    columns = [
        *keys,
        *[merged(c).alias(c) if c in shared else F.col(c) for c in first.columns if c not in keys],
        *[F.col(c) for c in second.columns if c not in keys and c not in shared],
    ]
    return joined.select(*columns)


def snapshot(merged: DataFrame, location: Mapping[str, object], weather: Sequence[str], aqi: Sequence[str]) -> DataFrame:
    """Combined record: location, weather and target structs, time of the merge."""
    place = F.struct(*[F.lit(v).alias(k) for k, v in location.items()])
    return merged.select(
        place.alias("location"),
        F.struct(*weather).alias("weather"),
        F.struct(*aqi).alias("aqi"),
        F.current_timestamp().alias("fetched_at"),
    )


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the newest by ``order``; copies collapse before the shuffle."""
    return latest(df, keys, order)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: Sequence[str],
    left_id: str,
    right_id: str,
    rows_per_cut: int = ROWS_PER_CUT,
) -> DataFrame:
    """Each left row with the last right row of its key at or before its time.

    Both sides become one ordered series in which right rows come first on a
    tie; the ids make the order total.  One shuffle, no pairs.  A row with a NULL
    key has no match.
    """
    packed = F.struct(*values)
    payload = [c for c in left.columns if c not in (*keys, time)]
    marked_left = left.select(
        *keys, time, F.lit(1).alias("_side"), F.col(left_id).alias("_id"),
        F.struct(*payload).alias("_left"), F.lit(None).alias("_right"),
    )
    marked_right = right.select(
        *keys, time, F.lit(0).alias("_side"), F.col(right_id).alias("_id"),
        F.lit(None).alias("_left"), packed.alias("_right"),
    )
    both = marked_left.unionByName(marked_right)
    known = arrange(both, keys, [time, "_side", "_id"], rows_per_cut).last_known(
        "_right", "_match"
    )
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    match = F.when(named, F.col("_match"))
    return known.rows.filter("_side = 1").select(
        *keys, time, "_left.*", *[match[v].alias(v) for v in values]
    )


def apply_reading(history: DataFrame, reading: DataFrame) -> DataFrame:
    """One current reading beside every history row.

    The reading is a single row, which enters the plan as literals; nothing is
    joined.  Without a row the columns are NULL, several are refused.  For a
    reading per time see ``asof_join``.
    """
    rows = reading.limit(2).collect()
    if len(rows) > 1:
        raise ValueError("apply_reading needs one current reading, there are several")
    row = rows[0] if rows else dict.fromkeys(reading.columns)
    return history.withColumns(
        {f.name: F.lit(row[f.name]).cast(f.dataType) for f in reading.schema.fields}
    )


def fill_missing(df: DataFrame, stand_ins: Mapping[str, float]) -> DataFrame:
    """Missing values by the column's stand-in (its median), else by zero."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(0.0 if v is None else float(v)))
            for c, v in stand_ins.items()
        }
    )


def first_present(df: DataFrame, *names: str, default: object) -> Column:
    """First of the named columns the frame has and that is not NULL."""
    return F.coalesce(*[F.col(n) for n in names if n in df.columns], F.lit(default))
