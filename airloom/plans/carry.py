"""Exponential averages that go on from a stored state instead of the whole history.

Beside the observations stands a small table with one row per series and day: how many rows
the day has, and what it leaves behind of the averages. A refresh reads the state before
the first changed day of each series, the rows from that day on, and as many earlier days as
the look-back of lags and windows needs, which the stored row counts tell; both come from
partitions by day, so older days are not scanned. Rows that arrive late reopen their own series
from their own day on, where every later average changes with them; all earlier states stay.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.operators.windows import EMA_SPANS, day_states, ema, newest_rows
from airloom.session import materialise
from airloom.sources.tables import upsert_days

# Days of states that are looked at first; series without one there are looked for further back.
RECENT_DAYS = 7


@dataclass
class Carry:
    """The stored states of one column's averages."""

    path: str
    keys: Sequence[str]
    time: str
    column: str
    spans: Sequence[int] = EMA_SPANS

    def states(self, spark: SparkSession) -> DataFrame | None:
        """All stored states, or None before the first refresh."""
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            return None
        return spark.read.parquet(self.path)

    def before(self, changed: DataFrame) -> DataFrame | None:
        """The state of each changed series (keys, ``_since``) before its first changed day."""
        known = self.states(changed.sparkSession)
        if known is None:
            return None
        keys = list(self.keys)
        oldest = changed.agg(F.min(F.to_date("_since"))).first()[0]
        if oldest is None:
            return None
        payload = F.struct("gap", *[f"mean_{s}" for s in self.spans])

        def newest(states: DataFrame, of: DataFrame) -> DataFrame:
            earlier = states.join(of, keys).filter(F.col("event_date") < F.to_date("_since"))
            return earlier.groupBy(*keys).agg(F.max_by(payload, "event_date").alias("_state"))

        recent = known.filter(F.col("event_date") >= F.lit(oldest - dt.timedelta(days=RECENT_DAYS)))
        found = newest(recent, changed)
        rest = changed.join(found, keys, "left_anti")
        if not rest.isEmpty():
            found = found.unionByName(newest(known, rest))
        return found.select(*keys, "_state.*")

    def first_day(self, changed: DataFrame, rows: int) -> dt.date | None:
        """The oldest day that holds one of the last ``rows`` rows before a series' first change."""
        known = self.states(changed.sparkSession)
        if known is None:
            return None
        keys = list(self.keys)
        back = Window.partitionBy(*keys).orderBy(F.desc("event_date")).rowsBetween(Window.unboundedPreceding, -1)
        needed = (
            known.select(*keys, "event_date", "n").join(changed, keys)
            .filter(F.col("event_date") < F.to_date("_since"))
            .withColumn("_later", F.coalesce(F.sum("n").over(back), F.lit(0))).filter(F.col("_later") < rows)
        )
        since = changed.select(F.to_date("_since").alias("event_date"))
        return needed.select("event_date").union(since).agg(F.min("event_date")).first()[0]

    def average(self, rows: DataFrame, state: DataFrame | None, longest: int | None = None) -> DataFrame:
        """``rows`` (from the start of each series' first changed day on) with their averages."""
        narrow = rows.select(*self.keys, self.time, F.col(self.column).cast("double").alias(self.column))
        return ema(narrow, self.column, self.keys, [self.time], self.spans, longest=longest, carry=state)

    def store(self, averaged: DataFrame, state: DataFrame | None) -> None:
        """Replace the states of the days of ``averaged``."""
        days = day_states(averaged, self.column, self.keys, self.time, self.spans, state)
        upsert_days(days.drop("event_date"), self.path, [*self.keys, "event_date"], self.time)


def refreshed(
    history: DataFrame, changed: DataFrame, carry: Carry, lookback: int,
    compute: Callable[[DataFrame], DataFrame], longest: int | None = None,
) -> DataFrame:
    """Features of every row from a series' first change (keys, ``_since``) on; stores the states.

    ``history`` is partitioned by ``event_date``. ``compute`` gives the features that look back
    ``lookback`` rows; its exponential averages of the carry's column are replaced by those that
    go on from the stored state.
    """
    keys, time = list(carry.keys), carry.time
    changed = materialise(changed, "changed")
    oldest = changed.agg(F.min(F.to_date("_since"))).first()[0]
    state = carry.before(changed)
    state = state if state is None else materialise(state, "state")
    first = carry.first_day(changed, lookback)
    day = F.col("event_date")
    recent = history if first is None else history.filter(day >= F.lit(first))
    touched = recent.filter(day >= F.lit(oldest)).join(changed, keys).filter(day >= F.to_date("_since"))
    averaged = materialise(carry.average(touched, state, longest), "averages")
    rows = recent.drop("event_date").join(changed, keys)
    before = newest_rows(rows.filter(F.col(time) < F.col("_since")), keys, [time], lookback)
    computed = compute(before.unionByName(rows.filter(F.col(time) >= F.col("_since"))).drop("_since"))
    names = [f"{carry.column}_ema_{s}h" for s in carry.spans]
    out = computed.drop(*names).join(averaged.select(*keys, time, *names), [*keys, time], "left")
    out = out.select(*[c for c in computed.columns if c not in names], *names)
    out = out.join(changed, keys).filter(F.col(time) >= F.col("_since")).drop("_since")
    out = materialise(out.select(*computed.columns, *[n for n in names if n not in computed.columns]), "refreshed")
    carry.store(averaged, state)
    return out
