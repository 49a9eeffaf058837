"""Ordered series that stay parallel when one series holds most of the rows.

``Window.partitionBy(key)`` puts a whole key into one task.  ``arrange`` first
measures the longest series (one map-side combined count).  If it fits in
``rows_per_cut`` the plain window is used.  Otherwise the rows are range
partitioned on (key, order), which cuts a long series into pieces of similar
length whatever the key or time skew, and the piece number is stored with the
rows.  Three exact tools then replace the unbounded window:

* ``extend``   copies the few boundary rows a row-count frame needs into the
  neighbouring piece;
* ``position`` adds the rows of the earlier pieces to a local row number;
* ``last_known`` hands the last non-NULL value on to the later pieces.

``order`` must identify a row within its series (time plus a unique tiebreak).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from airloom.session import materialise

ROWS_PER_CUT = 1_000_000
# A series on an hourly grid has one row per hour: a century is 876,600 rows.
HOURLY_GRID_ROWS = 876_600
# The piece table has at most two rows per cut boundary; up to this many rows
# it is broadcast, beyond it Spark picks the join.
BROADCAST_PIECES = 200_000

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
CUT = "_cut"
OWN = "_own"


def allow_group_limit(spark: SparkSession, rows: int) -> None:
    """Let a row-number limit of this size run ahead of the shuffle.

    Spark does so up to a threshold (1000 by default), which is raised here.
    """
    if int(spark.conf.get(GROUP_LIMIT)) < rows:
        spark.conf.set(GROUP_LIMIT, str(rows))


@dataclass(frozen=True)
class Arranged:
    rows: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    cuts: int
    longest: int  # no series has more rows

    @property
    def group(self) -> list[str]:
        return [*self.keys, CUT] if self.cuts > 1 else list(self.keys)

    def window(self, *more: Column | str) -> WindowSpec:
        """Rows of one series (or one piece of it) in order."""
        columns = [*self.group, *more] or [F.lit(0)]
        return Window.partitionBy(*columns).orderBy(*self.order)

    def replace(self, rows: DataFrame) -> "Arranged":
        return Arranged(rows, self.keys, self.order, self.cuts, self.longest)

    def _small(self, pieces: DataFrame) -> DataFrame:
        return F.broadcast(pieces) if 2 * self.cuts <= BROADCAST_PIECES else pieces

    def _by_key(self) -> WindowSpec:
        return Window.partitionBy(*(self.keys or [F.lit(0)]))

    def _pieces(self, rows: DataFrame) -> DataFrame:
        """Start and end offset of every piece of a series spanning several cuts."""
        ordered = self._by_key().orderBy(CUT)
        counted = rows.groupBy(*self.group).agg(F.count(F.lit(1)).alias("_n"))
        return (
            counted.withColumn("_parts", F.count(F.lit(1)).over(self._by_key()))
            .filter("_parts > 1")
            .withColumn("_end", F.sum("_n").over(ordered))
            .withColumn("_start", F.col("_end") - F.col("_n"))
            .drop("_parts", "_n")
        )

    def extend(self, before: int = 0, after: int = 0) -> DataFrame:
        """Rows plus, per piece, ``before`` earlier and ``after`` later rows.

        Own rows have ``_own`` true; filter on it once the windows are computed.
        """
        out = self.rows.withColumn(OWN, F.lit(True))
        if self.cuts <= 1:
            return out
        if before > 0:
            out = out.unionByName(self._earlier(self.rows, before))
        if after > 0:
            out = out.unionByName(self._later(self.rows, after))
        return out

    def _earlier(self, source: DataFrame, before: int) -> DataFrame:
        """The last ``before`` rows ahead of each piece, labelled with that piece."""
        targets = self._neighbours(
            source,
            F.lead(CUT).over(self._by_key().orderBy(CUT)),
            "_end",
            self._by_key().orderBy("_end").rangeBetween(0, before - 1),
        )
        newest_first = [F.col(c).desc() for c in self.order]
        reach = F.lit(before) - (F.col("_target.edge") - F.col("_end"))
        return self._copies(source, targets, newest_first, before, reach)

    def _later(self, source: DataFrame, after: int) -> DataFrame:
        """The first ``after`` rows behind each piece, labelled with that piece."""
        targets = self._neighbours(
            source,
            F.lag(CUT).over(self._by_key().orderBy(CUT)),
            "_start",
            self._by_key().orderBy("_start").rangeBetween(-(after - 1), 0),
        )
        oldest_first = [F.col(c).asc() for c in self.order]
        reach = F.lit(after) - (F.col("_start") - F.col("_target.edge"))
        return self._copies(source, targets, oldest_first, after, reach)

    def _neighbours(
        self, source: DataFrame, adjacent: Column, edge: str, near: WindowSpec
    ) -> DataFrame:
        """Per piece the pieces near enough to need some of its rows.

        Pieces are far longer than a frame, so this is one neighbour as a rule;
        short pieces reach further.
        """
        entry = F.when(
            F.col("_adjacent").isNotNull(),
            F.struct(F.col("_adjacent").alias("cut"), F.col(edge).alias("edge")),
        )
        return (
            self._pieces(source)
            .withColumn("_adjacent", adjacent)
            .withColumn("_targets", F.collect_list(entry).over(near))
        )

    def _copies(self, source, targets, rank_order, depth, reach) -> DataFrame:
        allow_group_limit(source.sparkSession, depth)
        targets = targets.filter(F.size("_targets") > 0).select(
            *self.group, "_start", "_end", "_targets"
        )
        nearest = (
            source.join(self._small(targets), self.group)
            .withColumn(
                "_rank",
                F.row_number().over(Window.partitionBy(*self.group).orderBy(*rank_order)),
            )
            .filter(F.col("_rank") <= depth)
        )
        return (
            nearest.withColumn("_target", F.explode("_targets"))
            .filter(F.col("_rank") <= reach)
            .withColumn(CUT, F.col("_target.cut"))
            .withColumn(OWN, F.lit(False))
            .select(*source.columns, OWN)
        )

    def position(self, name: str) -> "Arranged":
        """0-based row position in the whole series."""
        local = F.row_number().over(self.window()).cast("bigint") - 1
        rows = self.rows.withColumn(name, local)
        if self.cuts > 1:
            starts = self._pieces(self.rows).select(*self.group, "_start")
            rows = (
                rows.join(self._small(starts), self.group, "left")
                .withColumn(name, F.col(name) + F.coalesce("_start", F.lit(0)))
                .drop("_start")
            )
        return self.replace(rows)

    def last_known(self, value: str, name: str) -> "Arranged":
        """Last non-NULL ``value`` at or before each row."""
        so_far = self.window().rowsBetween(Window.unboundedPreceding, 0)
        rows = self.rows.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
        if self.cuts > 1:
            earlier = (
                self._by_key().orderBy(CUT).rowsBetween(Window.unboundedPreceding, -1)
            )
            ends = (
                self.rows.groupBy(*self.group)
                .agg(
                    F.max_by(
                        value, F.when(F.col(value).isNotNull(), F.struct(*self.order))
                    ).alias("_tail")
                )
                .withColumn("_parts", F.count(F.lit(1)).over(self._by_key()))
                .filter("_parts > 1")
                .withColumn("_carry", F.last("_tail", ignorenulls=True).over(earlier))
                .select(*self.group, "_carry")
            )
            rows = (
                rows.join(self._small(ends), self.group, "left")
                .withColumn(name, F.coalesce(name, "_carry"))
                .drop("_carry")
            )
        return self.replace(rows)


def arrange(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_cut: int = ROWS_PER_CUT,
    longest: int | None = None,
) -> Arranged:
    """Prepare ``df`` for ordered work per series.

    ``longest`` is a bound on the rows of one series where the caller can prove
    one (an hourly grid has ``HOURLY_GRID_ROWS``); it saves the counting job.
    """
    keys, order = tuple(keys), tuple(order)
    if longest is not None and longest <= rows_per_cut:
        return Arranged(df, keys, order, 1, longest)
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    size = per_key.agg(F.max("n").alias("longest"), F.sum("n").alias("total")).first()
    longest = size["longest"] or 0
    if longest <= rows_per_cut:
        return Arranged(df, keys, order, 1, longest)
    cuts = math.ceil(size["total"] / rows_per_cut)
    ranged = df.repartitionByRange(cuts, *keys, *order).withColumn(
        CUT, F.spark_partition_id()
    )
    return Arranged(materialise(ranged, "series"), keys, order, cuts, longest)
