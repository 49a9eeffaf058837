"""Features of a stream: recomputed per batch with look-back, or kept as state."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from airloom.operators.windows import newest_rows
from airloom.plans.carry import Carry, refreshed
from airloom.session import materialise
from airloom.sources.tables import upsert_days
from airloom.streaming.ingest import WATERMARK

def incremental_features(
    stream: DataFrame,
    history: str,
    output: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    compute: Callable[[DataFrame], DataFrame],
    lookback: int = 2160,
    lookback_days: int | None = None,
    carry: Carry | None = None,
    averages: Callable[[DataFrame], DataFrame] | None = None,
    unbounded: bool = False,
) -> StreamingQuery:
    """Keep a feature table up to date from an observation stream.

    Each batch is upserted into the ``history`` table.  Features are then
    computed again for every row from the oldest changed time of its series on,
    since later rows look back on the changed ones, with ``lookback`` earlier
    rows as context.  Both tables are keyed upserts, so a repeated batch
    changes nothing.  ``lookback_days`` prunes the history to recent partitions;
    where they hold too few rows of a changed series, the whole history is read.

    Features that look back on every row, such as exponential averages, need one of:
    ``carry``, where the averages of one column are kept as states by day, so that only the days
    looked back on are read; ``averages``, which gives them, with keys and time, from the whole
    history of the changed series; or ``unbounded``, with which ``compute`` gets that history.
    """
    spark = stream.sparkSession

    def run(batch: DataFrame, batch_id: int) -> None:
        fresh = materialise(batch.dropDuplicates([*keys, time]), "batch")
        if fresh.isEmpty():
            return
        upsert_days(fresh, history, [*keys, time], time)
        changed = fresh.groupBy(*keys).agg(F.min(time).alias("_since"))
        whole = spark.read.parquet(history)
        if carry is not None:
            upsert_days(refreshed(whole, changed, carry, lookback, compute), output, [*keys, time], time)
            return
        rows = whole.drop("event_date").join(changed, list(keys))
        earlier = rows.filter(F.col(time) < F.col("_since"))
        after = rows.filter(F.col(time) >= F.col("_since"))
        if lookback_days is not None:
            oldest = fresh.agg(F.min(time)).first()[0]
            limit = F.lit(oldest) - F.make_dt_interval(F.lit(lookback_days))
            recent = whole.filter(F.col("event_date") >= F.to_date(limit)).drop("event_date")
            recent = recent.join(changed, list(keys))
            after = recent.filter(F.col(time) >= F.col("_since"))
            recent = recent.filter(F.col(time) < F.col("_since"))
            enough = recent.groupBy(*keys).count().filter(F.col("count") >= lookback)
            if changed.join(enough, list(keys), "left_anti").isEmpty():
                earlier = recent
        if unbounded:
            computed = compute(rows.drop("_since"))
        else:
            before = newest_rows(earlier, keys, [time], lookback)
            computed = compute(before.unionByName(after).drop("_since"))
        if averages is not None:
            full = averages(rows.drop("_since"))
            names = computed.columns
            own = [c for c in full.columns if c not in (*keys, time)]
            computed = computed.drop(*own).join(full, [*keys, time], "left")
            computed = computed.select(*names, *[c for c in own if c not in names])
        affected = computed.join(changed, list(keys)).filter(F.col(time) >= F.col("_since"))
        upsert_days(affected.drop("_since"), output, [*keys, time], time)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


EMA_STATE = T.StructType(
    [
        T.StructField("mean", T.DoubleType()),
        T.StructField("gap", T.LongType()),
        T.StructField("tail", T.ArrayType(T.DoubleType())),
        T.StructField("times", T.ArrayType(T.LongType())),
        T.StructField("values", T.ArrayType(T.DoubleType())),
    ]
)
# Rows whose weights are taken at once: a square of this many numbers.
CHUNK = 256


def averages_after(mean: float | None, gap: int, x: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Averages after each row of ``x`` (NaN: missing) and the gaps they leave, from a state.

    The step of an observation ``g`` rows after the last one is affine; the average after the
    k-th is the sum of all earlier shares, each faded by the steps in between, so a chunk of
    rows is one product with its matrix of weights.
    """
    out, gaps = np.full(len(x), np.nan), np.zeros(len(x), np.int64)
    at = np.flatnonzero(~np.isnan(x))
    y = np.nan if mean is None else mean
    since = np.diff(at, prepend=-gap)  # ``gap`` rows before the first one here stood the last
    faded = (1.0 - alpha) ** since
    keep, share = faded / (faded + alpha), alpha * x[at] / (faded + alpha)
    if mean is None and len(at):
        keep[0], share[0], y = 0.0, x[at[0]], 0.0
    for i in range(0, len(at), CHUNK):
        logs = np.cumsum(np.log(np.maximum(keep[i : i + CHUNK], 1e-300)))
        weights = np.tril(np.exp(np.minimum(logs[:, None] - logs[None], 0.0)))
        means = weights @ share[i : i + CHUNK] + np.exp(logs) * y
        out[at[i : i + CHUNK]], y = means, means[-1]
    order = np.arange(len(x))
    last = np.maximum.accumulate(np.where(np.isnan(x), -1, order))
    known = last >= 0
    gaps[known] = order[known] - last[known] + 1
    out = np.where(known, out[np.maximum(last, 0)], np.nan if mean is None else mean)
    gaps[~known] = 0 if mean is None else gap + order[~known] + 1
    return out, gaps


def stateful_ema(
    stream: DataFrame, key: str, time: str, value: str, span: int = 24, keep: int = 3,
    delay: str | None = WATERMARK,
) -> DataFrame:
    """EMA and the last ``keep`` values per series, carried from batch to batch.

    The stream has at most one row per series and hour (see ``ingest.dedup``). The rows newer
    than the watermark are kept as state, and what lies before them as one average; a timer
    folds the rows of a series that falls silent. So a row that comes late, but within the
    delay, takes its place in time: it and all rows after it are given out anew, and a
    sink keyed by series and time (``upsert_stream``) ends with the averages of the whole
    series. Rows later than the delay are dropped and counted (``ingest.late_rows``). With
    ``delay`` None the stream brings its own watermark.
    """
    alpha = 2.0 / (span + 1.0)
    output = T.StructType(
        [
            stream.schema[key],
            stream.schema[time],
            T.StructField(value, T.DoubleType()),
            T.StructField(f"{value}_ema_{span}h", T.DoubleType()),
            T.StructField("recent", T.ArrayType(T.DoubleType())),
        ]
    )

    def folded(state: GroupState, mean, gap, tail, times: np.ndarray, x: np.ndarray, count: int) -> None:
        """Keep the state with its first ``count`` rows taken into the average."""
        if count:
            means, gaps = averages_after(mean, gap, x[:count], alpha)
            mean, gap = (None if np.isnan(means[-1]) else float(means[-1])), int(gaps[-1])
            tail = [*tail, *(None if np.isnan(v) else float(v) for v in x[:count])][-keep:]
        rest = [None if np.isnan(v) else float(v) for v in x[count:]]
        state.update((mean, gap, tail, [int(t) for t in times[count:]], rest))
        if len(times) > count:
            state.setTimeoutTimestamp(int(max(times[-1] // 1000 + 1, state.getCurrentWatermarkMs() + 1)))

    def update(group, frames: Iterator[pd.DataFrame], state: GroupState):
        mean, gap, tail, times, values = state.get if state.exists else (None, 0, [], [], [])
        tail = list(tail)
        if state.hasTimedOut:
            folded(state, mean, gap, tail, np.array(times, np.int64), np.array(values, float), len(times))
            return
        batch = pd.concat(list(frames))
        known = dict(zip(times, [np.nan if v is None else v for v in values], strict=True))
        fresh = batch[time].astype("datetime64[us]").astype("int64").to_numpy()
        known.update(zip(fresh.tolist(), batch[value].astype(float).to_numpy().tolist(), strict=True))
        order = np.array(sorted(known), np.int64)
        x = np.array([known[t] for t in order.tolist()], float)
        means, _ = averages_after(mean, gap, x, alpha)
        changed = np.flatnonzero(order >= fresh.min())
        seen = [*([None] * keep), *tail, *(None if np.isnan(v) else v for v in x)]
        shift = len(seen) - len(x)
        first = keep - len(tail) if len(tail) < keep else 0
        recent = [seen[max(shift + i + 1 - keep, keep if first else 0) : shift + i + 1] for i in changed]
        state_rows = int(np.searchsorted(order // 1000, state.getCurrentWatermarkMs(), side="left"))
        folded(state, mean, gap, tail, order, x, state_rows)
        yield pd.DataFrame(
            {
                key: [group[0]] * len(changed),
                time: order[changed].astype("datetime64[us]"),
                value: x[changed],
                f"{value}_ema_{span}h": means[changed],
                "recent": recent,
            }
        )

    narrow = stream.select(key, time, F.col(value).cast("double").alias(value))
    timed = narrow if delay is None else narrow.withWatermark(time, delay)
    return timed.groupBy(key).applyInPandasWithState(
        update, output, EMA_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], time: str) -> StreamingQuery:
    """Rows by key into a table partitioned by day; a later row of a key replaces the earlier one."""

    def save(batch: DataFrame, batch_id: int) -> None:
        upsert_days(batch, path, [*keys, time], time)

    return (
        df.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
