"""Queries: the events as a file stream, run to its end, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from airloom.functions import bands
from airloom.operators import windows
from airloom.operators.cuts import HOURLY_GRID_ROWS
from airloom.plans import runs
from airloom.plans.carry import Carry
from airloom.queries.common import HOURLY_SQL, R, TS, hourly, present, table
from airloom.queries.shaping import level_case
from airloom.session import shared_folder
from airloom.sources.payloads import current_weather
from airloom.streaming import features as stateful
from airloom.streaming import ingest

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def scratch(spark, label: str) -> str:
    return f"{shared_folder(spark)}/airloom/{label}-{uuid.uuid4().hex}"


def event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )


def run_to_end(spark, stream, label, mode="append"):
    out, checkpoint = scratch(spark, label), scratch(spark, f"{label}-checkpoint")
    started = ingest.write_stream(stream, out, checkpoint, mode)
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def hourly_files(spark, sf_dir, label):
    """Hourly observations landed one span of days after the other, to be streamed."""
    path = scratch(spark, label)
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    first, last = rows.agg(F.min("datetime"), F.max("datetime")).first()
    middle = first + (last - first) / 2
    rows.filter(F.col("datetime") < F.lit(middle)).coalesce(1).write.parquet(path)
    rows.filter(F.col("datetime") >= F.lit(middle)).coalesce(1).write.mode("append").parquet(path)
    return path


@query("stream_dedup", f"SELECT event_id, {R('value')} AS value FROM events")
def stream_dedup(spark, sf_dir):
    """Every event arrives twice; one copy comes out."""
    stream = event_stream(spark, sf_dir).select("event_id", "ts", "value")
    once = ingest.dedup(stream.union(stream), ["event_id"], "ts")
    return present(run_to_end(spark, once, "dedup").drop("ts"))


EVENT_FILES = 6


def timed_events(spark, sf_dir, label, late=None):
    """The events as a stream of files in the order of their time; ``late`` rows come in the last file."""
    path = scratch(spark, label)
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    first, last = rows.agg(F.min("ts"), F.max("ts")).first()
    late = F.lit(False) if late is None else late
    for k in range(EVENT_FILES):
        begin, end = (first + (last - first) * i / EVENT_FILES for i in (k, k + 1))
        inside = (F.col("ts") >= F.lit(begin)) & ((F.col("ts") < F.lit(end)) | F.lit(k + 1 == EVENT_FILES))
        rows.filter(inside & ~late).coalesce(1).write.mode("append").parquet(path)
    rows.filter(late).coalesce(1).write.mode("append").parquet(path)
    return ingest.table_stream(spark, path, rows.schema, files_per_batch=1)


def window_totals(spark, stream, label):
    """Windows written as they change, and the query that has run to its end."""
    out, checkpoint = scratch(spark, label), scratch(spark, f"{label}-checkpoint")
    started = ingest.keyed_stream(stream, out, checkpoint)
    started.awaitTermination()
    return ingest.newest_versions(spark, out, stream.schema, ["event_type", "window_start"]), started


@query(
    "stream_windows",
    f"""SELECT event_type, {TS("date_trunc('hour', ts)")} AS window_start, {R('avg(value)')} AS mean_value,
        count(*)::BIGINT AS n FROM events GROUP BY event_type, date_trunc('hour', ts)""",
)
def stream_windows(spark, sf_dir):
    events = timed_events(spark, sf_dir, "windows-source")
    means = ingest.window_means(events, ["event_type"], "ts", "value")
    return present(window_totals(spark, means, "windows")[0].drop("window_end"))


@query(
    "stream_sliding_windows",
    f"""SELECT event_type, {TS('window_start')} AS window_start, {R('avg(value)')} AS mean_value, count(*)::BIGINT AS n
        FROM (SELECT event_type, value, unnest(generate_series(date_trunc('day', ts) - INTERVAL 18 HOUR
              + (hour(ts) // 6) * INTERVAL 6 HOUR, date_trunc('hour', ts), INTERVAL 6 HOUR)) AS window_start FROM events)
        GROUP BY 1, 2""",
)
def stream_sliding_windows(spark, sf_dir):
    """Means of 24 hours, every six hours."""
    events = timed_events(spark, sf_dir, "sliding-source")
    means = ingest.window_means(events, ["event_type"], "ts", "value", "24 hours", "6 hours")
    return present(window_totals(spark, means, "sliding")[0].drop("window_end"))


@query(
    "stream_late_rows",
    f"""WITH e AS (SELECT *, event_id % 50 = 0 AND ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) AS late FROM events),
        w AS (SELECT event_type, date_trunc('hour', ts) AS window_start, {R('avg(value)')} AS mean_value, count(*)::BIGINT AS n
              FROM e WHERE NOT late GROUP BY 1, 2)
        SELECT event_type, {TS('window_start')} AS window_start, mean_value, n,
               (SELECT count(DISTINCT (event_type, date_trunc('hour', ts))) FROM e WHERE late)::BIGINT AS dropped FROM w""",
)
def stream_late_rows(spark, sf_dir):
    """Windows of an hour; what comes after the watermark is dropped and counted."""
    first, last = table(spark, sf_dir, "events").agg(F.min("ts"), F.max("ts")).first()
    late = (F.col("event_id") % 50 == 0) & (F.col("ts") < F.lit(first + (last - first) / 2))
    means = ingest.window_means(timed_events(spark, sf_dir, "late-source", late), ["event_type"], "ts", "value")
    rows, started = window_totals(spark, means, "late")
    dropped = ingest.late_rows(spark, started).agg(F.sum("dropped")).first()[0]
    return present(rows.drop("window_end").withColumn("dropped", F.lit(dropped)))


@query(
    "stream_alerts",
    f"SELECT event_id, level FROM (SELECT event_id, {level_case(lambda e: repr(e[0]))} AS level FROM events) "
    "WHERE level IN ('hazardous', 'very_unhealthy', 'unhealthy')",
)
def stream_alerts(spark, sf_dir):
    stream = event_stream(spark, sf_dir).select("event_id", "ts", "value")
    alerts = ingest.alert_stream(stream, "value", bands.alert(F.col("value")))
    return run_to_end(spark, alerts, "alerts").select("event_id", "level")


@query(
    "stream_payloads",
    f"SELECT series_key, {TS('datetime')} AS datetime, {R('temperature_2m')} AS temperature_2m FROM ({HOURLY_SQL})",
)
def stream_payloads(spark, sf_dir):
    """Payload lines landed as files, parsed as a stream."""
    landing = scratch(spark, "landing")
    current = F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature_2m")
    hourly(spark, sf_dir).select(
        "series_key", F.to_json(F.struct(current.alias("current"))).alias("payload")
    ).write.json(landing)
    parsed = ingest.payload_stream(spark, landing, current_weather)
    return present(run_to_end(spark, parsed.select("series_key", "datetime", "temperature_2m"), "parsed"))


@query("stream_ema", "")
def stream_ema(spark, sf_dir):
    """EMA carried as state over files, the last of them late, equal to the batch EMA."""
    path = scratch(spark, "ema-source")
    for part in late_and_rest(spark, sf_dir):
        part.coalesce(1).write.mode("append").parquet(path)
    stream = ingest.table_stream(spark, path, spark.read.parquet(path).schema, files_per_batch=1)
    out, checkpoint = scratch(spark, "ema"), scratch(spark, "ema-checkpoint")
    averages = stateful.stateful_ema(stream, "series_key", "datetime", "aqi", delay="400 days")
    started = stateful.upsert_stream(averages, out, checkpoint, ["series_key"], "datetime")
    started.awaitTermination()
    return present(spark.read.parquet(out).drop("recent", "aqi", "event_date"))


@query(
    "stream_features",
    f"""SELECT series_key, {TS('datetime')} AS datetime,
        {R('lag(aqi, 24) OVER (PARTITION BY series_key ORDER BY datetime)')} AS aqi_lag_24h,
        {R('avg(aqi) OVER (PARTITION BY series_key ORDER BY datetime ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)')} AS aqi_rolling_mean_24h
        FROM ({HOURLY_SQL})""",
)
def stream_features(spark, sf_dir):
    """Features kept up to date batch by batch, with look-back into the stored rows."""
    path = hourly_files(spark, sf_dir, "feature-source")
    schema = spark.read.parquet(path).schema
    history, output = scratch(spark, "history"), scratch(spark, "features")

    def compute(rows):
        out = windows.lags(rows, ["aqi"], ["series_key"], ["datetime"], (24,), longest=HOURLY_GRID_ROWS)
        return windows.rolling(
            out, "aqi", ["series_key"], ["datetime"], (24,), ("mean",), longest=HOURLY_GRID_ROWS
        )

    started = stateful.incremental_features(
        ingest.table_stream(spark, path, schema, files_per_batch=1), history, output,
        scratch(spark, "features-checkpoint"), ["series_key"], "datetime", compute, lookback=24,
    )
    started.awaitTermination()
    return present(spark.read.parquet(output).drop("event_date", "aqi"))


def averaged(rows):
    """Lags and exponential averages of one series column."""
    out = windows.lags(rows, ["aqi"], ["series_key"], ["datetime"], (24,), longest=HOURLY_GRID_ROWS)
    return windows.ema(out, "aqi", ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)


def late_and_rest(spark, sf_dir):
    """Hourly observations and, apart, those of the first half that arrive late."""
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    first, last = rows.agg(F.min("datetime"), F.max("datetime")).first()
    early = F.col("datetime") < F.lit(first + (last - first) / 2)
    late = early & (F.pmod(F.unix_seconds(F.col("datetime").cast("timestamp")) / 3600, F.lit(97)) == 0)
    return rows.filter(early & ~late), rows.filter(~early), rows.filter(late)


@query("stream_feature_averages", "")
def stream_feature_averages(spark, sf_dir):
    """Averages kept up to date from states by day, on series longer than the look-back, with late rows."""
    path = scratch(spark, "average-source")
    parts = late_and_rest(spark, sf_dir)
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    history, output, states = (scratch(spark, x) for x in ("history", "averages", "states"))
    started = stateful.incremental_features(
        ingest.table_stream(spark, path, schema, files_per_batch=1), history, output,
        scratch(spark, "averages-checkpoint"), ["series_key"], "datetime", averaged, lookback=24,
        carry=Carry(states, ["series_key"], "datetime", "aqi"),
    )
    started.awaitTermination()
    return present(spark.read.parquet(output).drop("event_date", "aqi"))


@query("incremental_carry", "")
def incremental_carry(spark, sf_dir):
    """The same by refresh runs: the stored half, the newer half, then the late rows."""
    history, output, states = (scratch(spark, x) for x in ("history", "features", "states"))
    for fresh in late_and_rest(spark, sf_dir):
        runs.refresh(spark, fresh, history, states, output, averaged, lookback=24)
    return present(spark.read.parquet(output).drop("event_date", "aqi"))


def _ema_oracle() -> str:
    from airloom.queries.series import ema_ctes

    return f"""WITH RECURSIVE src AS MATERIALIZED (SELECT series_key, datetime, aqi AS x,
        row_number() OVER (PARTITION BY series_key ORDER BY datetime) AS n FROM ({HOURLY_SQL})), {ema_ctes('src')}
        SELECT s.series_key, {TS('s.datetime')} AS datetime, COLUMNS FROM src s JOIN ema24 a USING (series_key, n)
        JOIN ema168 b USING (series_key, n)"""


ORACLES["stream_ema"] = _ema_oracle().replace("COLUMNS", f"{R('a.y')} AS aqi_ema_24h")
ORACLES["stream_feature_averages"] = ORACLES["incremental_carry"] = _ema_oracle().replace(
    "COLUMNS",
    f"{R('lag(s.x, 24) OVER (PARTITION BY s.series_key ORDER BY s.datetime)')} AS aqi_lag_24h, "
    f"{R('a.y')} AS aqi_ema_24h, {R('b.y')} AS aqi_ema_168h",
)
