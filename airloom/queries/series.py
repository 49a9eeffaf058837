"""Queries: ordered series, ranges, decomposition, the whole feature frame."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from airloom.functions import bands, calendar
from airloom.functions.calendar import add_time_features
from airloom.ml import forecast
from airloom.operators import decompose as parts
from airloom.operators import ranges, windows
from airloom.operators.cuts import HOURLY_GRID_ROWS
from airloom.operators.joins import asof_join, dedup_latest
from airloom.plans.features import feature_frame
from airloom.plans.transformers import CyclicalTimeEncoder, LagFeatureGenerator, RollingFeatureGenerator
from airloom.queries.common import HOURLY_SQL, R, TS, hourly, present, table
from airloom.queries.shaping import (
    CATEGORY_SQL, HOLIDAY_LIST, INTERACTION_SQL, RISK_SQL, calendar_sql, cyclical_sql, flag_sql,
    season_sql,
)
from airloom.session import shared_folder

QUERIES, ORACLES = {}, {}
ORDER = ["ts", "event_id"]


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def per_user(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", "value")


def rolling_sql(x: str, over: str, sizes=windows.ROLLING_WINDOWS, prefix="value") -> dict[str, str]:
    out = {}
    for k in sizes:
        frame = f"OVER ({over} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        out[f"{prefix}_rolling_mean_{k}h"] = f"avg({x}) {frame}"
        out[f"{prefix}_rolling_std_{k}h"] = f"stddev_samp({x}) {frame}"
        out[f"{prefix}_rolling_min_{k}h"] = f"min({x}) {frame}"
        out[f"{prefix}_rolling_max_{k}h"] = f"max({x}) {frame}"
        out[f"{prefix}_rolling_range_{k}h"] = f"max({x}) {frame} - min({x}) {frame}"
    return out


def doubles(columns: dict[str, str]) -> str:
    return ", ".join(f"{R(x)} AS {c}" for c, x in columns.items())


USER = "PARTITION BY user_id ORDER BY ts, event_id"
KIND = "PARTITION BY event_type ORDER BY ts, event_id"


# --- flagship ---------------------------------------------------------------

HOUR = "PARTITION BY series_key ORDER BY datetime"


@query(
    "hourly_features",
    f"""SELECT series_key, {TS('datetime')} AS datetime, {R('aqi')} AS aqi,
        {doubles(rolling_sql('aqi', HOUR, (3, 24), 'aqi'))},
        {doubles({'aqi_lag_1h': f'lag(aqi, 1) OVER ({HOUR})', 'aqi_lag_24h': f'lag(aqi, 24) OVER ({HOUR})'})},
        {', '.join(f'CAST({s.format(v="aqi")} AS BIGINT) AS {c}' for c, s in CATEGORY_SQL.items())}
        FROM ({HOURLY_SQL})""",
)
def hourly_features(spark, sf_dir):
    """Events to hourly means per series, with windows, lags and categories."""
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    arranged = windows.arrange(rows, ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)
    out = arranged.extend(before=24)
    out = out.select("*", *windows.lag_columns(arranged, ["aqi"], (1, 24)))
    out = windows.add_rolling(out, arranged, "aqi", (3, 24))
    out = out.filter("_own").drop("_own", "_cut")
    return present(bands.add_category_flags(out))


# --- windows ----------------------------------------------------------------

@query(
    "rolling_stats",
    f"SELECT event_id, {doubles(rolling_sql('value', USER))} FROM events",
)
def rolling_stats(spark, sf_dir):
    out = windows.rolling(per_user(spark, sf_dir), "value", ["user_id"], ORDER)
    return present(out.drop("user_id", "event_type", "ts", "value"))


MISSING = "CASE WHEN value > 100 THEN NULL ELSE value END"


@query(
    "rolling_stats_long_series",
    f"SELECT event_id, {doubles(rolling_sql('x', KIND, (24, 168), 'x'))} "
    f"FROM (SELECT *, {MISSING} AS x FROM events)",
)
def rolling_stats_long_series(spark, sf_dir):
    """Few long series with missing values, in pieces of bounded length."""
    df = per_user(spark, sf_dir).withColumn("x", F.when(F.col("value") <= 100, F.col("value")))
    out = windows.rolling(df, "x", ["event_type"], ORDER, (24, 168), rows_per_cut=25_000)
    return present(out.drop("user_id", "event_type", "ts", "value", "x"))


@query(
    "rolling_percentiles",
    "SELECT event_id, "
    + doubles({
        f"value_p{int(p * 100)}_24h":
        f"quantile_cont(value, {p}) OVER ({USER} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
        for p in (0.25, 0.5, 0.75)
    })
    + " FROM events",
)
def rolling_percentiles(spark, sf_dir):
    arranged = windows.arrange(per_user(spark, sf_dir), ["user_id"], ORDER)
    frame = arranged.window().rowsBetween(-23, 0)
    out = arranged.extend(before=23).select(
        "event_id", "_own",
        *[F.percentile("value", p).over(frame).alias(f"value_p{int(p * 100)}_24h")
          for p in (0.25, 0.5, 0.75)],
    )
    return present(out.filter("_own").drop("_own"))


@query(
    "long_rolling",
    "SELECT event_id, "
    + doubles({
        f"rolling_mean_{k}h": f"avg(value) OVER ({KIND} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
        for k in windows.LONG_WINDOWS
    })
    + " FROM events",
)
def long_rolling(spark, sf_dir):
    df = per_user(spark, sf_dir).select("event_type", "ts", "event_id", "value")
    out = windows.long_rolling(df, "value", ["event_type"], ORDER)
    return present(out.select("event_id", "rolling_mean_720h", "rolling_mean_2160h"))


@query(
    "lags",
    "SELECT event_id, "
    + doubles({f"value_lag_{k}h": f"lag(value, {k}) OVER ({USER})" for k in windows.LAGS})
    + " FROM events",
)
def lags(spark, sf_dir):
    df = per_user(spark, sf_dir).drop("event_type")
    return present(windows.lags(df, ["value"], ["user_id"], ORDER).drop("user_id", "ts", "value"))


@query(
    "change_rate",
    "SELECT event_id, "
    + doubles({
        "value_change_1h": f"value - lag(value, 1) OVER ({USER})",
        "value_change_24h": f"value - lag(value, 24) OVER ({USER})",
        "value_diff_24h": f"value - lag(value, 24) OVER ({USER})",
    })
    + " FROM events",
)
def change_rate(spark, sf_dir):
    df = per_user(spark, sf_dir).drop("event_type")
    return present(windows.change_rate(df, "value", ["user_id"], ORDER).drop("user_id", "ts", "value"))


def ema_sql(span: int, source: str) -> str:
    """The recursion row by row; ``source`` has series_key, n (from 1) and x."""
    a = f"{2.0 / (span + 1.0)!r}::DOUBLE"
    k = f"power(1.0::DOUBLE - {a}, gap)"
    return f"""
    SELECT series_key, n, x, x AS y, CASE WHEN x IS NULL THEN 0 ELSE 1 END AS gap
    FROM {source} WHERE n = 1
    UNION ALL
    SELECT s.series_key, s.n, s.x,
           CASE WHEN s.x IS NULL THEN e.y WHEN e.y IS NULL THEN s.x
                ELSE ({k} * e.y + {a} * s.x) / ({k} + {a}) END,
           CASE WHEN s.x IS NOT NULL THEN 1 WHEN e.y IS NULL THEN 0 ELSE e.gap + 1 END
    FROM {{this}} e JOIN {source} s ON s.series_key = e.series_key AND s.n = e.n + 1"""


def ema_ctes(source: str) -> str:
    return ", ".join(
        f"ema{span} AS ({ema_sql(span, source).format(this=f'ema{span}')})"
        for span in windows.EMA_SPANS
    )


GAPPY_HOURS = f"""SELECT series_key, datetime, CASE WHEN aqi > 45 THEN NULL ELSE aqi END AS x,
    row_number() OVER (PARTITION BY series_key ORDER BY datetime) AS n FROM ({HOURLY_SQL})"""


@query(
    "ema",
    f"""WITH RECURSIVE src AS MATERIALIZED ({GAPPY_HOURS}), {ema_ctes('src')}
    SELECT s.series_key, {TS('s.datetime')} AS datetime, {R('a.y')} AS x_ema_24h, {R('b.y')} AS x_ema_168h
    FROM src s JOIN ema24 a USING (series_key, n) JOIN ema168 b USING (series_key, n)""",
)
def ema(spark, sf_dir):
    rows = hourly(spark, sf_dir).select(
        "series_key", "datetime", F.when(F.col("aqi") <= 45, F.col("aqi")).alias("x")
    )
    out = windows.ema(rows, "x", ["series_key"], ["datetime"])
    return present(out.drop("x"))


TREND_SQL = """CASE WHEN lag(aqi, 12) OVER w IS NOT NULL AND lead(aqi, 12) OVER w IS NOT NULL THEN
    (sum(aqi) OVER (PARTITION BY series_key ORDER BY datetime ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING)
     + 0.5 * lag(aqi, 12) OVER w + 0.5 * lead(aqi, 12) OVER w) / 24 END"""


@query(
    "trend_2x24",
    f"SELECT series_key, {TS('datetime')} AS datetime, {R(TREND_SQL)} AS trend FROM ({HOURLY_SQL}) "
    f"WINDOW w AS ({HOUR})",
)
def trend_2x24(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    out = windows.trend(rows, "aqi", ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)
    return present(out.drop("aqi"))


def decompose_sql(limit: str) -> str:
    return f"""
    t AS (SELECT series_key, datetime, aqi FROM ({HOURLY_SQL}) {limit}),
    d AS (SELECT *, {TREND_SQL} AS trend,
                 (row_number() OVER w - 1) % 24 AS phase FROM t WINDOW w AS ({HOUR})),
    p AS (SELECT series_key, phase, avg(aqi - trend) AS m FROM d GROUP BY 1, 2),
    s AS (SELECT series_key, phase, m - avg(m) OVER (PARTITION BY series_key) AS seasonal FROM p),
    r AS (SELECT d.series_key, d.datetime, aqi, trend, seasonal, aqi - trend - seasonal AS residual
          FROM d JOIN s USING (series_key, phase)
          WHERE d.series_key IN (SELECT series_key FROM t GROUP BY 1 HAVING count(*) >= 48))"""


TAIL = f"QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY datetime DESC) <= 240"
PARTS_SQL = (
    f"SELECT series_key, {TS('datetime')} AS datetime, {R('trend')} AS trend, "
    f"{R('seasonal')} AS seasonal, {R('residual')} AS residual FROM r"
)


def hourly_parts(spark, sf_dir, whole):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    return parts.decompose(rows, "aqi", ["series_key"], ["datetime"], whole=whole)


@query("seasonal_decompose", f"WITH {decompose_sql(TAIL)} {PARTS_SQL}")
def seasonal_decompose(spark, sf_dir):
    return present(hourly_parts(spark, sf_dir, whole=False).drop("aqi"))


@query("seasonal_decompose_whole", f"WITH {decompose_sql('')} {PARTS_SQL}")
def seasonal_decompose_whole(spark, sf_dir):
    return present(hourly_parts(spark, sf_dir, whole=True).drop("aqi"))


@query(
    "decompose_strength",
    f"""WITH {decompose_sql(TAIL)} SELECT series_key,
    {R('greatest(0, 1 - var_samp(residual) / var_samp(trend + residual))')} AS trend_strength,
    {R('greatest(0, 1 - var_samp(residual) / var_samp(seasonal + residual))')} AS seasonal_strength,
    {R('stddev_samp(residual)')} AS residual_std FROM r GROUP BY 1""",
)
def decompose_strength(spark, sf_dir):
    return present(parts.strengths(hourly_parts(spark, sf_dir, whole=False), ["series_key"]))


# --- positions, newest rows, ranges -----------------------------------------

@query(
    "row_position",
    "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position, "
    f"row_number() OVER ({KIND}) - 1 AS series_position FROM events",
)
def row_position(spark, sf_dir):
    """Position in the whole table and in the series, cut into bounded pieces."""
    df = per_user(spark, sf_dir).select("event_type", "ts", "event_id")
    whole = windows.with_position(df, [], ORDER, "position", rows_per_cut=25_000)
    out = windows.with_position(whole, ["event_type"], ORDER, "series_position", rows_per_cut=25_000)
    return present(out.select("event_id", "position", "series_position"))


@query(
    "latest_per_series",
    f"SELECT user_id, event_id, {R('value')} AS value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
)
def latest_per_series(spark, sf_dir):
    df = per_user(spark, sf_dir)
    return present(windows.latest(df, ["user_id"], ORDER).select("user_id", "event_id", "value"))


@query(
    "last_7_days",
    "SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY",
)
def last_7_days(spark, sf_dir):
    return ranges.last_days(table(spark, sf_dir, "events").select("ts", "event_id"), "ts").select("event_id")


@query(
    "tail_240",
    "SELECT event_id FROM events QUALIFY row_number() OVER "
    "(PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 240",
)
def tail_240(spark, sf_dir):
    df = per_user(spark, sf_dir).select("event_type", "ts", "event_id")
    return ranges.tail(df, ["event_type"], ORDER).select("event_id")


START, END = dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 20)
BETWEEN = "ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"


@query(
    "backfill_range",
    f"""SELECT o_orderkey, {TS('o_orderdate')} AS o_orderdate FROM orders
        WHERE o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 730 DAY""",
)
def backfill_range(spark, sf_dir):
    """The two years of 365 days before the newest row."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    newest = df.agg(F.max("o_orderdate")).first()[0]
    return present(ranges.between(df, "o_orderdate", *ranges.backfill_bounds(newest, 2)))


@query("historical_range", f"SELECT event_id, {R('value')} AS value FROM events WHERE {BETWEEN}")
def historical_range(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    return present(ranges.between(df, "ts", START, END).drop("ts"))


@query(
    "recent_range",
    "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-19' AND ts <= TIMESTAMP '2024-01-20'",
)
def recent_range(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    start, end = ranges.incremental_bounds(END, hours=24)
    assert start == dt.datetime(2024, 1, 19)
    return ranges.recent(df, "ts", end, hours=24).select("event_id")


@query(
    "incremental_lookback",
    f"""SELECT * FROM (SELECT event_id, ts, {R(f'lag(value, 168) OVER ({KIND})')} AS value_lag_168h,
        {R(f'avg(value) OVER ({KIND} ROWS BETWEEN 167 PRECEDING AND CURRENT ROW)')} AS mean_168h
        FROM events) SELECT_SLICE WHERE {BETWEEN}""".replace("SELECT_SLICE", "slice"),
)
def incremental_lookback(spark, sf_dir):
    """Features of a slice, computed on the slice and the rows it looks back on."""
    df = per_user(spark, sf_dir).select("event_type", "ts", "event_id", "value")

    def compute(rows):
        out = windows.lags(rows, ["value"], ["event_type"], ORDER, (168,))
        return windows.rolling(out, "value", ["event_type"], ORDER, (168,), ("mean",),
                               name="mean_{size}h")

    out = ranges.with_lookback(df, ["event_type"], ORDER, START, END, compute, rows=168)
    return present(out.select("event_id", "ts", "value_lag_168h", "mean_168h").drop("ts"))


ORACLES["incremental_lookback"] = ORACLES["incremental_lookback"].replace("SELECT * FROM", "SELECT * EXCLUDE (ts) FROM", 1)


@query(
    "backfill_chunks",
    """WITH b AS (SELECT o_orderpriority, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1),
       c AS (SELECT o_orderpriority, hi, unnest(generate_series(lo, hi, INTERVAL 30 DAY)) AS chunk_start FROM b)
       SELECT o_orderpriority, strftime(chunk_start, '%Y-%m-%d %H:%M:%S') AS chunk_start,
              strftime(least(chunk_start + INTERVAL 30 DAY, hi), '%Y-%m-%d %H:%M:%S') AS chunk_end
       FROM c WHERE chunk_start < hi""",
)
def backfill_chunks(spark, sf_dir):
    bounds = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")
    )
    return present(ranges.chunks(bounds, "lo", "hi").drop("lo", "hi"))


@query(
    "date_spine",
    """SELECT user_id, day_ahead::BIGINT AS day_ahead,
       strftime(CAST(newest AS DATE) + day_ahead::INTEGER, '%Y-%m-%d') AS forecast_date
       FROM (SELECT user_id, max(ts) AS newest FROM events GROUP BY 1), range(0, 3) r(day_ahead)""",
)
def date_spine(spark, sf_dir):
    newest = table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("ts").alias("newest"))
    return present(ranges.date_spine(newest, "newest").drop("newest"))


@query(
    "hourly_grid",
    f"""WITH h AS ({HOURLY_SQL}),
        s AS (SELECT series_key, min(datetime) AS lo, max(datetime) AS hi FROM h GROUP BY 1),
        g AS (SELECT series_key, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS datetime FROM s)
        SELECT series_key, {TS('datetime')} AS datetime, {R('aqi')} AS aqi
        FROM g LEFT JOIN h USING (series_key, datetime)""",
)
def hourly_grid(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    return present(ranges.hourly_grid(rows, ["series_key"], "datetime"))


@query(
    "dedup_latest",
    f"""SELECT event_type, {TS("date_trunc('hour', ts)")} AS hour, event_id, {R('value')} AS value FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_latest_rows(spark, sf_dir):
    """Newest reading per series and hour, from a table in which rows are repeated."""
    df = per_user(spark, sf_dir).withColumn("hour", F.date_trunc("hour", "ts"))
    again = df.unionByName(df.filter(F.col("event_type").isin("view", "click")))
    out = dedup_latest(again, ["event_type", "hour"], ORDER)
    return present(out.select("event_type", "hour", "event_id", "value"))


@query(
    "asof_join",
    f"""SELECT l.event_id, r.event_id::DOUBLE AS seen_id, {R('r.value')} AS seen_value
        FROM (SELECT * FROM events WHERE event_type = 'purchase') l
        ASOF LEFT JOIN (SELECT * FROM events WHERE event_type <> 'purchase') r
        ON l.user_id = r.user_id AND l.ts >= r.ts""",
)
def asof_readings(spark, sf_dir):
    """Every purchase with the user's last other event before it, or nulls."""
    return last_seen(spark, sf_dir).withColumn("seen_id", F.col("seen_id").cast("double"))


QUERIES["asof_join_all"], ORACLES["asof_join_all"] = asof_readings, ORACLES["asof_join"]


def last_seen(spark, sf_dir):
    df = per_user(spark, sf_dir)
    left = df.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    right = df.filter("event_type <> 'purchase'").select(
        "user_id", "ts", F.col("event_id").alias("seen_id"), F.col("value").alias("seen_value")
    )
    out = asof_join(left, right, ["user_id"], "ts", ["seen_id", "seen_value"], "event_id", "seen_id")
    return present(out.select("event_id", "seen_id", "seen_value"))


# --- forecasts --------------------------------------------------------------

@query(
    "seasonal_naive",
    f"""SELECT series_key, {TS('datetime')} AS datetime, {R('aqi')} AS aqi,
        {R(f'lag(aqi, 24) OVER ({HOUR})')} AS prediction FROM ({HOURLY_SQL})""",
)
def seasonal_naive(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    return present(
        forecast.seasonal_naive(rows, "aqi", ["series_key"], ["datetime"], longest=HOURLY_GRID_ROWS)
    )


@query(
    "horizon_labels",
    f"""SELECT series_key, {TS('datetime')} AS datetime, horizon::BIGINT AS horizon, {R('actual')} AS actual FROM (
        SELECT series_key, datetime, 1 AS horizon, lead(aqi, 1) OVER ({HOUR}) AS actual FROM ({HOURLY_SQL})
        UNION ALL SELECT series_key, datetime, 24, lead(aqi, 24) OVER ({HOUR}) FROM ({HOURLY_SQL})
        UNION ALL SELECT series_key, datetime, 72, lead(aqi, 72) OVER ({HOUR}) FROM ({HOURLY_SQL}))""",
)
def horizon_labels(spark, sf_dir):
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    wide = forecast.horizon_labels(
        rows, "aqi", ["series_key"], ["datetime"], (1, 24, 72), longest=HOURLY_GRID_ROWS
    )
    return present(forecast.horizons_long(wide, "aqi", (1, 24, 72)).drop("aqi"))


# --- the whole feature frame ------------------------------------------------

def feature_sql() -> str:
    whole = {**calendar_sql("datetime"), **season_sql("datetime"),
             **{c: s for c, s in RISK_SQL.items()},
             **{c: s.format(v="aqi") for c, s in CATEGORY_SQL.items()},
             "is_holiday": flag_sql(f"CAST(datetime AS DATE) IN ({HOLIDAY_LIST})")}
    real = {c: c for c in ("temperature_2m relative_humidity_2m precipitation wind_speed_10m "
                           "wind_direction_10m pressure_msl cloud_cover aqi pm25 pm10 no2 o3").split()}
    real |= cyclical_sql("datetime")
    real |= {c: s for c, s in INTERACTION_SQL.items() if "visibility" not in s}
    real |= {
        "aqi_change_1h": f"aqi - lag(aqi, 1) OVER ({HOUR})",
        "aqi_change_24h": f"aqi - lag(aqi, 24) OVER ({HOUR})",
        "aqi_diff_24h": f"aqi - lag(aqi, 24) OVER ({HOUR})",
        "aqi_ema_24h": "ema_24", "aqi_ema_168h": "ema_168",
        "rolling_mean_720h": f"avg(aqi) OVER ({HOUR} ROWS BETWEEN 719 PRECEDING AND CURRENT ROW)",
        "rolling_mean_2160h": f"avg(aqi) OVER ({HOUR} ROWS BETWEEN 2159 PRECEDING AND CURRENT ROW)",
        "pm25_pm10_ratio": "pm25 / (pm10 + 1e-6)", "no2_o3_ratio": "no2 / (o3 + 1e-6)",
        "pollution_index": "0.4 * pm25 + 0.3 * pm10 + 0.2 * no2 + 0.1 * o3",
    }
    real |= rolling_sql("aqi", HOUR, prefix="aqi")
    for k in windows.LAGS:
        for c in ("aqi", "pm25", "pm10", "no2", "o3"):
            real[f"{c}_lag_{k}h"] = f"lag({c}, {k}) OVER ({HOUR})"
    return f"""WITH RECURSIVE
    src AS MATERIALIZED (SELECT *, aqi AS x, row_number() OVER ({HOUR}) AS n FROM ({HOURLY_SQL})),
    {ema_ctes('src')},
    full_rows AS (SELECT s.*, a.y AS ema_24, b.y AS ema_168 FROM src s
                  JOIN ema24 a USING (series_key, n) JOIN ema168 b USING (series_key, n))
    SELECT series_key, {TS('datetime')} AS datetime, source,
           {', '.join(f'CAST({x} AS BIGINT) AS {c}' for c, x in whole.items())}, {doubles(real)}
    FROM full_rows"""


@query("feature_frame", feature_sql())
def features(spark, sf_dir):
    """All 148 columns of the hourly observations."""
    return present(feature_frame(hourly(spark, sf_dir)))


@query(
    "feature_frame_leak_free",
    f"""SELECT series_key, {TS('datetime')} AS datetime, {R('aqi')} AS aqi,
        {R(f'avg(aqi) OVER ({HOUR} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING)')} AS aqi_rolling_mean_24h,
        {R(f'max(aqi) OVER ({HOUR} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)')} AS aqi_rolling_max_3h,
        {R(f'lag(aqi, 1) OVER ({HOUR}) - lag(aqi, 2) OVER ({HOUR})')} AS aqi_change_1h,
        {R(f'avg(aqi) OVER ({HOUR} ROWS BETWEEN 720 PRECEDING AND 1 PRECEDING)')} AS rolling_mean_720h,
        {R(f'lag(pm25, 24) OVER ({HOUR})')} AS pm25_lag_24h FROM ({HOURLY_SQL})""",
)
def features_leak_free(spark, sf_dir):
    out = feature_frame(hourly(spark, sf_dir), feature_set="leak_free")
    absent = {"pm25", "aqi_good", "pollution_index"} & set(out.columns)
    assert not absent, absent
    return present(
        out.select("series_key", "datetime", "aqi", "aqi_rolling_mean_24h", "aqi_rolling_max_3h",
                   "aqi_change_1h", "rolling_mean_720h", "pm25_lag_24h")
    )


STEP_WINDOW = "PARTITION BY series_key ORDER BY datetime ROWS BETWEEN {} PRECEDING AND CURRENT ROW"


@query(
    "transformer_pipeline",
    f"""SELECT series_key, {TS('datetime')} AS datetime,
        {doubles(dict(
            hour_sin='sin(2 * pi() * hour(datetime) / 24)', hour_cos='cos(2 * pi() * hour(datetime) / 24)',
            aqi_lag_1h='lag(aqi, 1) OVER (PARTITION BY series_key ORDER BY datetime)',
            pm25_lag_24h='lag(pm25, 24) OVER (PARTITION BY series_key ORDER BY datetime)',
            aqi_rolling_mean_3h=f'avg(aqi) OVER ({STEP_WINDOW.format(2)})',
            aqi_rolling_max_13h=f'max(aqi) OVER ({STEP_WINDOW.format(12)})',
        ))} FROM ({HOURLY_SQL})""",
)
def transformer_pipeline(spark, sf_dir):
    """The feature steps as a pipeline that is saved, loaded and run."""
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi", "pm25")
    steps = Pipeline(stages=[
        CyclicalTimeEncoder(columns=["hour"]), LagFeatureGenerator(sizes=[1, 24]), RollingFeatureGenerator(sizes=[3, 13]),
    ])
    path = f"{shared_folder(spark)}/airloom/steps-{uuid.uuid4().hex}"
    timed = add_time_features(rows)
    steps.fit(timed).write().save(path)
    out = PipelineModel.load(path).transform(timed)
    return present(out.select(
        "series_key", "datetime", "hour_sin", "hour_cos", "aqi_lag_1h", "pm25_lag_24h", "aqi_rolling_mean_3h", "aqi_rolling_max_13h"
    ))


@query(
    "ensemble",
    f"""SELECT series_key, {TS('datetime')} AS datetime, {R('(a + b) / 2')} AS prediction FROM (
        SELECT series_key, datetime, lag(aqi, 24) OVER (PARTITION BY series_key ORDER BY datetime) AS a,
               lag(aqi, 168) OVER (PARTITION BY series_key ORDER BY datetime) AS b FROM ({HOURLY_SQL}))
        WHERE a IS NOT NULL AND b IS NOT NULL""",
)
def ensemble(spark, sf_dir):
    """The mean of a daily and a weekly repetition, where both say something."""
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    parts = [
        forecast.seasonal_naive(rows, "aqi", ["series_key"], ["datetime"], season, longest=HOURLY_GRID_ROWS)
        for season in (24, 168)
    ]
    both = parts[1].filter("prediction IS NOT NULL").select("series_key", "datetime")
    mean = forecast.ensemble(parts, ["series_key", "datetime"])
    return present(mean.join(both, ["series_key", "datetime"], "left_semi"))
