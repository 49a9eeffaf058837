"""Queries: profiling, joins of sources, reshaping, tables and versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import bands
from airloom.operators import joins, profile, reshape
from airloom.operators.quantiles import medians
from airloom.queries.common import HOURLY_SQL, R, TS, hourly, present, table
from airloom.queries.shaping import GAPPY_SQL, LOWERED, gappy, level_case
from airloom.session import shared_folder
from airloom.sources import tables

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def doubles(**columns) -> str:
    return ", ".join(f"{R(x)} AS {c}" for c, x in columns.items())


# --- distribution -----------------------------------------------------------

@query("overview", f"SELECT count(*)::BIGINT AS total_records, {TS('min(ts)')} AS first_time, "
       f"{TS('max(ts)')} AS last_time, 6::BIGINT AS features FROM events")
def overview(spark, sf_dir):
    return present(profile.overview(table(spark, sf_dir, "events"), "ts"))


# Events with holes in three columns.
HOLES_SQL = """SELECT event_id, ts, user_id, CASE WHEN value > 50 THEN NULL ELSE value END AS value,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS event_type,
    CASE WHEN value < 1 THEN NULL ELSE props END AS props FROM events"""


def holes(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id",
        F.when(c("value") <= 50, c("value")).alias("value"),
        F.when(c("event_type") != "error", c("event_type")).alias("event_type"),
        F.when(c("value") >= 1, c("props")).alias("props"),
    )


MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL)::BIGINT AS missing_count, "
    f"{R(f'count_if({c} IS NULL) * 100.0 / count(*)')} AS missing_pct FROM ({HOLES_SQL})"
    for c in ("event_id", "ts", "user_id", "value", "event_type", "props")
)


@query("missing_profile", f"SELECT * FROM ({MISSING_SQL}) WHERE missing_count > 0")
def missing_profile(spark, sf_dir):
    return present(profile.missing_profile(holes(spark, sf_dir)))


@query(
    "completeness",
    f"""SELECT count(*)::BIGINT AS total_records, 6::BIGINT AS total_features,
        {R('(count(value) + count(event_type) + count(props) + 3 * count(*)) * 100.0 / (6 * count(*))')}
        AS completeness_pct FROM ({HOLES_SQL})""",
)
def completeness(spark, sf_dir):
    return present(profile.completeness(holes(spark, sf_dir)))


LINE_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c})::BIGINT AS count, "
    + doubles(mean=f"avg({c})", std=f"stddev_samp({c})", min=f"min({c})",
              q25=f"quantile_cont({c}, 0.25)", median=f"quantile_cont({c}, 0.5)",
              q75=f"quantile_cont({c}, 0.75)", max=f"max({c})")
    + " FROM lineitem"
    for c in LINE_COLUMNS
)


@query("describe", DESCRIBE_SQL)
def describe(spark, sf_dir):
    return present(profile.describe(table(spark, sf_dir, "lineitem"), LINE_COLUMNS))


@query("describe_by_counting", DESCRIBE_SQL)
def describe_by_counting(spark, sf_dir):
    """The same with the brackets used where a column is too long to hold."""
    df = table(spark, sf_dir, "lineitem")
    return present(profile.describe(df, LINE_COLUMNS, direct_rows=1000, accuracy=100))


def shape_sql(c: str, frm: str) -> str:
    return f"""SELECT '{c}' AS column_name, skewness, kurtosis,
        CASE WHEN abs(skewness) < 0.5 THEN 'symmetric' WHEN skewness > 0 THEN 'right-skewed' ELSE 'left-skewed' END AS skew_label,
        CASE WHEN abs(kurtosis) < 0.5 THEN 'mesokurtic' WHEN kurtosis > 0 THEN 'leptokurtic' ELSE 'platykurtic' END AS tail_label
        FROM (SELECT {R(f'avg(power({c} - m, 3)) / power(var_pop({c}), 1.5)')} AS skewness,
                     {R(f'avg(power({c} - m, 4)) / power(var_pop({c}), 2) - 3')} AS kurtosis
              FROM {frm}, (SELECT avg({c}) AS m FROM {frm}))"""


@query("shape_stats", f"{shape_sql('value', 'events')} UNION ALL {shape_sql('event_id', 'events')}")
def shape_stats(spark, sf_dir):
    return present(profile.shape(table(spark, sf_dir, "events"), ["value", "event_id"]))


CORR_COLUMNS = (
    "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m", "wind_direction_10m",
    "pressure_msl", "cloud_cover", "aqi", "pm25", "pm10", "no2", "o3", "fixed",
)
# Every third hour lacks its humidity, every seventh its pressure.
CORR_FROM = f"""(SELECT * REPLACE (CASE WHEN hour(datetime) % 3 = 0 THEN NULL ELSE relative_humidity_2m END AS relative_humidity_2m,
        CASE WHEN hour(datetime) % 7 = 0 THEN NULL ELSE pressure_msl END AS pressure_msl), 1.0::DOUBLE AS fixed FROM h)"""


def corr_sql() -> str:
    cells = []
    for x in CORR_COLUMNS:
        for y in CORR_COLUMNS:
            # A constant column has no correlation.
            r = "max(NULL::DOUBLE)" if "fixed" in (x, y) else f"corr({x}, {y})"
            cells.append(f"SELECT '{x}' AS x, '{y}' AS y, {R(r)} AS r FROM g")
    return f"WITH h AS ({HOURLY_SQL}), g AS MATERIALIZED {CORR_FROM} " + " UNION ALL ".join(cells)


@query("correlation_matrix", corr_sql())
def correlation_matrix(spark, sf_dir):
    """All numeric columns of the hourly observations, two with gaps and one constant."""
    rows = hourly(spark, sf_dir).withColumn("fixed", F.lit(1.0))
    for name, every in (("relative_humidity_2m", 3), ("pressure_msl", 7)):
        rows = rows.withColumn(name, F.when(F.hour("datetime") % every != 0, F.col(name)))
    return present(profile.correlation_matrix(rows, profile.numeric_columns(rows)))


@query(
    "histogram",
    f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
        b AS (SELECT least(floor((value - lo) / (hi - lo) * 50)::BIGINT + 1, 50) AS bin, lo, hi FROM events, e)
        SELECT bin, {R('lo + (hi - lo) / 50 * (bin - 1)')} AS lower, {R('lo + (hi - lo) / 50 * bin')} AS upper,
               count(*)::BIGINT AS n FROM b GROUP BY bin, lo, hi""",
)
def histogram(spark, sf_dir):
    return present(profile.histogram(table(spark, sf_dir, "events"), "value"))


BOX_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {doubles(q1='q1', median='m', q3='q3',
        lower_whisker=f'min({c}) FILTER ({c} >= q1 - 1.5 * (q3 - q1))',
        upper_whisker=f'max({c}) FILTER ({c} <= q3 + 1.5 * (q3 - q1))')},
        count_if({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))::BIGINT AS outliers
        FROM {t}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS m,
                          quantile_cont({c}, 0.75) AS q3 FROM {t}) GROUP BY q1, m, q3"""
    for t, c in (("events", "value"),)
)


@query("box_stats", BOX_SQL)
def box_stats(spark, sf_dir):
    return present(profile.box_stats(table(spark, sf_dir, "events"), ["value"]))


@query(
    "outliers",
    """SELECT event_id FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
       WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""",
)
def outliers(spark, sf_dir):
    return profile.outliers(table(spark, sf_dir, "events"), "value").select("event_id")


@query(
    "ols_trend",
    "SELECT " + doubles(slope="regr_slope(l_extendedprice, l_quantity)",
                        intercept="regr_intercept(l_extendedprice, l_quantity)",
                        r2="regr_r2(l_extendedprice, l_quantity)")
    + ", regr_count(l_extendedprice, l_quantity)::BIGINT AS n FROM lineitem",
)
def ols_trend(spark, sf_dir):
    return present(profile.ols_trend(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"))


@query("hourly_mean", f"SELECT hour(ts) AS hour, {R('avg(value)')} AS mean_value FROM events GROUP BY 1")
def hourly_mean(spark, sf_dir):
    return present(profile.hourly_mean(table(spark, sf_dir, "events"), "ts", "value"))


@query("monthly_mean", f"SELECT month(o_orderdate) AS month, {R('avg(o_totalprice)')} AS mean_o_totalprice FROM orders GROUP BY 1")
def monthly_mean(spark, sf_dir):
    return present(profile.monthly_mean(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice"))


@query(
    "weekday_mean",
    f"""SELECT isodow(ts) - 1 AS day_of_week, {R('avg(value)')} AS mean_value,
        list_extract(['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'], isodow(ts)) AS day_name
        FROM events GROUP BY isodow(ts)""",
)
def weekday_mean(spark, sf_dir):
    return present(profile.weekday_mean(table(spark, sf_dir, "events"), "ts", "value"))


@query("target_stats", f"SELECT count(value)::BIGINT AS n, {doubles(mean='avg(value)', std='stddev_samp(value)')} FROM ({GAPPY_SQL})")
def target_stats(spark, sf_dir):
    return present(profile.target_stats(gappy(spark, sf_dir), "value"))


@query(
    "median_impute",
    f"""SELECT event_id, {R('coalesce(value, m)')} AS value
        FROM ({GAPPY_SQL}), (SELECT quantile_cont(value, 0.5) AS m FROM ({GAPPY_SQL}))""",
)
def median_impute(spark, sf_dir):
    df = gappy(spark, sf_dir).select("event_id", "value")
    return present(joins.fill_missing(df, medians(df, ["value"])))


# --- joins ------------------------------------------------------------------

# Views against every other row, so that no event is left out.
SIDES_SQL = """a AS (SELECT user_id, hour(ts) AS hour, max(value) AS aqi, min(value) AS pm25 FROM events
                     WHERE event_type = 'view' GROUP BY 1, 2),
    b AS (SELECT user_id, hour(ts) AS hour, max(CASE WHEN value > 20 THEN value END) AS aqi,
                 count(*)::BIGINT AS readings FROM events WHERE event_type IS DISTINCT FROM 'view' GROUP BY 1, 2)"""
REST = "NOT (event_type <=> 'view')"


def sides(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    by = ["user_id", F.hour("ts").alias("hour")]
    first = events.filter("event_type = 'view'").groupBy(*by).agg(
        F.max("value").alias("aqi"), F.min("value").alias("pm25")
    )
    second = events.filter(REST).groupBy(*by).agg(
        F.max(F.when(F.col("value") > 20, F.col("value"))).alias("aqi"),
        F.count(F.lit(1)).cast("double").alias("readings"),
    )
    return first, second


@query(
    "source_merge",
    f"WITH {SIDES_SQL} SELECT user_id, hour, {doubles(aqi='coalesce(b.aqi, a.aqi)', pm25='pm25', readings='readings')} "
    "FROM a FULL JOIN b USING (user_id, hour)",
)
def source_merge(spark, sf_dir):
    first, second = sides(spark, sf_dir)
    return present(joins.merge_sources(first, second, ["user_id", "hour"]))


@query(
    "source_merge_overwriting",
    f"WITH {SIDES_SQL} SELECT user_id, hour, "
    + doubles(aqi="CASE WHEN readings IS NOT NULL THEN b.aqi ELSE a.aqi END", pm25="pm25", readings="readings")
    + " FROM a FULL JOIN b USING (user_id, hour)",
)
def source_merge_overwriting(spark, sf_dir):
    first, second = sides(spark, sf_dir)
    return present(joins.merge_sources(first, second, ["user_id", "hour"], null_overwrites=True))


@query(
    "combined_snapshot",
    f"""WITH {SIDES_SQL} SELECT user_id, 'station' AS name, {R('24.5')} AS latitude,
        {doubles(aqi='coalesce(b.aqi, a.aqi)', readings='readings')} FROM a FULL JOIN b USING (user_id, hour)""",
)
def combined_snapshot(spark, sf_dir):
    first, second = sides(spark, sf_dir)
    merged = joins.merge_sources(first, second, ["user_id", "hour"])
    record = joins.snapshot(
        merged, {"name": "station", "latitude": 24.5}, ["user_id", "readings"], ["aqi", "pm25"]
    )
    return present(
        record.select("weather.user_id", "location.name", "location.latitude", "aqi.aqi", "weather.readings")
    )


# The whole jobs once had names of their own beside cut ones.
for _name in ("source_merge", "source_merge_overwriting", "combined_snapshot"):
    QUERIES[f"{_name}_all"], ORACLES[f"{_name}_all"] = QUERIES[_name], ORACLES[_name]


@query(
    "apply_reading",
    f"""SELECT e.event_id, {R('e.value - r.value')} AS above_current FROM events e,
        (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1) r""",
)
def apply_reading(spark, sf_dir):
    """One current reading, the newest, beside every history row."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    current = events.agg(F.max_by("value", F.struct("ts", "event_id")).alias("current"))
    both = joins.apply_reading(events, current)
    return present(both.select("event_id", (F.col("value") - F.col("current")).alias("above_current")))


# --- top-k and reshaping ----------------------------------------------------

@query(
    "alert_history",
    f"""SELECT event_id, {level_case(lambda e: repr(e[0]))} AS level FROM events
        WHERE value > 150 ORDER BY ts DESC, event_id DESC LIMIT 20""",
)
def alert_history(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "value")
    alerts = events.withColumn("level", bands.alert(F.col("value"))["level"])
    newest = reshape.newest_alerts(alerts.filter(bands.is_banner(F.col("level"))), ["ts", "event_id"])
    return newest.select("event_id", "level")


@query(
    "alert_history_per_series",
    f"""SELECT event_type, event_id, level FROM (SELECT *, {level_case(lambda e: repr(e[0]), LOWERED)} AS level FROM events)
        WHERE level IN ('hazardous', 'very_unhealthy', 'unhealthy')
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 20""",
)
def alert_history_per_series(spark, sf_dir):
    """The newest banner alerts of each series, under thresholds within reach of the values."""
    events = table(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    alerts = events.withColumn("level", bands.alert(F.col("value"), LOWERED)["level"])
    newest = reshape.newest_alerts(alerts.filter(bands.is_banner(F.col("level"))), ["ts", "event_id"], ["event_type"])
    return newest.select("event_type", "event_id", "level")


@query("head_rows", f"SELECT event_id, {R('value')} AS value FROM events ORDER BY ts, event_id LIMIT 10")
def head_rows(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("ts", "event_id", "value")
    return present(reshape.head(df, ["ts", "event_id"]).drop("ts"))


@query("top_rows", f"SELECT event_id, {R('value')} AS value FROM events ORDER BY value DESC, event_id LIMIT 15")
def top_rows(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "value")
    return present(reshape.top_rows(df, "value", reshape.TOP_FEATURES, ["event_id"]))


@query(
    "sample_hash",
    f"""SELECT event_id, {R('value')} AS value FROM events
        ORDER BY md5('42:' || event_id), event_id LIMIT {reshape.SAMPLE_ROWS}""",
)
def sample_hash(spark, sf_dir):
    """The same hundred rows for the same seed."""
    return present(reshape.seeded_sample(table(spark, sf_dir, "events").select("event_id", "value"), "event_id"))


@query(
    "unpivot_latest",
    f"""WITH l AS (SELECT * FROM ({HOURLY_SQL}) QUALIFY row_number() OVER (PARTITION BY series_key ORDER BY datetime DESC) = 1)
        SELECT series_key, name, {R('value')} AS value FROM
        (SELECT series_key, pm25, pm10, no2, o3 FROM l) UNPIVOT (value FOR name IN (pm25, pm10, no2, o3))""",
)
def unpivot_latest(spark, sf_dir):
    columns = ("pm25", "pm10", "no2", "o3", "so2", "co")
    return present(reshape.latest_long(hourly(spark, sf_dir), ["series_key"], ["datetime"], columns))


IMPORTANCE_SQL = """SELECT l_returnflag AS model, l_linestatus AS feature, avg(abs(l_tax - l_discount)) AS importance
    FROM lineitem GROUP BY 1, 2"""


def importance(spark, sf_dir):
    from airloom.ml.explain import mean_absolute

    return mean_absolute(
        table(spark, sf_dir, "lineitem").select(
            F.col("l_returnflag").alias("model"), F.col("l_linestatus").alias("feature"),
            (F.col("l_tax") - F.col("l_discount")).alias("contribution"),
        )
    )


@query("mean_attribution", f"SELECT model, feature, {R('importance')} AS importance FROM ({IMPORTANCE_SQL})")
def mean_attribution(spark, sf_dir):
    return present(importance(spark, sf_dir))


@query(
    "importance_pivot",
    f"""SELECT model, {R("max(importance) FILTER (feature = 'F')")} AS F,
        {R("max(importance) FILTER (feature = 'O')")} AS O FROM ({IMPORTANCE_SQL}) GROUP BY model""",
)
def importance_pivot(spark, sf_dir):
    return present(reshape.importance_wide(importance(spark, sf_dir), ["F", "O"]))


@query("importance_unpivot", f"SELECT model, feature, {R('importance')} AS importance FROM ({IMPORTANCE_SQL})")
def importance_unpivot(spark, sf_dir):
    wide = reshape.importance_wide(importance(spark, sf_dir), ["F", "O"])
    return present(reshape.importance_long(wide, ["F", "O"]))


@query(
    "results_table",
    f"""SELECT o_orderpriority AS model, {doubles(rmse_mean='stddev_pop(o_totalprice)', mae_mean='avg(o_totalprice)')}
        FROM orders GROUP BY 1""",
)
def results_table(spark, sf_dir):
    """Nested maps of results, as results files hold them, to one row per model."""
    per_model = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(
        F.stddev_pop("o_totalprice").alias("rmse_mean"), F.avg("o_totalprice").alias("mae_mean")
    )
    nested = per_model.select(
        F.create_map("o_orderpriority", F.struct("rmse_mean", "mae_mean")).alias("all_results")
    )
    return present(reshape.results_long(nested, "all_results"))


# --- tables, versions, registry ---------------------------------------------

@query("latest_snapshot", f"""SELECT event_id FROM events
       WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_snapshot(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", F.to_date("ts").alias("snapshot_id"))
    return tables.latest_snapshot(df).select("event_id")


@query(
    "newest_file",
    f"SELECT event_id, {R('value')} AS value FROM events WHERE event_id % 3 = 2",
)
def newest_file(spark, sf_dir):
    """Of three files, written one after the other, the last one is read."""
    import uuid

    folder = f"{shared_folder(spark)}/airloom/files-{uuid.uuid4().hex}"
    df = table(spark, sf_dir, "events").select("event_id", "value")
    for k in range(3):
        df.filter(F.col("event_id") % 3 == k).coalesce(1).write.mode("append").parquet(folder)
    return present(tables.newest_file(spark, folder))


@query(
    "results_json",
    f"SELECT o_orderpriority AS model, {R('avg(o_totalprice)')} AS rmse_mean, count(*)::BIGINT AS n_folds FROM orders GROUP BY 1",
)
def results_json(spark, sf_dir):
    """Results written as JSON and read back under their schema."""
    import uuid

    path = f"{shared_folder(spark)}/airloom/results-{uuid.uuid4().hex}"
    results = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("model")).agg(
        F.avg("o_totalprice").alias("rmse_mean"), F.count(F.lit(1)).alias("n_folds")
    )
    tables.write_results(results, path)
    return present(tables.read_table(spark, path, results.schema, "json"))


@query(
    "csv_table",
    f"SELECT event_id, {TS('ts')} AS ts, {R('value')} AS value FROM events",
)
def csv_table(spark, sf_dir):
    """Rows written as CSV with their times as text, read back under a declared schema."""
    import uuid

    path = f"{shared_folder(spark)}/airloom/csv-{uuid.uuid4().hex}"
    df = table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "value")
    tables.write_csv(df, path)
    back = tables.read_table(spark, path, "event_id bigint, ts string, value double", "csv")
    return present(back.withColumn("ts", F.try_to_timestamp("ts")))


@query(
    "stored_days",
    f"""SELECT event_id, {R('value')} AS value FROM events
        WHERE ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-12'""",
)
def stored_days(spark, sf_dir):
    """Written by day, read back pruned to a trailing range."""
    import datetime as dt
    import uuid

    path = f"{shared_folder(spark)}/airloom/days-{uuid.uuid4().hex}"
    df = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("datetime"), "value")
    tables.write_features(df, path)
    out = tables.read_recent(spark, path, dt.datetime(2024, 1, 12), days=7)
    return present(out.select("event_id", "value"))


@query(
    "versioned_union",
    f"""SELECT event_id, {R('value')} AS value, NULL::DOUBLE AS doubled, 1::BIGINT AS version FROM events WHERE event_type = 'view'
        UNION ALL SELECT event_id, {R('value')}, {R('value * 2')}, 2 FROM events WHERE event_type IS DISTINCT FROM 'view'""",
)
def versioned_union(spark, sf_dir):
    """Two versions of a feature table, the second with one more column."""
    return present(tables.read_all_versions(spark, two_versions(spark, sf_dir)))


def two_versions(spark, sf_dir):
    import uuid

    root = f"{shared_folder(spark)}/airloom/versions-{uuid.uuid4().hex}"
    df = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    tables.insert_version(df.filter("event_type = 'view'").drop("event_type"), root, 1)
    second = df.filter(REST).drop("event_type")
    tables.insert_version(second.withColumn("doubled", F.col("value") * 2), root, 2)
    return root


QUERIES["versioned_union_all"], ORACLES["versioned_union_all"] = versioned_union, ORACLES["versioned_union"]


@query(
    "version_fallback",
    f"""SELECT 7::BIGINT AS asked, event_id, {R('value')} AS value FROM events WHERE event_type IS DISTINCT FROM 'view'
        UNION ALL SELECT 1, event_id, {R('value')} FROM events WHERE event_type = 'view'""",
)
def version_fallback(spark, sf_dir):
    """A version that is missing gives the fallback's rows, one that is there its own."""
    root = two_versions(spark, sf_dir)
    parts = [tables.read_version(spark, root, v, fallback=2).withColumn("asked", F.lit(v)) for v in (7, 1)]
    return present(parts[0].drop("doubled").unionByName(parts[1]).select("asked", "event_id", "value"))


@query(
    "upsert",
    f"""SELECT event_id, {R("CASE WHEN event_type = 'view' THEN value + 1 ELSE value END")} AS value FROM events""",
)
def upsert(spark, sf_dir):
    """Corrected rows take the place of those with the same key, applied twice."""
    df = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    fixed = df.filter("event_type = 'view'").withColumn("value", F.col("value") + 1)
    once = tables.upsert(df, fixed, ["event_id"])
    return present(tables.upsert(once, fixed, ["event_id"]).drop("event_type"))


@query(
    "model_registry",
    "SELECT o_orderpriority AS model_name, (max(year(o_orderdate)) + 1)::BIGINT AS next_version FROM orders GROUP BY 1",
)
def model_registry(spark, sf_dir):
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model_name"), F.year("o_orderdate").cast("bigint").alias("version")
    )
    return present(tables.next_version(entries))
