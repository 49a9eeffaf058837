"""Queries: payload reading, projections, bands and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.functions import atmosphere, bands, calendar
from airloom.ml import forecast
from airloom.operators import joins
from airloom.queries.common import (
    HOURLY_SQL, R, TS, WEATHER_SQL, hourly, present, table, weather_lines,
)
from airloom.schemas import (
    OBSERVATION_COLUMNS, WEATHER, observation_rules, request_rules, with_defaults, with_reasons,
)
from airloom.sources import payloads

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add


def ints(**columns) -> str:
    return ", ".join(f"CAST({x} AS BIGINT) AS {c}" for c, x in columns.items())


def flag_sql(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def calendar_sql(t: str) -> dict[str, str]:
    return {
        "hour": f"hour({t})",
        "day_of_week": f"isodow({t}) - 1",
        "day_of_month": f"day({t})",
        "month": f"month({t})",
        "day_of_year": f"dayofyear({t})",
        "year": f"year({t})",
        "week_of_year": f"week({t})",
        "is_weekend": flag_sql(f"isodow({t}) IN (6, 7)"),
        "is_rush_hour": flag_sql(f"hour({t}) IN (7, 8, 9, 17, 18, 19)"),
    }


def season_sql(t: str) -> dict[str, str]:
    return {
        "is_monsoon": flag_sql(f"month({t}) IN (6, 7, 8, 9)"),
        "is_winter": flag_sql(f"month({t}) IN (12, 1, 2)"),
        "is_summer": flag_sql(f"month({t}) IN (5, 6, 7)"),
    }


def cyclical_sql(t: str) -> dict[str, str]:
    values = calendar_sql(t)
    out = {}
    for c in calendar.CYCLE_DEFAULTS:
        for f in ("sin", "cos"):
            out[f"{c}_{f}"] = f"{f}(({values[c]}) * (2 * pi()) / {calendar.CYCLE_PERIODS[c]})"
    return out


def doubles(**columns) -> str:
    return ", ".join(f"{R(x)} AS {c}" for c, x in columns.items())


# --- calendar ---------------------------------------------------------------

@query("time_features", f"SELECT o_orderkey, {ints(**calendar_sql('o_orderdate'))} FROM orders")
def time_features(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return present(calendar.add_time_features(df, "o_orderdate").drop("o_orderdate"))


@query(
    "text_times",
    "SELECT o_orderkey, "
    + ints(**{k: f"coalesce({x}, -1)" for k, x in calendar_sql("(CASE WHEN o_orderkey % 10 <> 0 THEN o_orderdate END)").items()})
    + " FROM orders",
)
def text_times(spark, sf_dir):
    """Calendar columns of times read as text; every tenth is no time and shown as -1."""
    text = F.when(F.col("o_orderkey") % 10 == 0, "not a time").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("at"))
    return present(calendar.add_time_features(df, "at").drop("at").na.fill(-1))


@query(
    "time_features_local",
    "SELECT event_id, "
    + ints(**calendar_sql("(ts + INTERVAL 5 HOUR)"))
    + " FROM events",
)
def time_features_local(spark, sf_dir):
    """Calendar of local time, five hours ahead of UTC."""
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    return present(calendar.add_time_features(df, "ts", zone="Asia/Tashkent").drop("ts"))


@query("cyclical_encoding", f"SELECT event_id, {doubles(**cyclical_sql('ts'))} FROM events")
def cyclical_encoding(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", "ts")
    coded = calendar.add_cyclical(calendar.add_time_features(df, "ts"))
    return present(coded.select("event_id", *[c for c in coded.columns if c[-4:] in ("_sin", "_cos")]))


@query("season_flags", f"SELECT o_orderkey, {ints(**season_sql('o_orderdate'))}, "
       "CAST(floor((month(o_orderdate) % 12) / 3) AS BIGINT) AS season FROM orders")
def season_flags(spark, sf_dir):
    month = F.month("o_orderdate")
    return present(
        table(spark, sf_dir, "orders").select(
            "o_orderkey",
            *[x.alias(c) for c, x in calendar.season_columns(month).items()],
            calendar.season_number(month).alias("season"),
        )
    )


# The events lie in January; eighty days later they meet the spring holidays.
SPRING = "CAST(ts + INTERVAL 80 DAY AS DATE)"
HOLIDAY_LIST = ", ".join(f"DATE '{d}'" for d in calendar.HOLIDAYS)


def spring_events(spark, sf_dir):
    shifted = F.col("ts") + F.expr("INTERVAL 80 DAYS")
    return table(spark, sf_dir, "events").select("event_id", "value", shifted.alias("datetime"))


@query("holiday_flag", f"SELECT event_id, {ints(is_holiday=flag_sql(f'{SPRING} IN ({HOLIDAY_LIST})'))} FROM events")
def holiday_flag(spark, sf_dir):
    return present(calendar.add_holiday(spring_events(spark, sf_dir)).select("event_id", "is_holiday"))


@query("holiday_semi", f"SELECT event_id, {R('value')} AS value FROM events WHERE {SPRING} IN ({HOLIDAY_LIST})")
def holiday_semi(spark, sf_dir):
    return present(calendar.on_holidays(spring_events(spark, sf_dir), "datetime").drop("datetime"))


@query("holiday_anti", f"SELECT event_id, {R('value')} AS value FROM events WHERE {SPRING} NOT IN ({HOLIDAY_LIST})")
def holiday_anti(spark, sf_dir):
    return present(
        calendar.on_holidays(spring_events(spark, sf_dir), "datetime", keep=False).drop("datetime")
    )


# --- weather and pollutants -------------------------------------------------

INTERACTION_SQL = {
    "temp_humidity_interaction": "temperature_2m * relative_humidity_2m",
    "wind_pressure_interaction": "wind_speed_10m * pressure_msl / 1000",
    "visibility_humidity_interaction": "visibility / (relative_humidity_2m + 1)",
}
RISK_SQL = {
    "wind_from_sea": flag_sql("wind_direction_10m >= 180 AND wind_direction_10m <= 270"),
    "temp_inversion_risk": flag_sql("pressure_msl > 1015 AND cloud_cover < 30 AND temperature_2m < 20"),
    "pollution_accumulation_risk": flag_sql(
        "wind_speed_10m < 5 AND pressure_msl > 1010 AND precipitation = 0"
    ),
}


@query("interactions", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {doubles(**INTERACTION_SQL)} FROM ({WEATHER_SQL})")
def interactions(spark, sf_dir):
    df = atmosphere.add_weather_interactions(weather_lines(spark, sf_dir))
    return present(df.select("l_orderkey", "l_linenumber", *INTERACTION_SQL))


@query("threshold_flags", f"SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {ints(**RISK_SQL)} FROM ({WEATHER_SQL})")
def threshold_flags(spark, sf_dir):
    df = atmosphere.add_weather_interactions(weather_lines(spark, sf_dir))
    return present(df.select("l_orderkey", "l_linenumber", *RISK_SQL))


@query(
    "ratios",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
    + doubles(pm25_pm10_ratio="pm25 / (pm10 + 1e-6)", no2_o3_ratio="no2 / (o3 + 1e-6)")
    + f" FROM ({WEATHER_SQL})",
)
def ratios(spark, sf_dir):
    df = atmosphere.add_pollutant_ratios(weather_lines(spark, sf_dir))
    return present(df.select("l_orderkey", "l_linenumber", "pm25_pm10_ratio", "no2_o3_ratio"))


@query(
    "composite_index",
    "SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, "
    + doubles(
        pollution_index="0.4 * pm25 + 0.3 * pm10 + 0.2 * no2 + 0.1 * o3",
        without_o3="(0.4 * pm25 + 0.3 * pm10 + 0.2 * no2) / 0.9",
    )
    + f" FROM ({WEATHER_SQL})",
)
def composite_index(spark, sf_dir):
    df = weather_lines(spark, sf_dir)
    partial = atmosphere.composite_column({"pm25", "pm10", "no2"})
    return present(
        atmosphere.add_composite_index(df).select(
            "l_orderkey", "l_linenumber", "pollution_index", partial.alias("without_o3")
        )
    )


ESTIMATE = (
    "greatest(30.0, least(500.0, {base} + (coalesce(temperature_2m, 25) - 25) * 0.5::DOUBLE"
    " + (coalesce(relative_humidity_2m, 50) - 50) * 0.3::DOUBLE"
    " - coalesce(wind_speed_10m, 10) * 0.5::DOUBLE"
    " + (coalesce(pressure_msl, 1013) - 1013) * 0.1::DOUBLE - coalesce(cloud_cover, 0) * 0.1::DOUBLE))"
)


@query(
    "estimate_target",
    f"""WITH w AS (SELECT *, coalesce(CASE WHEN aqi > 450 THEN NULL ELSE aqi END, 120) AS base
                   FROM ({WEATHER_SQL})),
         e AS (SELECT *, {ESTIMATE.format(base='base')} AS est FROM w),
         r AS (SELECT *, CASE WHEN base > 0 THEN est / base ELSE 1 END AS ratio FROM e)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, {R('est')} AS estimate,
           {R('coalesce(pm25, 45) * ratio')} AS pm25, {R('coalesce(pm10, 70) * ratio')} AS pm10,
           {R('coalesce(no2, 35) * ratio * 0.3::DOUBLE')} AS so2, {R('est / 100 * 2.5::DOUBLE')} AS co,
           CASE WHEN est > 100 THEN 'pm25' ELSE 'o3' END AS main_pollutant
    FROM r""",
)
def estimate_target(spark, sf_dir):
    """Values before their one-decimal rounding, which ties to even on the binary value."""
    df = weather_lines(spark, sf_dir)
    base = F.when(F.col("aqi") <= 450, F.col("aqi"))
    raw = atmosphere.estimate_columns(base, {k: F.col(k) for k in atmosphere.POLLUTANTS}, digits=None)
    return present(
        df.select(
            "l_orderkey", "l_linenumber", raw["aqi"].alias("estimate"),
            *[raw[k].alias(k) for k in ("pm25", "pm10", "so2", "co", "main_pollutant")],
        )
    )


@query(
    "impute_target",
    f"""WITH w AS (SELECT * REPLACE (CASE WHEN aqi > 450 THEN NULL ELSE aqi END AS aqi)
                   FROM ({WEATHER_SQL})),
         e AS (SELECT *, {ESTIMATE.format(base='120')} AS est FROM w)
    SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
           {R('CASE WHEN aqi IS NULL THEN round_even(est, 1) ELSE aqi END', 2)} AS aqi,
           CAST(aqi IS NULL AS BIGINT) AS is_estimated
    FROM e""",
)
def impute_target(spark, sf_dir):
    df = weather_lines(spark, sf_dir).withColumns(
        {"aqi": F.when(F.col("aqi") <= 450, F.col("aqi")), "base_aqi": F.lit(120.0)}
    )
    filled = atmosphere.impute_target(df)
    return present(filled.select("l_orderkey", "l_linenumber", "aqi", "is_estimated"), digits=2)


# --- bands and alerts -------------------------------------------------------

CATEGORY_SQL = {
    "aqi_good": flag_sql("{v} <= 50"),
    "aqi_moderate": flag_sql("{v} > 50 AND {v} <= 100"),
    "aqi_unhealthy_sensitive": flag_sql("{v} > 100 AND {v} <= 150"),
    "aqi_unhealthy": flag_sql("{v} > 150 AND {v} <= 200"),
    "aqi_very_unhealthy": flag_sql("{v} > 200 AND {v} <= 300"),
    "aqi_hazardous": flag_sql("{v} > 300"),
}
# Events with gaps: the largest values are taken as missing.
GAPPY_SQL = "SELECT * REPLACE (CASE WHEN value > 200 THEN NULL ELSE value END AS value) FROM events"


def gappy(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn(
        "value", F.when(F.col("value") <= 200, F.col("value"))
    )


@query(
    "category_onehot",
    f"SELECT event_id, {ints(**{c: s.format(v='value') for c, s in CATEGORY_SQL.items()})} FROM ({GAPPY_SQL})",
)
def category_onehot(spark, sf_dir):
    df = bands.add_category_flags(gappy(spark, sf_dir), "value")
    return present(df.select("event_id", *bands.CATEGORY_EDGES))


def ladder_sql(pairs, otherwise) -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {x}" for c, x in pairs) + f" ELSE {otherwise} END"


def category_case(values) -> str:
    edges = [f"value <= {row[5]}" if row[5] else "value > 300" for row in bands.CATEGORIES]
    return ladder_sql(zip(edges, values), "NULL")


CATEGORY_COLUMNS_SQL = (
    f"{category_case([repr(r[0]) for r in bands.CATEGORIES])} AS label, "
    f"{category_case([repr(r[1]) for r in bands.CATEGORIES])} AS colour, "
    f"CAST({category_case([r[2] for r in bands.CATEGORIES])} AS DOUBLE) AS low, "
    f"CAST({category_case([r[3] for r in bands.CATEGORIES])} AS DOUBLE) AS high"
)


def limits(prefix=""):
    return [F.col(prefix + c).cast("double").alias(c) for c in ("low", "high")]


@query("category_ladder", f"SELECT event_id, {CATEGORY_COLUMNS_SQL} FROM ({GAPPY_SQL})")
def category_ladder(spark, sf_dir):
    df = gappy(spark, sf_dir).select("event_id", bands.category(F.col("value")).alias("band"))
    return present(df.select("event_id", "band.label", "band.colour", *limits("band.")))


@query("category_band_join", f"SELECT event_id, {CATEGORY_COLUMNS_SQL} FROM ({GAPPY_SQL})")
def category_band_join(spark, sf_dir):
    df = bands.join_category(gappy(spark, sf_dir), "value")
    return present(df.select("event_id", "label", "colour", *limits()))


def level_case(pick, thresholds=bands.THRESHOLDS) -> str:
    pairs = [(f"value > {thresholds[e[0]]}", pick(e)) for e in bands.LADDER[:-1]]
    pairs.append(("value IS NOT NULL", pick(bands.LADDER[-1])))
    return ladder_sql(pairs, "NULL")


RAISED = {**bands.THRESHOLDS, "hazardous": 400}
# Within reach of the observations, so that every level occurs.
LOWERED = {**bands.THRESHOLDS, "good": 40, "moderate": 60, "unhealthy_sensitive": 80, "unhealthy": 100, "very_unhealthy": 120, "hazardous": 140}


@query(
    "alert_ladder",
    f"SELECT event_id, {level_case(lambda e: repr(e[0]))} AS level, "
    f"{level_case(lambda e: repr(e[1]))} AS type, "
    f"{level_case(lambda e: repr(e[0]), RAISED)} AS raised_level FROM ({GAPPY_SQL})",
)
def alert_ladder(spark, sf_dir):
    """Levels under the default thresholds and under a raised hazardous one."""
    df = gappy(spark, sf_dir)
    stored = bands.read_thresholds(bands.threshold_table(spark, RAISED))
    default, raised = bands.alert(F.col("value")), bands.alert(F.col("value"), stored)
    return present(df.select("event_id", default["level"].alias("level"),
                             default["type"].alias("type"), raised["level"].alias("raised_level")))


MESSAGE_SQL = level_case(
    lambda e: f"'{e[3]}' || CAST(whole AS VARCHAR) || '{e[4]}'"
)
WHOLE_SQL = f"SELECT *, CAST(floor(value) AS BIGINT) AS whole FROM ({GAPPY_SQL})"


@query("alert_message", f"SELECT event_id, {MESSAGE_SQL.replace('value', 'whole')} AS message FROM ({WHOLE_SQL})")
def alert_message(spark, sf_dir):
    df = gappy(spark, sf_dir)
    return df.select("event_id", bands.alert(F.floor("value"))["message"].alias("message"))


@query("status_card", f"SELECT event_id, {level_case(lambda e: repr(e[2]))} AS status FROM ({GAPPY_SQL})")
def status_card(spark, sf_dir):
    return gappy(spark, sf_dir).select("event_id", bands.status(F.col("value")).alias("status"))


@query(
    "advisory",
    "SELECT event_id, CASE WHEN value > 200 THEN 'unhealthy' WHEN value > 150 THEN 'unhealthy_sensitive' "
    "WHEN value > 100 THEN 'moderate' WHEN value IS NOT NULL THEN 'good' END AS advisory FROM events",
)
def advisory(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    return df.select("event_id", bands.advisory(F.col("value")).alias("advisory"))


@query(
    "banner_alerts",
    f"SELECT * FROM (SELECT event_id, {level_case(lambda e: repr(e[0]), RAISED)} AS level FROM events) "
    "WHERE level IN ('hazardous', 'very_unhealthy', 'unhealthy')",
)
def banner_alerts(spark, sf_dir):
    df = table(spark, sf_dir, "events")
    leveled = df.select("event_id", bands.alert(F.col("value"), RAISED)["level"].alias("level"))
    return leveled.filter(bands.is_banner(F.col("level")))


@query(
    "forecast_alerts",
    f"""WITH h AS (SELECT series_key, datetime, aqi, row_number() OVER (PARTITION BY series_key ORDER BY datetime DESC) AS back,
               max(datetime) OVER (PARTITION BY series_key) AS last FROM ({HOURLY_SQL})),
        f AS (SELECT series_key, last + ahead * INTERVAL 1 HOUR AS t, aqi FROM h, range(1, 73) r(ahead)
              WHERE back <= 24 AND (ahead - 1) % 24 = 24 - back),
        d AS (SELECT series_key, CAST(t AS DATE) AS day, max(aqi) AS value FROM f GROUP BY 1, 2),
        l AS (SELECT *, {level_case(lambda e: repr(e[0]), LOWERED)} AS level FROM d)
        SELECT series_key, strftime(day, '%Y-%m-%d') AS day, {R('value')} AS highest, level,
               level IN ('hazardous', 'very_unhealthy', 'unhealthy') AS has_alert,
               strftime(day, '%A, %b %d') AS day_name FROM l""",
)
def forecast_alerts(spark, sf_dir):
    """Alerts on the next three days of each series, as the last day's repetition forecasts them."""
    rows = hourly(spark, sf_dir).select("series_key", "datetime", "aqi")
    ahead = forecast.seasonal_forecast(rows, "aqi", ["series_key"], "datetime")
    return present(forecast.daily_alerts(ahead, ["series_key"], "datetime", LOWERED))


@query(
    "alert_display",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M') AS shown_time,
        {level_case(lambda e: repr(' '.join(p.capitalize() for p in e[0].split('_'))))} AS shown_level,
        substring({MESSAGE_SQL.replace('value', 'whole')}, 1, 80) || '...' AS shown_message
        FROM ({WHOLE_SQL})""",
)
def alert_display(spark, sf_dir):
    df = gappy(spark, sf_dir)
    return df.select(
        "event_id",
        bands.minute_text(F.col("ts")).alias("shown_time"),
        bands.level_title(bands.alert(F.col("value"))["level"]).alias("shown_level"),
        bands.shortened(bands.alert(F.floor("value"))["message"]).alias("shown_message"),
    )


# --- validation -------------------------------------------------------------

@query(
    "validate_rows",
    f"""SELECT event_id, CAST(value IS NOT NULL AND k BETWEEN 1 AND 168 AS BIGINT) AS valid,
        CASE WHEN value IS NULL THEN 'aqi_required' ELSE '' END ||
        CASE WHEN value IS NULL AND k NOT BETWEEN 1 AND 168 THEN ',' ELSE '' END ||
        CASE WHEN k NOT BETWEEN 1 AND 168 THEN 'hours_ahead_range' ELSE '' END AS reasons,
        'UTC' AS timezone
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM ({GAPPY_SQL}))""",
)
def validate_rows(spark, sf_dir):
    df = gappy(spark, sf_dir).select(
        "event_id", F.col("ts").alias("datetime"), F.col("value").alias("aqi"),
        F.get_json_object("props", "$.k").cast("int").alias("hours_ahead"),
    )
    checked = with_defaults(with_reasons(df, observation_rules() | request_rules()), {"timezone": "UTC"})
    return present(
        checked.select(
            "event_id", calendar.flag(F.size("reasons") == 0).alias("valid"),
            F.concat_ws(",", "reasons").alias("reasons"), "timezone",
        )
    )


@query(
    "latest_fallback",
    f"""SELECT event_id, {R('coalesce(value, 120)')} AS shown_aqi, {R('60')} AS shown_humidity
        FROM ({GAPPY_SQL})""",
)
def latest_fallback(spark, sf_dir):
    df = gappy(spark, sf_dir)
    return present(
        df.select(
            "event_id",
            joins.first_present(df, "value", "aqi_predicted", default=120.0).alias("shown_aqi"),
            joins.first_present(df, "relative_humidity_2m", default=60.0).alias("shown_humidity"),
        )
    )


# --- payloads ---------------------------------------------------------------

def observation_sql(columns, source: str, frm: str, keys="series_key") -> str:
    return (
        f"SELECT {keys}, {TS('datetime')} AS datetime, "
        + ", ".join(f"{R(c)} AS {c}" for c in columns)
        + f", '{source}' AS source FROM ({frm})"
    )


@query(
    "payload_hourly_archive",
    observation_sql(WEATHER[:6], "open-meteo", HOURLY_SQL).replace(
        ", 'open-meteo'", ", CAST(NULL AS DOUBLE) AS cloud_cover, 'open-meteo'"
    ),
)
def payload_hourly_archive(spark, sf_dir):
    """One payload per series and day: parallel arrays, cloud cover absent."""
    return present(payloads.hourly_archive(archive_payloads(spark, sf_dir), "payload", ["series_key"]))


@query(
    "payload_zones",
    f"SELECT series_key, {TS('datetime - INTERVAL 5 HOUR')} AS datetime, {R('temperature_2m')} AS temperature_2m FROM ({HOURLY_SQL})",
)
def payload_zones(spark, sf_dir):
    """The same payloads with times local to a zone five hours ahead, read as instants."""
    landed = archive_payloads(spark, sf_dir)
    rows = payloads.hourly_archive(landed, "payload", ["series_key"], zone="Asia/Karachi")
    return present(rows.select("series_key", "datetime", "temperature_2m"))


def archive_payloads(spark, sf_dir):
    rows = hourly(spark, sf_dir)
    day = F.sort_array(F.collect_list(F.struct("datetime", *WEATHER)))  # at most 24 hours
    days = rows.groupBy("series_key", F.to_date("datetime").alias("day")).agg(day.alias("d"))
    payload = F.to_json(
        F.struct(
            F.struct(
                F.transform("d", lambda r: F.date_format(r["datetime"], "yyyy-MM-dd'T'HH:mm")).alias("time"),
                *[F.col("d").getField(c).alias(c) for c in WEATHER[:6]],
            ).alias("hourly")
        )
    )
    return days.select("series_key", payload.alias("payload"))


@query("payload_current", observation_sql(WEATHER, "open-meteo", HOURLY_SQL))
def payload_current(spark, sf_dir):
    rows = hourly(spark, sf_dir)
    payload = F.to_json(
        F.struct(
            F.struct(F.date_format("datetime", "yyyy-MM-dd'T'HH:mm").alias("time"), *WEATHER).alias("current")
        )
    )
    landed = rows.select("series_key", payload.alias("payload"))
    return present(payloads.current_weather(landed, "payload", ["series_key"]))


def station_payloads(spark, sf_dir):
    """Station payloads: pm25 as an object, pm10 as a number; errors fail."""
    events = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    text = F.format_string(
        '{"status":"%s","data":{"aqi":%s,"time":{"s":"%s"},"dominentpol":"pm25",'
        '"iaqi":{"pm25":{"v":%s},"pm10":%s},"forecast":{"daily":{"o3":[%s]}}}}',
        F.when(F.col("event_type") == "error", "error").otherwise("ok"),
        F.col("value").cast("string"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.col("value").cast("string"), k, k,
    )
    return events.select("event_id", text.alias("payload"))


@query(
    "payload_station",
    f"""SELECT event_id, {TS('ts')} AS datetime, {R('value')} AS aqi, {R('value')} AS pm25,
        {R("CAST(json_extract_string(props, '$.k') AS DOUBLE)")} AS pm10, CAST(NULL AS DOUBLE) AS o3,
        'pm25' AS main_pollutant, '{{"o3":[' || json_extract_string(props, '$.k') || ']}}' AS forecast,
        2::BIGINT AS pollutants, 'aqicn' AS source FROM events WHERE event_type <> 'error'""",
)
def payload_station(spark, sf_dir):
    rows = payloads.station_aqi(station_payloads(spark, sf_dir), "payload", ["event_id"])
    return present(
        rows.select("event_id", "datetime", "aqi", "pm25", "pm10", "o3", "main_pollutant",
                    "forecast", F.size("pollutants").alias("pollutants"), "source")
    )


@query("payload_station_rejects", "SELECT event_id FROM events WHERE event_type = 'error'")
def payload_station_rejects(spark, sf_dir):
    return payloads.station_status(station_payloads(spark, sf_dir), "payload")[1].select("event_id")


POLLUTION_SQL = f"""SELECT series_key, datetime, CAST(floor(aqi) AS DOUBLE) AS aqi, pm25, pm10, no2, o3
    FROM ({HOURLY_SQL})"""


def pollution_payloads(spark, sf_dir):
    """One payload per series and day with its hours in a list, newest first."""
    item = F.struct(
        F.unix_timestamp("datetime").alias("dt"),
        F.struct(F.floor("aqi").cast("int").alias("aqi")).alias("main"),
        F.struct(F.col("pm25").alias("pm2_5"), "pm10", "no2", "o3").alias("components"),
    )
    days = hourly(spark, sf_dir).groupBy("series_key", F.to_date("datetime").alias("day")).agg(
        F.sort_array(F.collect_list(item), asc=False).alias("list")  # at most 24 hours
    )
    return days.select("series_key", F.to_json(F.struct("list")).alias("payload"))


@query(
    "payload_pollution_forecast",
    observation_sql(("aqi", "pm25", "pm10", "no2", "o3"), "openweathermap", POLLUTION_SQL),
)
def payload_pollution_forecast(spark, sf_dir):
    landed = pollution_payloads(spark, sf_dir)
    return present(payloads.pollution_forecast(landed, "payload", ["series_key"]))


@query(
    "payload_pollution_current",
    observation_sql(
        ("aqi", "pm25", "pm10", "no2", "o3"), "openweathermap",
        f"SELECT * FROM ({POLLUTION_SQL}) QUALIFY row_number() OVER "
        "(PARTITION BY series_key, CAST(datetime AS DATE) ORDER BY datetime DESC) = 1",
    ),
)
def payload_pollution_current(spark, sf_dir):
    rows = payloads.pollution_current(pollution_payloads(spark, sf_dir), "payload", ["series_key"])
    return present(rows.drop("so2", "co"))


@query(
    "payload_detail",
    f"""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:00') AS datetime, {R('value')} AS temperature_2m,
        {R('CASE WHEN k IS NULL OR k = 0 THEN 10 ELSE k END * 1000')} AS visibility,
        {R('value')} AS pm2_5, 'weatherapi' AS source
        FROM (SELECT *, nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE) % 10, 5) AS k FROM events)""",
)
def payload_detail(spark, sf_dir):
    k = F.nullif(F.get_json_object("props", "$.k").cast("double") % 10, F.lit(5.0))
    text = F.to_json(
        F.struct(
            F.struct(
                F.date_format("ts", "yyyy-MM-dd HH:mm").alias("last_updated"),
                F.col("value").alias("temp_c"),
                k.alias("vis_km"),
                F.create_map(F.lit("pm2_5"), F.col("value")).alias("air_quality"),
            ).alias("current")
        )
    )
    landed = table(spark, sf_dir, "events").select("event_id", text.alias("payload"))
    rows = payloads.current_detail(landed, "payload", ["event_id"])
    return present(
        rows.select("event_id", "datetime", "temperature_2m", "visibility",
                    F.col("air_quality")["pm2_5"].alias("pm2_5"), "source")
    )


@query(
    "flatten_observations",
    f"""SELECT series_key, {TS('datetime')} AS datetime,
        {', '.join(f'{R(c)} AS {c}' for c in OBSERVATION_COLUMNS[1:-1])}, 'unknown' AS source
        FROM ({HOURLY_SQL})""",
)
def flatten_observations(spark, sf_dir):
    """Nested records: weather in a struct, target and pollutants in another."""
    rows = hourly(spark, sf_dir)
    nested = rows.select(
        "series_key", "datetime", F.struct(*WEATHER).alias("weather"),
        F.struct(F.col("aqi").alias("aqi_value"), "pm25", "pm10", "no2", "o3").alias("aqi"),
    )
    return present(payloads.flatten_observations(nested, ["series_key"]))
