"""Payload edge cases, merges, tables and versions."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from airloom.operators import joins, ranges, reshape
from airloom.sources import payloads, tables


def landed(spark, *documents):
    rows = [(str(i), json.dumps(d) if isinstance(d, dict) else d) for i, d in enumerate(documents)]
    return spark.createDataFrame(rows, "k string, payload string")


def test_hourly_archive_pads(spark):
    df = landed(
        spark,
        {"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00", "bad"], "temperature_2m": [1.5]}},
        {"hourly": {}},
        "not json",
    )
    rows = payloads.hourly_archive(df, "payload", ["k"]).collect()
    assert len(rows) == 3
    assert [r.temperature_2m for r in rows] == [1.5, None, None]
    assert rows[1].datetime == dt.datetime(2024, 1, 1, 1) and rows[2].datetime is None
    assert rows[0].cloud_cover is None and rows[0].source == "open-meteo"


def test_station_payload(spark):
    def body(**more):
        return {"status": "ok", "data": {"aqi": 80, "time": {"s": "2024-01-01 05:00:00"}, **more}}

    df = landed(
        spark,
        body(iaqi={"pm25": {"v": 12.5}, "pm10": 7, "o3": "-"}, dominentpol="pm25",
             forecast={"daily": {"o3": [1]}}),
        body(),
        {"status": "error", "data": "Invalid key"},
    )
    rows = payloads.station_aqi(df, "payload", ["k"]).collect()
    assert [r.k for r in rows] == ["0", "1"]
    assert (rows[0].pm25, rows[0].pm10, rows[0].o3, rows[0].so2) == (12.5, 7.0, None, None)
    assert rows[0].forecast == '{"o3":[1]}' and rows[1].pm25 is None
    assert [r.k for r in payloads.station_status(df, "payload")[1].collect()] == ["2"]


def test_pollution_lists(spark):
    item = {"dt": 1704067200, "main": {"aqi": 3}, "components": {"pm2_5": 1.0, "pm10": 2.0}}
    df = landed(spark, {"list": [item, {**item, "dt": 1704070800}]}, {"list": []})
    now = payloads.pollution_current(df, "payload", ["k"]).collect()
    assert len(now) == 1 and now[0].datetime == dt.datetime(2024, 1, 1) and now[0].pm25 == 1.0
    assert payloads.pollution_forecast(df, "payload").count() == 2


def test_detail_visibility(spark):
    df = landed(
        spark,
        *[{"current": {"last_updated": "2024-01-01 05:00", "vis_km": v}} for v in (None, 0, 4)],
    )
    rows = payloads.current_detail(df, "payload").collect()
    assert [r.visibility for r in rows] == [10000.0, 10000.0, 4000.0]


def test_flatten_scalar_and_nested(spark):
    flat = spark.createDataFrame([("2024-01-01T00:00", 20.0, 55.0, 9.0)],
                                 "datetime string, temperature_2m double, aqi double, pm25 double")
    row = payloads.flatten_observations(flat).first()
    assert (row.temperature_2m, row.aqi, row.pm25, row.source) == (20.0, 55.0, 9.0, "unknown")
    assert row.datetime == dt.datetime(2024, 1, 1) and len(row) == 14


def test_merge_precedence(spark):
    a = spark.createDataFrame([(1, 10.0, 1.0), (2, 20.0, 2.0)], "k int, aqi double, x double")
    b = spark.createDataFrame([(1, None, 5.0), (3, 30.0, 6.0)], "k int, aqi double, y double")
    kept = {r.k: r.aqi for r in joins.merge_sources(a, b, ["k"]).collect()}
    assert kept == {1: 10.0, 2: 20.0, 3: 30.0}
    over = {r.k: r.aqi for r in joins.merge_sources(a, b, ["k"], null_overwrites=True).collect()}
    assert over == {1: None, 2: 20.0, 3: 30.0}


@pytest.mark.parametrize("rows_per_cut", [10_000, 15])
def test_asof_join(spark, rows_per_cut):
    left = spark.createDataFrame([("a", t, t) for t in range(0, 100, 2)], "k string, t int, id int")
    right = spark.createDataFrame(
        [("a", t, 1000 + t, None if t == 35 else float(t)) for t in (10, 35, 50)],
        "k string, t int, rid int, v double",
    )
    out = joins.asof_join(left, right, ["k"], "t", ["rid", "v"], "id", "rid", rows_per_cut)
    found = {r.id: (r.rid, r.v) for r in out.collect()}
    assert len(found) == 50 and found[8] == (None, None)
    assert found[10] == (1010, 10.0) and found[36] == (1035, None) and found[98] == (1050, 50.0)


def test_asof_join_without_keys_and_one_reading(spark):
    left = spark.createDataFrame([(None, 5, 1), ("a", 5, 2)], "k string, t int, id int")
    right = spark.createDataFrame([(None, 1, 7, 2.0), ("a", 1, 8, 3.0)], "k string, t int, rid int, v double")
    out = joins.asof_join(left, right, ["k"], "t", ["v"], "id", "rid")
    assert {r.id: r.v for r in out.collect()} == {1: None, 2: 3.0}
    readings = right.select("v")
    with pytest.raises(ValueError, match="one current reading"):
        joins.apply_reading(left, readings)
    kept = joins.apply_reading(left, readings.filter("v > 9"))
    assert kept.count() == 2 and kept.filter("v IS NULL").count() == 2


def test_hourly_grid_off_the_full_hour(spark):
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    rows = spark.createDataFrame(
        [("a", at(10, 20), 4.0), ("a", at(10, 37), 5.0), ("a", at(12, 0), 6.0)],
        "k string, t timestamp, v double")
    out = ranges.hourly_grid(rows, ["k"], "t").orderBy("t").collect()
    assert [(r.t, r.v) for r in out] == [(at(10, 0), 5.0), (at(11, 0), None), (at(12, 0), 6.0)]


def test_chunks(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 15))], "lo timestamp, hi timestamp")
    rows = ranges.chunks(df, "lo", "hi").orderBy("chunk_start").collect()
    found = [(r.chunk_start.date().isoformat(), r.chunk_end.date().isoformat()) for r in rows]
    assert found == [("2024-01-01", "2024-01-31"), ("2024-01-31", "2024-03-01"), ("2024-03-01", "2024-03-15")]


def test_hour_spine(spark):
    spine = ranges.hour_spine(spark, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 3))
    assert spine.count() == 49 and spine.agg(F.max("datetime")).first()[0] == dt.datetime(2024, 1, 3)


def test_day_table_upsert_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3), float(i)) for i in range(30)]
    df = spark.createDataFrame(rows, "id int, datetime timestamp, v double")
    tables.upsert_days(df, path, ["id", "datetime"])
    fixed = df.filter("id < 5").withColumn("v", F.col("v") + 100)
    for _ in range(2):
        tables.upsert_days(fixed, path, ["id", "datetime"])
    out = {r.id: r.v for r in spark.read.parquet(path).collect()}
    assert out == {i: i + 100.0 if i < 5 else float(i) for i in range(30)}
    pruned = tables.read_recent(spark, path, dt.datetime(2024, 1, 3), days=1)
    assert pruned.count() == 20


def test_versions_and_registry(spark, tmp_path):
    root, registry = str(tmp_path / "v"), str(tmp_path / "r")
    assert tables.versions(spark, root) == []
    tables.insert_version(spark.range(3).toDF("a"), root, 1)
    tables.insert_version(spark.range(2).select(F.col("id").alias("a"), F.lit(1).alias("b")), root, 3)
    assert tables.versions(spark, root) == [1, 3]
    assert tables.read_version(spark, root, 2, fallback=1).count() == 3
    both = tables.read_all_versions(spark, root)
    assert both.count() == 5 and both.filter("b IS NULL").count() == 3
    with pytest.raises(FileNotFoundError):
        tables.read_version(spark, root, 9)
    assert tables.register_model(spark, registry, "m", {"rmse": 1.0}) == 1
    assert tables.register_model(spark, registry, "m", {"rmse": 0.9}) == 2
    assert tables.register_model(spark, registry, "other", {}) == 1


def test_reshape(spark):
    long = spark.createDataFrame([("m", "f1", 0.2), ("m", "f2", 0.8)], "model string, feature string, importance double")
    wide = reshape.importance_wide(long, ["f1", "f2"])
    assert wide.first().asDict() == {"model": "m", "f1": 0.2, "f2": 0.8}
    assert reshape.importance_long(wide, ["f1", "f2"]).count() == 2
    results = spark.createDataFrame(
        [("a", None, "failed"), ("b", 2.0, None), ("c", 1.0, None)], "model string, rmse_mean double, error string")
    assert [r.model for r in reshape.ranked_results(results).collect()] == ["c", "b", "a"]
    assert reshape.best_model(results).first().best_model == "c"
    sample = [r.id for r in reshape.seeded_sample(spark.range(500), "id").collect()]
    again = [r.id for r in reshape.seeded_sample(spark.range(500).repartition(7), "id").collect()]
    assert sorted(sample) == sorted(again) and len(sample) == 100


def test_newest_file_is_the_only_one_opened(spark, tmp_path):
    import os

    folder = tmp_path / "files"
    for k in range(3):
        spark.range(k + 1).coalesce(1).write.mode("append").parquet(str(folder))
    parts = sorted(folder.glob("*.parquet"), key=lambda p: p.stat().st_size)
    for age, part in zip((50, 30), parts):
        part.write_bytes(b"no parquet at all")
        os.utime(part, (10**9 - age, 10**9 - age))
    os.utime(parts[2], (10**9, 10**9))
    assert tables.newest_path(spark, str(folder), ".parquet").endswith(parts[2].name)
    assert tables.newest_file(spark, str(folder)).count() > 0
    with pytest.raises(FileNotFoundError):
        tables.newest_path(spark, str(folder), ".csv")


def test_stored_files_are_sorted_by_time(spark, tmp_path):
    import pyarrow.parquet as pq

    hours = spark.range(400).select(
        F.col("id"), (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(F.lit(0), (F.col("id") * 37 % 96).cast("int"))).alias("datetime"))
    tables.write_features(hours.repartition(5), str(tmp_path / "f"))
    files = list((tmp_path / "f").rglob("*.parquet"))
    assert len({f.parent.name for f in files}) == 4
    for f in files:
        times = pq.ParquetFile(f).read(columns=["datetime"]).column(0).to_pylist()
        assert times == sorted(times)


def test_upserts_choose_the_same_row_whatever_the_order(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1), 5.0, 2), (1, dt.datetime(2024, 1, 1), 9.0, 1), (1, dt.datetime(2024, 1, 1), 7.0, 2)]
    for name, part in (("a", rows), ("b", rows[::-1])):
        df = spark.createDataFrame(part, "k long, datetime timestamp, v double, ingest int").repartition(2)
        tables.upsert_days(df, str(tmp_path / name), ["k", "datetime"], order=["ingest"])
        assert [r.v for r in spark.read.parquet(str(tmp_path / name)).collect()] == [7.0]


def test_times_are_local_to_the_payloads_zone(spark):
    text = json.dumps({"current": {"time": "2024-03-05T02:30", "temperature_2m": 1.0}})
    offset = json.dumps({"current": {"time": "2024-03-05T02:30:00+03:00", "temperature_2m": 1.0}})
    df = spark.createDataFrame([(text,), (offset,)], "payload string")
    utc = lambda zone: [r[0] for r in payloads.current_weather(df, "payload", zone=zone).select(F.date_format("datetime", "MM-dd HH:mm")).collect()]
    assert utc(None) == ["03-05 02:30", "03-04 23:30"] and utc("Asia/Karachi") == ["03-04 21:30", "03-04 23:30"]
