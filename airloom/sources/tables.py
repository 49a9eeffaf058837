"""Feature tables, versions, results and the model registry as plain tables."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators.windows import latest
from airloom.schemas import REGISTRY
from airloom.session import materialise


MOST_DAYS = 4_000  # some ten years


def write_features(df: DataFrame, path: str, time: str = "datetime", mode: str = "append") -> None:
    """Parquet partitioned by day, each file sorted by time.

    Range partitioning on (day, time, row hash) gives a day as many tasks, and files,
    as its share of the rows asks for.
    """
    (
        df.withColumn("event_date", F.to_date(time))
        .repartitionByRange(F.col("event_date"), F.col(time), F.xxhash64(*_spread(df, time)))
        .sortWithinPartitions("event_date", time)
        .write.mode(mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def _spread(df: DataFrame, time: str) -> list[str]:
    simple = [name for name, kind in df.dtypes if "map" not in kind]
    return simple or [time]


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def ranged_name(prefix: str, start: dt.datetime, end: dt.datetime) -> str:
    return f"{prefix}_{start:%Y%m%d}_{end:%Y%m%d}"


def read_table(spark: SparkSession, path: str, schema=None, form: str = "parquet") -> DataFrame:
    """Scan an explicit path with a declared schema; a missing path raises."""
    reader = spark.read.format(form)
    if form == "csv":
        reader = reader.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_days(spark: SparkSession, path: str, start: dt.date, end: dt.date) -> DataFrame:
    """Partition-pruned read of the days in [start, end]."""
    day = F.col("event_date")
    return spark.read.parquet(path).filter(day.between(F.lit(start), F.lit(end)))


def read_recent(spark: SparkSession, path: str, end: dt.datetime, days: int = 30) -> DataFrame:
    start = end - dt.timedelta(days=days)
    pruned = read_days(spark, path, start.date(), end.date())
    return pruned.filter(F.col("datetime").between(F.lit(start), F.lit(end)))


def latest_snapshot(df: DataFrame, snapshot: str = "snapshot_id") -> DataFrame:
    """Rows of the snapshot that sorts last; its id is one aggregated value."""
    newest = df.agg(F.max(snapshot).alias(snapshot))
    return df.join(F.broadcast(newest), snapshot, "left_semi")


def newest_path(spark: SparkSession, folder: str, suffix: str = "") -> str:
    """The most recently modified file of a folder, the last by name among equals; lists, reads nothing."""
    base = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [
        (s.getModificationTime(), s.getPath().getName(), s.getPath().toString())
        for s in files.listStatus(base)
        if s.isFile() and s.getPath().getName().endswith(suffix) and s.getPath().getName()[0] not in "._"
    ]
    if not found:
        raise FileNotFoundError(f"no file {suffix} in {folder}")
    return max(found)[2]


def newest_file(spark: SparkSession, folder: str, form: str = "parquet", schema=None) -> DataFrame:
    """Rows of the most recently modified file of a folder; no other file is opened."""
    return read_table(spark, newest_path(spark, folder, f".{form}"), schema, form)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Version folders (``version=N``) under a table root."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    files = base.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(base):
        return []
    found = [re.fullmatch(r"version=(\d+)", s.getPath().getName()) for s in files.listStatus(base)]
    return sorted(int(m.group(1)) for m in found if m)


def insert_version(df: DataFrame, root: str, version: int) -> None:
    df.write.mode("append").parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, version: int, fallback: int | None = None) -> DataFrame:
    """The wanted version, else the fallback version."""
    present = versions(spark, root)
    for wanted in (version, fallback):
        if wanted in present:
            return spark.read.parquet(f"{root}/version={wanted}")
    raise FileNotFoundError(f"no version {version} or {fallback} under {root}")


def read_all_versions(spark: SparkSession, root: str) -> DataFrame:
    """All versions as one table; columns a version lacks are NULL."""
    out = None
    for version in versions(spark, root):
        part = spark.read.parquet(f"{root}/version={version}").withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no versions under {root}")
    return out


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Table with the incoming rows in place of those with the same key.

    Of incoming rows with one key the newest by ``order`` counts, and among equals the one
    whose columns sort last. Repeating the same batch leaves the table unchanged.
    """
    fresh = _one_each(incoming, keys, order)
    return existing.join(fresh.select(*keys), list(keys), "left_anti").unionByName(
        fresh, allowMissingColumns=True
    )


def _one_each(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key: the newest by ``order``, among equals the one whose columns sort last.

    The choice does not depend on how the rows are dealt to tasks.
    """
    rest = [name for name, kind in df.dtypes if name not in keys and name not in order and "map" not in kind]
    if not order and not rest:
        return df.dropDuplicates(list(keys))
    return latest(df, keys, [*order, *rest])


def _touched(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored rows of the days that ``fresh`` has: other partitions are not read.

    The days are literals, unless they are more than a plan should hold.
    """
    days = fresh.select("event_date").distinct()
    listed = [r[0] for r in days.limit(MOST_DAYS + 1).collect() if r[0] is not None]
    if len(listed) <= MOST_DAYS:
        return stored.filter(F.col("event_date").isin(listed))
    return stored.join(days, "event_date", "left_semi")


def upsert_days(
    df: DataFrame, path: str, keys: Sequence[str], time: str = "datetime", order: Sequence[str] = ()
) -> None:
    """Idempotent upsert into a table partitioned by day.

    Of rows with one key the newest by ``order`` counts, an ingest number for example, and
    among equals the one whose columns sort last. Only the days the batch touches are read and
    rewritten (dynamic partition overwrite); the new content is materialised before the old is
    replaced.
    """
    spark = df.sparkSession
    fresh = _one_each(df.withColumn("event_date", F.to_date(time)), keys, order)
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        fresh = upsert(_touched(spark.read.parquet(path), fresh), fresh, keys)
    merged = materialise(fresh, "upsert")
    (
        merged.repartitionByRange(F.col("event_date"), F.xxhash64(*keys))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def write_results(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").json(path)


def next_version(registry: DataFrame) -> DataFrame:
    """Next free version of every registered model."""
    return registry.groupBy("model_name").agg(
        (F.coalesce(F.max("version"), F.lit(0)) + 1).alias("next_version")
    )


def registered(spark: SparkSession, path: str) -> DataFrame:
    """All registry entries; none where nothing was registered yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.read.schema(REGISTRY).parquet(path)
    return spark.createDataFrame([], REGISTRY)


def free_version(spark: SparkSession, path: str, name: str) -> int:
    known = registered(spark, path).filter(F.col("model_name") == name)
    return known.agg(F.coalesce(F.max("version"), F.lit(0))).first()[0] + 1


def register_model(
    spark: SparkSession, path: str, name: str, metrics: Mapping[str, float], description: str = "",
    model_path: str | None = None, version: int | None = None,
) -> int:
    """Append a registry entry under the next version of ``name``; returns it."""
    version = version or free_version(spark, path, name)
    row = (name, version, dict(metrics), dt.datetime.now(dt.timezone.utc), description, model_path)
    spark.createDataFrame([row], REGISTRY).write.mode("append").parquet(path)
    return version


def registered_path(spark: SparkSession, path: str, name: str, version: int | None = None) -> str:
    """Where a registered model lies: the version asked for, or the newest."""
    entries = registered(spark, path).filter((F.col("model_name") == name) & F.col("model_path").isNotNull())
    if version is not None:
        entries = entries.filter(F.col("version") == version)
    found = entries.agg(F.max_by("model_path", "version")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no saved {name}, version {version or 'any'}, in {path}")
    return found
