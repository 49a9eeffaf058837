"""Payload and observation streams: reading, late rows, de-duplication, windows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airloom.operators.windows import latest

WATERMARK = "2 hours"


def payload_stream(
    spark: SparkSession, path: str, reader: Callable[..., DataFrame],
    keep: Sequence[str] = ("series_key",), files_per_batch: int = 100,
) -> DataFrame:
    """Files of (series, payload text) lines, parsed by a payload reader."""
    schema = ", ".join(f"{c} string" for c in (*keep, "payload"))
    raw = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )
    return reader(raw, "payload", keep)


def table_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def dedup(df: DataFrame, keys: Sequence[str], time: str, delay: str = WATERMARK) -> DataFrame:
    """First copy of each key; state is dropped once the watermark has passed."""
    return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def window_means(
    df: DataFrame, keys: Sequence[str], time: str, value: str,
    width: str = "1 hour", slide: str | None = None, delay: str = WATERMARK,
) -> DataFrame:
    """Tumbling or sliding means by event time; batch frames work the same way."""
    source = df.withWatermark(time, delay) if df.isStreaming else df
    span = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        source.groupBy(span.alias("w"), *keys)
        .agg(F.avg(value).alias(f"mean_{value}"), F.count(value).alias("n"))
        .select(*keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                f"mean_{value}", "n")
    )


def write_stream(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", **trigger
) -> StreamingQuery:
    """Append to a parquet table; the checkpoint makes restarts exactly-once."""
    return (
        df.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def keyed_stream(df: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Changed rows of each batch under the batch's number, which a repeated batch replaces.

    In update mode only the windows that a batch changes are written, and those behind the
    watermark leave the state; ``newest_versions`` reads the table's present content.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        df.writeStream.outputMode(mode).foreachBatch(save)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def newest_versions(spark: SparkSession, path: str, schema, keys: Sequence[str]) -> DataFrame:
    """Of each key the row of its last batch."""
    rows = spark.read.schema(schema.add("batch", "long") if "batch" not in schema.names else schema).parquet(path)
    return latest(rows, keys, ["batch"]).drop("batch")


def late_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """(batch, operator, dropped, state_rows) of a query: what came too late, and the state's size.

    Windows drop what a task has already added up of one window as one row. A query remembers
    its last ``spark.sql.streaming.numRecentProgressUpdates`` batches.
    """
    rows = [
        (p["batchId"], o["operatorName"], o["numRowsDroppedByWatermark"], o["numRowsTotal"])
        for p in query.recentProgress for o in p["stateOperators"]
    ]
    return spark.createDataFrame(rows, "batch long, operator string, dropped long, state_rows long")


def alert_stream(df: DataFrame, value: str, alert: Column) -> DataFrame:
    """Banner-level alerts of an observation stream, without state."""
    from airloom.functions.bands import is_banner

    return (
        df.withColumn("_alert", alert)
        .filter(is_banner(F.col("_alert.level")))
        .select(*df.columns, "_alert.*")
    )
