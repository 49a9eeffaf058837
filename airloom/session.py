"""Session set-up and the shared folder used for materialised intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", **extra: str) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "20g",
        "spark.sql.adaptive.enabled": "true",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("airloom")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only on a local
    master: on a cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="airloom-"))
    return context.getCheckpointDir().rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table cuts the lineage, survives lost executors and, unlike a
    row checkpoint, can still be column-pruned by whoever reads it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/airloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
