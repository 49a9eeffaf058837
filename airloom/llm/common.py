"""Helpers the operators of this folder share: tables, written intermediates, hashes of text."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import shared_folder

# The white space that separates words, as a character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
# Session setting: shuffle files of a query are removed at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Written:
    """Tables written to the shared folder; ``drop`` removes those no result reads."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.base = f"{shared_folder(spark)}/airloom/{label}-{uuid.uuid4().hex}"
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once and read it back: cuts the lineage, outlives executors.

        The shuffle files behind it go with the end of the write, since the table is what is read.
        """
        self.count += 1
        path = f"{self.base}/{self.count}"
        before = self.spark.conf.get(CLEAN_UP, "false")
        self.spark.conf.set(CLEAN_UP, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(CLEAN_UP, before)
        back = self.spark.read.schema(df.schema).parquet(path)
        back.written_to = path
        return back

    def drop(self, *frames: DataFrame) -> None:
        for frame in frames:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(frame.written_to)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """One buffer with the UTF-8 bytes of a column, and where each text starts and ends.

    Nulls are empty texts.
    """
    column = batch.column(name)
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    size = int(offsets[-1]) if len(offsets) else 0
    if not len(column) or data is None or not size:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[int(offsets[0]) : size], offsets - offsets[0]


def slices(batches: Iterable[pa.RecordBatch], name: str = "text", most: int = 4 << 20) -> Iterator:
    """Cut batches so that a piece holds about ``most`` bytes of text, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = texts_of(batch, name)
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + most, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (finaliser of SplitMix64), in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def bucket_of(name: str, modulus: int):
    """The CRC-32 of an id written as text, modulo ``modulus``: the contract's folds."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % modulus
