"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Pieces of equal length are interchangeable, so the packing is worked out on the histogram
of lengths (as many numbers as a sequence has tokens, whatever the data): fill a sequence
greedily with the longest piece that fits, then replace its smallest piece by the two
unpacked pieces that fill the larger gap best, and repeat that pattern as often as the
counts allow. The plan names, for each length, which ranks go to which sequences and
places. Ranks within a length are counted per partition and offset, so no length, however
common, is gathered in one task; each piece then finds its place by binary search.

Defined results: a null text is empty and gives one piece with the end id alone; rows that
repeat a doc_id are packed as documents of their own; a null doc_id is packed. An empty
table gives an empty result. Extra columns are ignored. Which of several pieces of equal
length gets which place depends on their order (doc_id, piece, checksum) alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.llm.common import Written, slices
from airloom.llm.vocabulary import long_runs, vocabulary

LENGTH = 2048
END_ID = 0
RANK_BITS = 48  # ranks within one length stay below this power of two


def pieces(
    docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Documents as ids plus the end id; longer ones cut, the first piece being the shorter.

    Columns: doc_id, piece, start, length, ids_crc32 and, if asked for, ids (binary, 32-bit).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # a file of fixed size
    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in slices(batches):
            row, piece, start, size, check, kept = [], [], [], [], [], []
            texts = zip(batch.column("text").to_pylist(), long_runs(batch), strict=True)
            for r, (text, long) in enumerate(texts):
                ids = np.append(vocab.ids(text or "", bool(long)), np.uint32(end_id)).astype("<u4")
                first = (len(ids) - 1) % length + 1
                ends = range(first, len(ids) + 1, length)
                for p, end in enumerate(ends):
                    begin = 0 if p == 0 else end - length
                    data = ids[begin:end].tobytes()
                    row.append(r)
                    piece.append(p)
                    start.append(begin)
                    size.append(end - begin)
                    check.append(zlib.crc32(data))
                    if keep_ids:
                        kept.append(data)
            out = [
                batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(check, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if keep_ids:
                out, names = [*out, pa.array(kept, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(out, names)

    return docs.select("doc_id", "text").mapInArrow(cut, fields + ", ids binary" * keep_ids)


def pattern(counts: np.ndarray, length: int) -> dict[int, int]:
    """One sequence by best-two-fit: how many pieces of each length it takes."""
    there = np.flatnonzero(counts)
    taken: dict[int, int] = {}
    left = lambda size: int(counts[size]) - taken.get(size, 0)
    gap, at = length, len(there) - 1
    while gap and at >= 0:
        size = int(there[at])
        if size <= gap and (n := min(left(size), gap // size)):
            taken[size] = n
            gap -= n * size
        at = min(at - 1, int(np.searchsorted(there, gap, side="right")) - 1)
    if gap and taken:
        smallest = min(taken)
        taken[smallest] -= 1
        wide = gap + smallest
        open_sizes = np.array([s for s in there[there <= wide] if left(int(s)) > 0], np.int64)
        best = (smallest, ())
        for a in open_sizes[::-1]:
            if 2 * a < best[0]:
                break
            fits = int(np.searchsorted(open_sizes, min(wide - a, a), side="right")) - 1
            if fits >= 0 and open_sizes[fits] == a and left(int(a)) < 2:
                fits -= 1
            if fits >= 0 and a + open_sizes[fits] > best[0]:
                best = (int(a + open_sizes[fits]), (int(a), int(open_sizes[fits])))
        for size in best[1] or (smallest,):
            taken[size] = taken.get(size, 0) + 1
    return {size: n for size, n in taken.items() if n}


def plan(histogram: dict[int, int], length: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, pieces a sequence, first sequence, offset), by rank."""
    counts = np.zeros(length + 1, np.int64)
    for size, n in histogram.items():
        counts[size] = n
    used, rows, sequence = np.zeros(length + 1, np.int64), [], 0
    while counts.any():
        taken = pattern(counts, length)
        times = min(int(counts[size]) // n for size, n in taken.items())
        offset = 0
        for size in sorted(taken, reverse=True):
            n = taken[size]
            rows.append((size, int(used[size]), n, sequence, offset))
            offset += n * size
            used[size] += n * times
            counts[size] -= n * times
        sequence += times
    return sorted(rows)


def ranked(cut: DataFrame) -> DataFrame:
    """Adds each piece's rank among those of its length; ``cut`` is a written table."""
    c = F.col
    parted = cut.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(1024)))
    sums = parted.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        c("length").alias("of_length"), c("part").alias("of_part"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
    )
    within = W.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (
        parted.withColumn("nth", F.row_number().over(within))
        .join(offsets, (c("length") == c("of_length")) & (c("part") == c("of_part")))
        .withColumn("rank", c("before") + c("nth") - 1)
        .drop("part", "nth", "of_length", "of_part", "before")
    )


def packed(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``cut`` (a written table of pieces) with sequence_id and offset."""
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = np.array(plan(histogram, length), np.int64).reshape(-1, 5)
    sizes, firsts, together, sequences, offsets = rows.T
    keys = (sizes << RANK_BITS) + firsts
    names = cut.columns

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (size << RANK_BITS) + rank, side="right") - 1
            nth, n = rank - firsts[at], together[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(name) for name in names],
                    pa.array(sequences[at] + nth // n), pa.array(offsets[at] + nth % n * size),
                ],
                [*names, "sequence_id", "offset"],
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked(cut).select(*names, "rank").mapInArrow(
        place, f"{fields}, sequence_id long, offset long"
    )


def pack(docs: DataFrame, path: str, length: int = LENGTH, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most ``length`` ids."""
    folder = Written(docs.sparkSession, "packing")
    return packed(folder.keep(pieces(docs, path, length, keep_ids=keep_ids)), length)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences (sequence_id, length, ids) of pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), parts.alias("parts")
    ).select(
        "sequence_id", "length",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
