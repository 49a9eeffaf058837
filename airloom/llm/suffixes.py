"""Removal of repeated byte strings with suffix arrays.

A byte goes when a string of ``LENGTH`` bytes that covers it also starts earlier in the
corpus. Every such string (a window) is named by its anchor: the position in it whose
``GRAM`` bytes have the smallest hash, leftmost on ties. Equal windows have equal anchors, so:

1. One pass over the texts lists the anchors of each document. Their hashes are sorted once;
   only anchors whose hash occurs twice anywhere can name a repeated window.
2. For these, the stretch of text that holds all windows of the anchor (its context) goes to
   the shard of the hash. Equal contexts are one from then on; all but the first are repeats.
3. In each shard the windows of the different contexts are compared exactly, by suffix
   array: prefix doubling that refines only unsorted groups (Larsson-Sadakane), common
   prefixes after Kasai, run along all contexts at once.
4. A hot anchor, one with more contexts than fill a shard's block, has no shard: its contexts
   are taken apart into windows, which go by the hash of their own bytes (128 bits of
   BLAKE2b stand for them). Only the first of equal windows leaves a batch.
5. The repeated stretches of each document are united and cut out.

Text that does not repeat never leaves its document; memory is bounded by the block size
and the longest document. One task reads at most a block of contexts of an anchor and a row
per batch of a window or known anchor. The hot anchors, which are sent to every task, are at
most one in ``block / (2 * length - gram)`` occurrences of repeated anchors.

Defined results: a null text is empty; windows never cross documents; a document shorter
than a window keeps all its bytes. Rows that repeat a doc_id are one document: equal rows are at the
same place, so none is earlier than the other; of different texts each is cut at its own
places, where its bytes start earlier in a smaller doc_id or in one of the document's texts. A row
without doc_id is neither compared nor cut. Texts of any length are read whole. An empty table
gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import Written, mix, slices, texts_of
from airloom.llm.neardup import POWERS

LENGTH = 100
GRAM = 32
BLOCK = 2 << 20
SPREAD = 4096


def prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    return sums, down


def anchors(
    data: np.ndarray, offsets: np.ndarray, length: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts that share an anchor: first, last, anchor, its hash, the text.

    Also the prefix hashes of the buffer, for whoever hashes stretches of it.
    """
    sums, down = prefix_hashes(data)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none
    grams = len(data) - gram + 1
    hashes = mix((sums[gram:] - sums[:grams]) * down[:grams])
    packed = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    if width < span:
        rest = span - width
        packed = np.minimum(packed[:-rest], packed[rest:])
    anchor = (packed & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Starts whose window lies in one text, and runs of them with one anchor.
    inside = np.zeros(len(anchor) + 1, np.int64)
    fits = np.flatnonzero(np.diff(offsets) >= length)
    np.add.at(inside, offsets[fits], 1)
    np.add.at(inside, offsets[fits + 1] - length + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]))
    fresh = np.concatenate([[True], (anchor[at[1:]] != anchor[at[:-1]]) | (at[1:] != at[:-1] + 1)])[: len(at)]
    begins = np.flatnonzero(fresh)
    first = at[begins]
    last = at[np.append(begins[1:], len(at))[: len(begins)] - 1]
    of = np.searchsorted(offsets, first, side="right") - 1
    return first, last, anchor[first], hashes[anchor[first]], of


def summaries(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """doc_id, n_bytes, hash of the whole text, and the hashes of its anchors."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            _, _, _, hashes, of = anchors(data, offsets, length, gram)
            cuts = np.searchsorted(of, np.arange(batch.num_rows + 1))
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(np.diff(offsets)),
                    pa.array([
                        hashlib.sha256(raw[b:e]).hexdigest()
                        for b, e in zip(offsets[:-1], offsets[1:], strict=True)
                    ]),
                    pa.array([
                        hashes[b:e].tobytes() for b, e in zip(cuts[:-1], cuts[1:], strict=True)
                    ], pa.binary()),
                ],
                ["doc_id", "n_bytes", "whole", "anchors"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, whole string, anchors binary"
    )


def anchor_rows(found: DataFrame) -> DataFrame:
    """(key, doc, n): each anchor hash of a document and how often it has it.

    Rows whose key another row of the batch has are known to be repeated. All but the first of
    them get a ``spread``, so that they need not meet by key.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs, times = [], [], []
            ids = zip(batch.column("doc_id").to_pylist(), batch.column("anchors").to_pylist(), strict=True)
            for doc, packed in ids:
                key, n = np.unique(np.frombuffer(packed, np.int64), return_counts=True)
                keys.append(key)
                docs.append(np.full(len(key), doc, np.int64))
                times.append(n)
            if keys:
                key, doc, n = map(np.concatenate, (keys, docs, times))
                _, leader, which, rows = np.unique(
                    key, return_index=True, return_inverse=True, return_counts=True
                )
                later = leader[which] != np.arange(len(key))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key), pa.array(doc), pa.array(n, pa.int64()), pa.array(rows[which] > 1),
                        pa.array(doc % SPREAD, pa.int64(), mask=~later),
                    ],
                    ["key", "doc", "n", "known", "spread"],
                )

    return found.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "anchors"
    ).mapInArrow(run, "key long, doc long, n long, known boolean, spread long")


def repeated(rows: DataFrame) -> DataFrame:
    """The rows whose key occurs elsewhere, too: streamed in key order, in constant memory."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "doc", "n"]
        held, joined = [np.zeros(0, np.int64)] * 3, False
        for batch in batches:
            if not batch.num_rows:
                continue
            key, doc, n = (
                np.concatenate([h, batch.column(c).to_numpy()]) for h, c in zip(held, names, strict=True)
            )
            known = batch.column("known").to_numpy(zero_copy_only=False)
            company = np.concatenate([np.full(len(held[0]), joined), known]) | (n > 1)
            same = key[1:] == key[:-1]
            company[1:] |= same
            company[:-1] |= same
            held, joined = [x[-1:] for x in (key, doc, n)], bool(company[-1])
            mask = company[:-1]
            yield pa.RecordBatch.from_arrays([pa.array(x[:-1][mask]) for x in (key, doc, n)], names)
        if joined:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names)

    by_key = rows.repartition("key", "spread").sortWithinPartitions("key")
    return by_key.mapInArrow(run, "key long, doc long, n long")


def repeated_anchors(rows: DataFrame, most: int) -> DataFrame:
    """doc, its repeated ``keys``, and those of them that occur more than ``most`` times, ``hot``."""
    hot = rows.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    marks = F.broadcast(hot.select("key", F.lit(True).alias("is_hot")))
    return rows.join(marks, "key", "left").groupBy("doc").agg(
        F.collect_set("key").alias("keys"), F.collect_set(F.when(F.col("is_hot"), F.col("key"))).alias("hot")
    )


CONTEXT = "key long, doc long, version int, begin long, size long, at long, context binary"


def windows(
    raw: bytes, length: int, first: np.ndarray, last: np.ndarray, doc: np.ndarray, version: np.ndarray, begin: np.ndarray
) -> list[pa.Array]:
    """The columns of CONTEXT for the windows that start from ``first`` to ``last``.

    Of equal windows the first in the corpus goes on; runs of the others are known repeats.
    """
    n = last - first + 1
    of = np.repeat(np.arange(len(n)), n)
    step = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    doc, version, place, start = doc[of], version[of], begin[of] + step, (first[of] + step).tolist()
    digests = b"".join(hashlib.blake2b(raw[p : p + length], digest_size=16).digest() for p in start)
    high, low = np.frombuffer(digests, np.int64).reshape(-1, 2).T
    order = np.lexsort((place, doc, low, high))
    fresh = np.concatenate([[True], (np.diff(high[order]) != 0) | (np.diff(low[order]) != 0)])
    leader = np.empty(len(order), np.int64)
    leader[order] = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    again = (doc != doc[leader]) | (place != place[leader])
    lead, known = np.flatnonzero(~again), np.flatnonzero(again)
    begins, ends = runs(known, of)
    at = np.concatenate([lead, begins])
    size = np.concatenate([np.full(len(lead), length), ends - begins + length])
    return [
        pa.array(high[at]), pa.array(doc[at]), pa.array(version[at]), pa.array(place[at]), pa.array(size, pa.int64()),
        pa.array(np.full(len(at), -1)),
        pa.array([*(digests[16 * i : 16 * i + 16] for i in lead), *[None] * len(begins)], pa.binary()),
    ]


def contexts(marked: DataFrame, length: int, gram: int) -> DataFrame:
    """The contexts of each document's repeated anchors, and the windows of its hot ones.

    Of equal contexts in a batch the first goes on; the others are repeats already and go on
    without their bytes. So it is with windows, whose key and bytes are their digest; their
    ``at`` is -1.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            first, last, anchor, hashes, of = anchors(data, offsets, length, gram)
            wanted = batch.column("keys")
            keys = np.asarray(wanted.flatten(), np.int64)
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(wanted.offsets)))
            salt = np.uint64(0x9E3779B97F4A7C15)
            name = lambda h, d: mix(h.view(np.uint64) ^ (d.astype(np.uint64) + np.uint64(1)) * salt)
            chosen = np.isin(name(hashes.copy(), of), name(keys.copy(), owner))
            first, last, anchor, hashes, of = (x[chosen] for x in (first, last, anchor, hashes, of))
            doc = np.asarray(batch.column("doc"), np.int64)[of]
            version = np.asarray(batch.column("version"), np.int32)[of]
            order = np.lexsort((first - offsets[of], doc))
            first, last, anchor, hashes, of, doc, version = (
                x[order] for x in (first, last, anchor, hashes, of, doc, version)
            )
            end = last + length
            sums, down = prefix_hashes(data)
            same = mix((sums[end] - sums[first]) * down[first])
            same = mix(same ^ hashes * salt ^ ((anchor - first) << 32 | (end - first)).astype(np.uint64))
            begin = first - offsets[of]
            _, leader, which = np.unique(same, return_index=True, return_inverse=True)
            lead = leader[which]
            again = (doc != doc[lead]) | (begin != begin[lead])
            raw = data.tobytes()
            apart = ~again & np.isin(hashes.view(np.int64), np.asarray(batch.column("hot").flatten(), np.int64))
            names = ["key", "doc", "version", "begin", "size", "at", "context"]
            if apart.any():
                yield pa.RecordBatch.from_arrays(
                    windows(raw, length, first[apart], last[apart], doc[apart], version[apart], begin[apart]), names
                )
            first, end, anchor, hashes, doc, version, begin, again = (
                x[~apart] for x in (first, end, anchor, hashes, doc, version, begin, again)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes.view(np.int64)), pa.array(doc), pa.array(version), pa.array(begin),
                    pa.array(end - first), pa.array(anchor - first),
                    pa.array(
                        [None if a else raw[b:e] for a, b, e in zip(again, first, end, strict=True)],
                        pa.binary(),
                    ),
                ],
                names,
            )

    return marked.mapInArrow(run, CONTEXT)


def suffix_order(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Positions of ``text`` in the order of what follows them in their context.

    ``ends``: where the context of each position ends; an end is smaller than any byte.
    Larsson-Sadakane: ranks double their reach, groups that are sorted are left alone.
    """
    size = len(text)
    left = ends - np.arange(size)
    reach = 7
    symbols = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(reach, np.uint64)])
    key = np.zeros(size, np.uint64)
    for k in range(reach):
        key <<= np.uint64(9)
        key |= np.where(left > k, symbols[k : k + size], np.uint64(0))
    order = np.argsort(key, kind="stable")
    fresh = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    rank = np.empty(size, np.int64)
    rank[order] = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    longest = int(left.max())
    while reach < longest:
        open_at = np.flatnonzero(~(fresh & np.concatenate([fresh[1:], [True]])))
        if not len(open_at):
            break
        suffix = order[open_at]
        second = np.where(left[suffix] > reach, rank[np.minimum(suffix + reach, size - 1)] + 1, 0)
        pair = (rank[suffix].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(pair, kind="stable")
        order[open_at], pair = suffix[by], pair[by]
        starts = np.concatenate([[True], pair[1:] != pair[:-1]])
        fresh[open_at] = starts
        rank[order[open_at]] = open_at[np.flatnonzero(starts)[np.cumsum(starts) - 1]]
        reach *= 2
    return order


def common_prefixes(
    text: np.ndarray, begins: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int
) -> np.ndarray:
    """For each entry of ``order`` the bytes it shares with the entry before, up to ``depth``.

    Kasai: along a text the shared length drops by at most one per step. All contexts
    (``begins`` to ``ends``) are walked side by side.
    """
    size = len(text)
    before = np.full(size, -1, np.int64)
    before[order[1:]] = order[:-1]
    limit = np.zeros(size, np.int64)
    limit[:] = np.repeat(ends, ends - begins)
    shared = np.zeros(size, np.int64)
    lane, have = begins.copy(), np.zeros(len(begins), np.int64)
    stop = ends
    while len(lane):
        other = before[lane]
        on = (other >= 0) & (have < depth) & (lane + have < stop)
        on &= other + have < limit[np.maximum(other, 0)]
        reach = np.where(on, lane + have, 0)
        on &= text[reach] == text[np.where(on, other + have, 0)]
        shared[lane[~on]] = np.where(other >= 0, have, 0)[~on]
        lane = lane + ~on
        have = np.where(on, have + 1, np.where(other >= 0, np.maximum(have - 1, 0), 0))
        live = lane < stop
        if not live.all():
            lane, have, stop = lane[live], have[live], stop[live]
    return shared[order]


class Shard:
    """Windows of one block of contexts in sorted order, each distinct one with its first place."""

    def __init__(self, rows: list[tuple[int, int, bytes, int]], length: int) -> None:
        sizes = np.array([len(r[2]) for r in rows], np.int64)
        self.version = np.array([r[3] for r in rows], np.int32)
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.text = np.frombuffer(b"".join(r[2] for r in rows), np.uint8)
        self.doc = np.array([r[0] for r in rows], np.int64)
        self.place = np.array([r[1] for r in rows], np.int64) - self.begins
        self.of = np.repeat(np.arange(len(rows)), sizes)
        ends = self.ends[self.of]
        order = suffix_order(self.text, ends)
        shared = common_prefixes(self.text, self.begins, self.ends, order, length)
        # Windows only: what two neighbours share is the least that any step between shares.
        whole = np.flatnonzero(order + length <= ends[order])
        steps = np.append(0, whole[:-1] + 1)
        fresh = np.minimum.reduceat(shared[: whole[-1] + 1], steps) < length
        fresh[0] = True
        self.order = order = order[whole]
        # The first place of each class; places in the block ascend as in the corpus.
        self.first = np.minimum.reduceat(order, np.flatnonzero(fresh))
        self.class_of = np.cumsum(fresh) - 1

    def repeats(self) -> np.ndarray:
        """Window starts in the block that are not the first of their string."""
        lead = self.first[self.class_of]
        doc = self.doc[self.of]
        at = lambda p: self.place[self.of[p]] + p
        again = (doc[self.order] != doc[lead]) | (at(self.order) != at(lead))
        return np.sort(self.order[again])


def runs(positions: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive positions of one context."""
    if not len(positions):
        return positions, positions
    cut = np.flatnonzero((np.diff(positions) != 1) | (np.diff(of[positions]) != 0))
    return positions[np.append(0, cut + 1)], positions[np.append(cut, len(positions) - 1)]


def repeated_stretches(rows: DataFrame, length: int, block: int = BLOCK) -> DataFrame:
    """(doc, version, begin, end) of every stretch that repeats an earlier one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[int, int, int, int]] = []
        pending: list[tuple[int, int, bytes, int]] = []  # contexts of finished groups of two or more
        waiting = 0
        group: list[tuple[int, int, bytes, int]] = []
        seen: dict[tuple[int, bytes], tuple[int, int]] = {}
        key, group_size = None, 0

        def settle(some: list) -> None:
            shard = Shard(some, length)
            begins, ends = runs(shard.repeats(), shard.of)
            of = shard.of[begins] if len(begins) else begins
            found.extend(
                zip(
                    shard.doc[of].tolist(), shard.version[of].tolist(), (shard.place[of] + begins).tolist(),
                    (shard.place[of] + ends + length).tolist(), strict=True,
                )
            )

        def close_group() -> None:
            nonlocal group, seen, group_size, waiting
            if len(group) > 1:
                pending.extend(group)
                waiting += group_size
            group, seen, group_size = [], {}, 0

        def output() -> pa.RecordBatch:
            columns = list(zip(*found, strict=True)) or [(), (), (), ()]
            found.clear()
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["doc", "version", "begin", "end"]
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "doc", "version", "begin", "size", "at", "context")]
            for k, doc, version, begin, size, at, context in zip(*columns, strict=True):
                if context is None:
                    found.append((doc, version, begin, begin + size))
                    continue
                if k != key:
                    close_group()
                    key = k
                    if waiting >= block:
                        settle(pending)
                        pending, waiting = [], 0
                lead = seen.setdefault((at, context), (doc, begin))
                if lead != (doc, begin):
                    found.append((doc, version, begin, begin + size))
                elif at >= 0:
                    group.append((doc, begin, context, version))
                    group_size += size
            if found:
                yield output()
        close_group()
        if pending:
            settle(pending)
        yield output()

    # Repeats known already pass through any task: only contexts with bytes meet by key.
    spread = F.when(F.col("context").isNull(), F.pmod(F.xxhash64("doc", "begin"), F.lit(SPREAD)))
    ordered = (
        rows.withColumn("spread", spread).repartition("key", "spread").drop("spread")
        .sortWithinPartitions("key", "doc", "begin")
    )
    return ordered.mapInArrow(run, "doc long, version int, begin long, end long")


def cut(marked: DataFrame) -> DataFrame:
    """Texts without their repeated stretches: doc, the bytes kept, counts and their hash."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=4 << 20):
            data, offsets = texts_of(batch)
            raw, removed, spans, kept = data.tobytes(), [], [], []
            for i, stretches in enumerate(batch.column("stretches").to_pylist()):
                parts, done, n, found = [], 0, 0, 0
                text = raw[offsets[i] : offsets[i + 1]]
                last = -1
                for s in stretches:
                    begin, end = s["begin"], min(s["end"], len(text))
                    if begin >= len(text):
                        continue
                    if begin > last:
                        parts.append(text[done:begin])
                        found += 1
                        n += end - begin
                    elif end > last:
                        n += end - last
                    last = done = max(last, end)
                parts.append(text[done:])
                removed.append(n)
                spans.append(found)
                kept.append(b"".join(parts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                    pa.array([hashlib.sha256(raw[b:e]).hexdigest() for b, e in zip(offsets[:-1], offsets[1:], strict=True)]),
                    pa.array(kept, pa.binary()),
                ],
                ["doc", "n_removed", "n_spans", "kept_sha256", "whole", "kept"],
            )

    return marked.mapInArrow(
        run, "doc long, n_removed long, n_spans long, kept_sha256 string, whole string, kept binary"
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, block: int = BLOCK) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept of every document.

    ``kept`` holds the remaining bytes of documents that lost some, null for whole ones.
    """
    c = F.col
    folder = Written(docs.sparkSession, "suffixes")
    found = folder.keep(summaries(docs, length, gram))
    again = folder.keep(repeated(anchor_rows(found)))
    keys = repeated_anchors(again, block // (2 * length - gram))
    # Different texts of one doc_id are told apart by their place among its hashes.
    several = folder.keep(
        found.where("doc_id is not null").groupBy(c("doc_id").cast("long").alias("doc"))
        .agg(F.sort_array(F.collect_set("whole")).alias("wholes")).where(F.size("wholes") > 1)
    )
    texts = docs.select(c("doc_id").cast("long").alias("doc"), "text")
    place = F.array_position("wholes", F.sha2(F.coalesce("text", F.lit("")), 256)).cast("int")
    version = F.when(c("wholes").isNotNull(), place).otherwise(0)
    marked = folder.keep(
        texts.join(keys, "doc").join(several, "doc", "left").select("doc", "text", "keys", "hot", version.alias("version"))
    )
    folder.drop(again, several)
    stretches = repeated_stretches(contexts(marked, length, gram), length, block)
    by_doc = folder.keep(
        stretches.groupBy("doc", "version").agg(
            F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("stretches")
        )
    )
    lost = cut(marked.select("doc", "version", "text").join(by_doc, ["doc", "version"]).select("doc", "text", "stretches"))
    lost = folder.keep(lost.dropDuplicates(["doc", "whole"]))
    folder.drop(marked, by_doc)
    whole = found.select(c("doc_id"), "n_bytes", c("whole").alias("of_whole"))
    return whole.join(
        lost, (c("doc_id") == c("doc")) & (c("of_whole") == c("whole")), "left"
    ).select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "of_whole").alias("kept_sha256"), "kept",
    )
