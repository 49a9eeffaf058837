"""Near-duplicate detection: MinHash bands, verified links, connected components.

1. One pass over the texts: the set of distinct word shingles of each row, its size, a
   digest of the set, the minima of many universal hash functions as band keys, and one byte
   of each minimum for later verification. Every row is a node of its own.
2. Nodes with equal sets form a class by digest; the first of them speaks for it.
3. Band rows (key, node) are sorted by key; only buckets of two or more stay.
4. Links are looked for by stars: each node is compared with one pivot of its buckets, at
   first the node that shares the most with others, which is near the middle of its group, and
   in each further round a random one. Components of the links hold most copies of a text,
   however many they are, and only buckets that still hold several components stay open.
   Rounds go on while at least one in ``ENOUGH`` of the pairs is a link.
5. Open buckets of at most ``SMALL`` nodes give their pairs across components. The nodes of
   larger ones are joined by the rarest of their shingles, which loses no pair. A shingle that
   stands in one component only cannot be shared with another; of a set of n with p shingles
   left, a link needs at least ceil(percent n / 100) of them, so the first that two linked
   sets share is among the p - ceil(percent n / 100) + 1 rarest of each, and so far from the
   end of both that the overlap is still possible. Members below the threshold thus fall
   apart on their own shingles.
6. Variants of one text share nearly all of their shingles, also where few are linked. So
   nodes near one pivot form a cell around it, and their pairs are looked for by what they
   differ in from it: with D the symmetric difference of a node's set and the centre's, sets
   of m and n shingles are linked if |D| + |D'| - 2 |D and D'| is at most
   (100 - percent) / (100 + percent) of m + n. Where |D| + |D'| is not above that, both are
   linked with the centre, with which every member is compared; others share a difference.
   Nodes that share a difference are first linked by stars, as in step 4, and what is then
   in several components is joined by the rarest differences that still allow the overlap.
   The join by shingles of step 5 is left with the pairs that no cell holds.
7. A pair is verified by its minima first (if it comes from a bucket), then on the full sets of
   hashes, and a link on the words themselves.
8. Components by alternating large-star and small-star steps; rows with one doc_id are linked.

With 48 bands of 5 a pair at a threshold of 0.85 shares no band with a probability of 6e-13,
one at 0.8 with 5e-9; agreement of minima six standard errors below the threshold rules a pair
of a small bucket out, about one linked pair in 1e9.

Defined results: a text without words (null, empty, blank) has an empty set, n_shingles 0,
and is linked with nothing. Fewer words than a shingle are one shingle. Rows that repeat a
doc_id are one document, linked with all that any of its texts is linked with. A row without
doc_id is linked like any other, has the smallest doc_id of its component, or null where there
is none, and is not kept in the report; ``keep_one_of_each`` keeps one text of a component without
doc_id. Texts of any length are read whole. An empty table gives an empty result. Extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.llm.common import Written, mix, slices, texts_of

WORDS = 5
PERCENT = 85
BANDS, ROWS = 48, 5
# Standard errors below the threshold at which the agreement of minima rules a pair out.
MARGIN = 6
# A round of stars is followed by another if it links one in so many of its pairs.
ENOUGH = 20
# Largest open bucket whose pairs are made; larger ones are joined by rare shingles.
SMALL = 8
# Similarity in per cent of a node to the centre of its cell, as their minima tell it; and by how
# many of its rarest differences from there a node is looked for in the first round of stars.
NEAR, RAREST = 70, 4
# A longer word is hashed by BLAKE2b; a set of fewer shingles is told by the words themselves.
LONG_WORD, FEW = 64, 16
SEED = 11
MULTIPLIER = 0x9E3779B97F4A7C15


class Powers:
    """Powers of an odd multiplier modulo 2^64 and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < size:
            inverse = pow(MULTIPLIER, -1, 1 << 64)
            for name, base in (("up", MULTIPLIER), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:size], self.down[:size]


POWERS = Powers()


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every lower-cased (A-Z) word, and the text each word is in."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low = np.where((data >= 0x41) & (data <= 0x5A), data | np.uint8(0x20), data)
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~blank
    starts = np.flatnonzero(word & (np.concatenate([[True], blank[:-1]]) | edge[:-1]))
    ends = np.flatnonzero(word & (np.concatenate([blank[1:], [True]]) | edge[1:])) + 1
    up, down = POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes ^= (ends - starts).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        digest = hashlib.blake2b(low[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return mix(hashes), np.searchsorted(offsets, starts, side="right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each text."""
    hashes, doc = word_hashes(data, offsets)
    cuts = np.searchsorted(doc, np.arange(len(offsets)))
    salt = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(MULTIPLIER)) | np.uint64(1)
    n = max(0, len(hashes) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(words):
        rolled += hashes[k : k + n] * salt[k]
    mix(rolled)
    sets = []
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        if end - begin >= words:
            sets.append(np.unique(rolled[begin : end - words + 1]))
        elif end > begin:
            few = (hashes[begin:end] * salt[: end - begin]).sum(keepdims=True, dtype=np.uint64)
            sets.append(mix(few + np.uint64(end - begin)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def real_shingles(text: bytes, words: int) -> set[tuple[bytes, ...]]:
    """The distinct shingles as words."""
    found = text.lower().split()  # of bytes: A-Z alone, and the white space of words
    if len(found) < words:
        return {tuple(found)} if found else set()
    return set(zip(*(found[k:] for k in range(words)), strict=False))


def minima(shingles: np.ndarray, slopes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function a x + b (modulo 2^32) over the set."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(len(slopes), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 1024):
        values = slopes[:, None] * x[None, i : i + 1024]
        values += shifts[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return least


def functions(count: int = BANDS * ROWS) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    slopes = rng.integers(0, 1 << 32, count, np.uint64).astype(np.uint32) | np.uint32(1)
    return slopes, rng.integers(0, 1 << 32, count, np.uint64).astype(np.uint32)


def features(docs: DataFrame, words: int) -> DataFrame:
    """node, doc_id, text, n_shingles, digest of the set, band keys and one byte of every minimum."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slopes, shifts = functions()
        salt = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            sets = shingle_sets(data, offsets, words)
            digest, bands, bytes_of = [], [], []
            for i, s in enumerate(sets):
                if not len(s):
                    digest.append(None), bands.append(None), bytes_of.append(None)
                    continue
                told = hashlib.blake2b(s.tobytes(), digest_size=16)
                if len(s) < FEW:
                    real = real_shingles(data[offsets[i] : offsets[i + 1]].tobytes(), words)
                    told.update(b"\0".join(b" ".join(x) for x in sorted(real)))
                least = minima(s, slopes, shifts)
                keys = (least.reshape(BANDS, ROWS).astype(np.uint64) * salt).sum(axis=1, dtype=np.uint64)
                digest.append(told.digest())
                bands.append(mix(keys + np.arange(BANDS, dtype=np.uint64)).tobytes())
                bytes_of.append((least >> np.uint32(7)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"), batch.column("doc_id"), batch.column("text"),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                    pa.array(bands, pa.binary()), pa.array(bytes_of, pa.binary()),
                ],
                ["node", "doc_id", "text", "n_shingles", "digest", "bands", "minima"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text")
    return rows.mapInArrow(
        run, f"node long, doc_id {kind}, text string, n_shingles long, digest binary, bands binary, minima binary"
    )


def band_rows(found: DataFrame) -> DataFrame:
    """(key, node) for every band; of equal sets in one batch only the first node."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy()
            digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), "S16")
            order = np.lexsort((node, digest))
            first = np.concatenate([[True], digest[order][1:] != digest[order][:-1]])
            chosen = order[first]
            keys = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
            keys = keys.reshape(-1, BANDS)[chosen]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), pa.array(np.repeat(node[chosen], BANDS))], ["key", "node"]
            )

    return (
        found.where("digest is not null").select("node", "digest", "bands")
        .mapInArrow(run, "key long, node long")
    )


def shared_buckets(rows: DataFrame) -> DataFrame:
    """(key, node) of the keys with two nodes or more.

    Rows are streamed in the order of their key, so a bucket of any size needs no memory.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64),) * 2  # the last row: key, node
        joined = False  # whether it has company before it

        def out(keys, nodes, mask):
            return pa.RecordBatch.from_arrays([pa.array(keys[mask]), pa.array(nodes[mask])], ["key", "node"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.concatenate([held[0], batch.column("key").to_numpy()])
            nodes = np.concatenate([held[1], batch.column("node").to_numpy()])
            company = np.concatenate([[joined], keys[1:] == keys[:-1]])
            company[:-1] |= keys[1:] == keys[:-1]
            last = len(keys) - 1
            joined = bool(company[last])
            held = (keys[last:], nodes[last:])
            yield out(keys[:-1], nodes[:-1], company[:-1])
        if joined:
            yield out(*held, np.ones(1, bool))

    by_key = rows.repartition("key").sortWithinPartitions("key", "node")
    return by_key.mapInArrow(run, "key long, node long").distinct()


def similar(pairs: DataFrame, minima_of: DataFrame, percent: int) -> DataFrame:
    """Pairs whose minima agree often enough to be worth comparing sets."""
    share = percent / 100
    least = share - MARGIN * (share * (1 - share) / (BANDS * ROWS)) ** 0.5

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                for c in ("left", "right")
            )
            agree = (left == right).mean(axis=1) >= least
            yield batch.select(["a", "b"]).filter(pa.array(agree))

    left = minima_of.select(F.col("node").alias("a"), F.col("minima").alias("left"))
    right = minima_of.select(F.col("node").alias("b"), F.col("minima").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a long, b long"
    ).distinct()


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs with 100 x intersection >= percent x union of their full shingle sets.

    Sets are compared by their hashes first; what is then linked is compared by its words.
    """

    def enough(one: int, other: int, both: int) -> bool:
        return both > 0 and 100 * both >= percent * (one + other - both)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "left", most=1 << 20):
            sides = [texts_of(batch, side) for side in ("left", "right")]
            hashed = [shingle_sets(*side, words) for side in sides]
            linked = []
            for i, (s, t) in enumerate(zip(*hashed, strict=True)):
                same = enough(len(s), len(t), len(s) + len(t) - len(np.union1d(s, t)))
                if same:
                    s, t = (
                        real_shingles(data[offsets[i] : offsets[i + 1]].tobytes(), words)
                        for data, offsets in sides
                    )
                    same = enough(len(s), len(t), len(s & t))
                linked.append(same)
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        run, "a long, b long"
    )


def across_components(nodes: DataFrame, texts: DataFrame, words: int, percent: int, folder: Written) -> DataFrame:
    """Pairs (a, b) of ``nodes`` (node, component) that may be linked and are of two components.

    Every such pair of linked nodes is among them; see step 5 above. Pairs of one ``cell``, if
    there is such a column and it is not null, are left out.
    """
    c = F.col
    cell = c("cell") if "cell" in nodes.columns else F.lit(None).cast("long")
    nodes = nodes.select("node", "component", F.coalesce(-1 - cell, "component").alias("block"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            sets = shingle_sets(*texts_of(batch), words)
            n = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64)),
                    *(pa.array(np.repeat(batch.column(x).to_numpy(), n)) for x in ("node", "component", "block")),
                    pa.array(np.repeat(n, n)),
                ],
                ["shingle", "node", "component", "block", "n"],
            )

    rows = folder.keep(
        nodes.join(texts, "node").select("node", "component", "block", "text")
        .mapInArrow(run, "shingle long, node long, component long, block long, n long")
    )
    public = (
        rows.groupBy("shingle").agg(
            F.count(F.lit(1)).alias("holders"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.min("block").alias("first"), F.max("block").alias("last"),
        ).where("low != high and first != last").select("shingle", "holders")
    )
    of_node = W.partitionBy("node")
    rarest = (
        rows.join(public, "shingle")
        .withColumn("place", F.row_number().over(of_node.orderBy("holders", "shingle")))
        .withColumn("left", F.count(F.lit(1)).over(of_node) - c("place") + 1)
        # So many are left from here on; a link needs as many and a share of the set.
        .where(c("left") * 100 >= c("n") * percent)
        .select("shingle", "node", "component", "block", "n", "left")
    )
    rarest = folder.keep(rarest)
    one, other = rarest.alias("one"), rarest.alias("other")
    return one.join(
        other,
        (c("one.shingle") == c("other.shingle")) & (c("one.component") < c("other.component"))
        & (c("one.block") != c("other.block"))
        & (F.least("one.left", "other.left") * (100 + percent) >= (c("one.n") + c("other.n")) * percent),
    ).select(
        F.least("one.node", "other.node").alias("a"), F.greatest("one.node", "other.node").alias("b")
    ).distinct()


def cells_of(rows: DataFrame, minima_of: DataFrame) -> DataFrame:
    """(node, cell) of the nodes of ``rows`` (key, node, n) in cells of more than ``SMALL``.

    A cell is named by its centre: of its buckets' heaviest nodes the heaviest that a node is near.
    """
    c = F.col
    weights = rows.groupBy("node").agg(F.sum("n").alias("weight"))
    weighted = rows.select("key", "node").join(weights, "node")
    pivots = weighted.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("pivot"))
    offered = weighted.join(pivots, "key").select(c("node").alias("a"), c("pivot.node").alias("b")).distinct()
    cells = (
        similar(offered, minima_of, NEAR).join(weights.withColumnRenamed("node", "b"), "b").groupBy("a")
        .agg(F.max(F.struct("weight", "b")).alias("best")).select(c("a").alias("node"), c("best.b").alias("cell"))
    )
    large = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(c("n") > SMALL)
    return cells.join(large, "cell").select("node", "cell")


def differences(cells: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """(key, node, debt, least) for each shingle that only one of a node of ``cells`` and its centre has.

    Two nodes are linked if twice their common keys times 100 + percent reach the sum of their
    debts; no debt in a cell is below ``least``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            own, centre = (shingle_sets(*texts_of(batch, side), words) for side in ("text", "centre"))
            found = [np.setxor1d(s, t, assume_unique=True) for s, t in zip(own, centre, strict=True)]
            many = np.array([len(d) for d in found], np.int64)
            debt = (100 + percent) * many - (100 - percent) * np.array([len(s) for s in own], np.int64)
            least = -(100 - percent) * np.array([len(t) for t in centre], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)),
                    *(pa.array(np.repeat(batch.column(x).to_numpy(), many)) for x in ("cell", "node")),
                    pa.array(np.repeat(debt, many)), pa.array(np.repeat(least, many)),
                ],
                ["shingle", "cell", "node", "debt", "least"],
            )

    centres = texts.select(F.col("node").alias("cell"), F.col("text").alias("centre"))
    return (
        cells.join(texts, "node").join(centres, "cell").select("cell", "node", "text", "centre")
        .mapInArrow(run, "shingle long, cell long, node long, debt long, least long")
        .select(F.xxhash64("cell", "shingle").alias("key"), "node", "debt", "least")
    )


def rarest_differences(found: DataFrame, part_of: DataFrame, percent: int) -> DataFrame:
    """Rows of ``differences`` that a link to another component may have first in common: key, node,
    component, debt, place (1: the rarest of its node) and left (how many from there on)."""
    c = F.col
    labelled = found.join(part_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    public = labelled.groupBy("key").agg(
        F.count(F.lit(1)).alias("holders"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low != high").select("key", "holders")
    of_node = W.partitionBy("node")
    return (
        labelled.join(public, "key")
        .withColumn("place", F.row_number().over(of_node.orderBy("holders", "key")))
        .withColumn("left", F.count(F.lit(1)).over(of_node) - c("place") + 1)
        .where(c("left") * 2 * (100 + percent) >= c("debt") + c("least"))
        .select("key", "node", "component", "debt", "place", "left")
    )


def differing_stars(rarest: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): the nodes of each difference with one of them, at first that of the least debt, then a random one."""
    c = F.col
    rank = -c("debt") if turn == 0 else F.xxhash64("key", "node", F.lit(turn))
    pivots = rarest.groupBy("key").agg(
        F.max(F.struct(rank.alias("rank"), "node", "component", "debt", "left")).alias("pivot")
    )
    return (
        rarest.join(pivots, "key").where(
            (c("component") != c("pivot.component"))
            & (F.least("left", "pivot.left") * 2 * (100 + percent) >= c("debt") + c("pivot.debt"))
        ).select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()
    )


def differing_pairs(rarest: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of two components that share so many differences that they may be linked."""
    c = F.col
    one, other = rarest.alias("one"), rarest.alias("other")
    return one.join(
        other,
        (c("one.key") == c("other.key")) & (c("one.component") < c("other.component"))
        & (F.least("one.left", "other.left") * 2 * (100 + percent) >= c("one.debt") + c("other.debt")),
    ).select(
        F.least("one.node", "other.node").alias("a"), F.greatest("one.node", "other.node").alias("b")
    ).distinct()


def settled(stars: DataFrame) -> bool:
    """Whether each node points at one other, which points nowhere: one shuffle."""
    ends = stars.select("u", F.lit(1).alias("out"), F.lit(0).alias("into")).union(
        stars.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("u").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return not seen.agg(F.max(F.expr("out > 1 or (out > 0 and into > 0)"))).first()[0]


def components(edges: DataFrame, folder: Written) -> DataFrame:
    """(node, component) of an edge table (a, b): alternating large-star and small-star.

    Every step needs only the smallest neighbour of each node: a partial minimum and a join.
    The written result is of stars: each node but a component's smallest points at it.
    """
    c = F.col

    def smallest(rows: DataFrame) -> DataFrame:
        return rows.groupBy("u").agg(F.min("v").alias("m"))

    stars = folder.keep(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not settled(stars):
        both = stars.union(stars.select(c("v").alias("u"), c("u").alias("v")))
        large = (
            both.join(smallest(both).withColumn("m", F.least("u", "m")), "u")
            .where("v > u and v != m").select(c("v").alias("u"), c("m").alias("v")).distinct()
        )
        large = folder.keep(large)
        near = large.join(smallest(large), "u")
        small = near.where("v != m").select(c("v").alias("u"), c("m").alias("v")).union(
            near.select("u", c("m").alias("v"))
        ).distinct()
        following = folder.keep(small)
        folder.drop(stars, large)
        stars = following
    return stars.select(c("u").alias("node"), c("v").alias("component"))


def stars_of(part_of: DataFrame) -> DataFrame:
    """Links (a, b) that connect what all links found so far do."""
    return part_of.select(F.col("node").alias("a"), F.col("component").alias("b"))


def open_buckets(rows: DataFrame, part_of: DataFrame) -> DataFrame:
    """(key, node, weight, component, n) of the buckets of ``rows`` that hold several components.

    A bucket that is one component stays one, so the others need not be looked at again.
    """
    labelled = rows.join(part_of, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low != high").select("key", "n")
    return labelled.join(mixed, "key").select("key", "node", "weight", "component", "n")


def star_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): each node with the heaviest of its buckets' heaviest nodes, unless of its component."""
    pivots = rows.groupBy("key").agg(F.max(F.struct("weight", "node", "component")).alias("pivot"))
    return (
        rows.join(pivots, "key").where("component != pivot.component").groupBy("node")
        .agg(F.max("pivot").alias("pivot"))
        .select(F.least("node", "pivot.node").alias("a"), F.greatest("node", "pivot.node").alias("b")).distinct()
    )


def linked_in_cells(
    cells: DataFrame, part_of: DataFrame, texts: DataFrame, words: int, percent: int, folder: Written
) -> DataFrame:
    """(node, component) with all that links within ``cells`` (node, cell) connect; see step 6 above."""
    c = F.col

    def confirm(pairs: DataFrame) -> DataFrame:
        return verified(pairs, texts, words, percent)

    found = folder.keep(differences(cells, texts, words, percent))
    with_centre = cells.where("node != cell").select(c("node").alias("a"), c("cell").alias("b"))
    part_of = components(stars_of(part_of).union(confirm(with_centre)), folder)
    turn = 0
    while True:
        rarest = folder.keep(rarest_differences(found, part_of, percent))
        pairs = folder.keep(differing_stars(rarest.where(c("place") <= RAREST) if turn == 0 else rarest, percent, turn))
        more = folder.keep(confirm(pairs))
        part_of = components(stars_of(part_of).union(more), folder)
        folder.drop(rarest)
        turn += 1
        if turn > 1 and more.count() * ENOUGH <= pairs.count():
            break
    rarest = folder.keep(rarest_differences(found, part_of, percent))
    more = folder.keep(confirm(differing_pairs(rarest, percent)))
    folder.drop(found, rarest)
    return components(stars_of(part_of).union(more), folder)


def grouped(docs: DataFrame, words: int, percent: int, folder: Written) -> DataFrame:
    """node, doc_id, text, n_shingles, component and component_id (its smallest doc_id) of every row."""
    c = F.col
    found = folder.keep(features(docs, words))
    classes = folder.keep(
        found.where("digest is not null").groupBy("digest")
        .agg(F.min("node").alias("speaker"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("digest", "speaker")
    )
    members = found.select("node", "doc_id", "digest").join(classes, "digest", "left").select(
        "node", "doc_id", F.coalesce("speaker", "node").alias("speaker")
    )
    members = folder.keep(members)
    spoken_for = members.where("node != speaker").select("node")
    buckets = folder.keep(shared_buckets(band_rows(found)).join(spoken_for, "node", "left_anti"))
    nodes = buckets.select("node").distinct()
    minima_of = folder.keep(found.select("node", "minima").join(nodes, "node", "left_semi"))
    texts = folder.keep(found.select("node", "text").join(nodes, "node", "left_semi"))
    # The texts of a document that has several are linked.
    several = (
        members.where("doc_id is not null").groupBy("doc_id")
        .agg(F.min("speaker").alias("a"), F.max("speaker").alias("high")).where("a != high")
    )
    part_of = components(
        members.join(several, "doc_id").where("speaker != a").select("a", c("speaker").alias("b")).distinct(), folder
    )
    # A node that shares large buckets with many others is near the middle of its group.
    sizes = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    weights = buckets.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("weight"))
    still_open = folder.keep(open_buckets(buckets.join(weights, "node").select("key", "node", "weight"), part_of))
    turn = 0
    while True:
        pairs = folder.keep(star_pairs(still_open))
        more = folder.keep(verified(similar(pairs, minima_of, percent), texts, words, percent))
        part_of = components(stars_of(part_of).union(more), folder)
        turn += 1
        weight = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(1 << 40))
        following = folder.keep(open_buckets(still_open.select("key", "node", weight.alias("weight")), part_of))
        folder.drop(still_open)
        still_open = following
        if more.count() * ENOUGH <= pairs.count():
            break
    cells = folder.keep(cells_of(still_open.where(c("n") > SMALL), minima_of))
    if not cells.isEmpty():
        part_of = linked_in_cells(cells, part_of, texts, words, percent, folder)
        following = folder.keep(open_buckets(still_open.select("key", "node", "weight"), part_of))
        folder.drop(still_open)
        still_open = following
    small = still_open.where(c("n") <= SMALL)
    one, other = small.alias("one"), small.alias("other")
    pairs = one.join(
        other, (c("one.key") == c("other.key")) & (c("one.component") < c("other.component"))
    ).select(F.least("one.node", "other.node").alias("a"), F.greatest("one.node", "other.node").alias("b")).distinct()
    large = still_open.where(c("n") > SMALL).select("node", "component").distinct().join(cells, "node", "left")
    pairs = similar(pairs, minima_of, percent).union(
        across_components(large, texts, words, percent, folder)
    ).distinct()
    more = folder.keep(verified(pairs, texts, words, percent))
    if not more.isEmpty():
        part_of = components(stars_of(part_of).union(more), folder)
    joined = members.join(part_of.withColumnRenamed("node", "speaker"), "speaker", "left").select(
        "node", "doc_id", F.coalesce("component", "speaker").alias("component")
    )
    # Written, so that the join can split the rows of a large component.
    named = folder.keep(
        joined.groupBy("component").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").select("component", "component_id")
    )
    unnamed = F.when(c("doc_id").isNull(), F.sha2(F.coalesce("text", F.lit("")), 256)).alias("unnamed")
    out = folder.keep(
        joined.join(named, "component", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .join(found.select("node", "n_shingles", unnamed), "node")
    )
    folder.drop(found, classes, members, buckets, minima_of, texts, still_open, cells, more, named)
    return out


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    found = grouped(docs, words, percent, Written(docs.sparkSession, "neardup"))
    return found.select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The documents that stay, all columns as they were: of every group the rows with the smallest
    doc_id, of a group without any doc_id the rows with one of its texts."""
    found = grouped(docs, words, percent, Written(docs.sparkSession, "neardup"))
    named = found.where("doc_id = component_id").select("doc_id", F.lit(None).cast("string").alias("unnamed"))
    others = found.where("component_id is null").groupBy("component").agg(F.min("unnamed").alias("unnamed"))
    kept = named.union(others.select(F.lit(None).cast(docs.schema["doc_id"].dataType), "unnamed")).distinct()
    unnamed = F.when(docs["doc_id"].isNull(), F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    return docs.join(
        kept, docs["doc_id"].eqNullSafe(kept["doc_id"]) & unnamed.eqNullSafe(kept["unnamed"]), "left_semi"
    )
