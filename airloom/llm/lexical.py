"""Ranked lexical search by range-maximum sparse tables on posting lists.

Documents are read once and become rows of (terms of the items that they hold, occurrences);
rows are taken in shards of ``SHARD_DOCS``, in which the posting list of each term gets the
impacts of its documents and a sparse table of range maxima over them. An item is searched in
a shard best first: an interval of documents is bounded by the sum, over the item's terms, of
the range maximum of each posting list within it. The intervals with the highest bounds are
split at the document of their largest term impact; that document is an interval of one,
whose bound is its exact score, and both remainders are bounded anew. An interval goes when
its bound is below the score of the item's ``top``-th document so far, which a task carries
from shard to shard. Nothing else is left out, so the ``top`` documents are exact.

The items' terms stand in the tasks as a broadcast table. Items are taken in rounds whose
terms stay within ``ROUND_BYTES``, so that the table is bounded whatever their number.

Defined results: null and empty texts have no terms, are no part of N and are never found; an
item without terms finds nothing. Rows that repeat a doc_id are documents of their own, and
each may be ranked; so are items that repeat an item_id. Equal scores rank by doc_id, a null
doc_id last, then by the number of terms. Terms that no document holds add nothing. Texts of
any length are read whole. An empty table on either side gives an empty result; extra columns
are ignored.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import IntegerType, StructField, StructType

from airloom.llm.common import Written

TOP = 20
# A shard is closed at so many documents or postings; rows are looked at by slices.
SHARD_DOCS, SHARD_POSTINGS, SLICE = 8192, 1 << 21, 256
# Bytes of text of the items searched in one round, and so of their different terms.
ROUND_BYTES = 4 << 20
# Widest set of intervals taken from the queue at once.
WAVE = 4096
# A text of more bytes is counted as it is read, without a list of its words.
LONG = 16 << 20

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes) -> Iterable[bytes]:
    low = text.lower()  # of bytes: A-Z alone
    return TERM.findall(low) if len(low) <= LONG else (m.group() for m in TERM.finditer(low))


def read_documents(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with a term: the numbers of the items' terms they hold."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)  # at most ROUND_BYTES of terms
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            keep, n, begin, terms, tfs = [], [], [0], [], []
            for i, text in enumerate(batch.column("text").cast(pa.large_binary())):
                held = Counter(terms_of(text.as_py()))
                if not held:
                    continue
                for term in held.keys() & wanted.keys():
                    terms.append(wanted[term])
                    tfs.append(held[term])
                keep.append(i)
                n.append(held.total())
                begin.append(len(terms))
            begin = pa.array(begin, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(begin, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(begin, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>")


class Postings:
    """The posting lists of a shard, one after the other, with their sparse tables.

    ``table[k][i]`` is the place of the largest impact among the 2^k postings from i; ranges
    asked for never leave a list, so the lists share each level.
    """

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int) -> None:
        order = np.lexsort((doc, term))
        self.doc, self.docs = doc[order], docs
        self.impact = impact[order] if len(order) else np.zeros(1, np.int64)
        terms, begin = np.unique(term[order], return_index=True)
        end = np.append(begin[1:], len(order))[: len(terms)]
        self.lists = {int(t): (int(a), int(b)) for t, a, b in zip(terms, begin, end, strict=True)}
        best = [np.arange(max(1, len(order)), dtype=np.int32)]
        longest = max((b - a for a, b in self.lists.values()), default=0)
        while 1 << len(best) <= longest:
            half = 1 << (len(best) - 1)
            left, right = best[-1][:-half], best[-1][half:]
            best.append(np.where(self.impact[left] >= self.impact[right], left, right))
        self.table = np.zeros((len(best), len(best[0])), np.int32)
        for k, level in enumerate(best):
            self.table[k, : len(level)] = level
        self.log = np.zeros(docs + 2, np.int8)
        for k in range(1, len(self.table)):
            self.log[1 << k :] = k
        self.flat = self.table.ravel()

    def before(self, terms: list[int]) -> np.ndarray:
        """For each document and term: the place in the term's list of its first posting from there."""
        out = np.empty((self.docs + 1, len(terms)), np.int32)
        for i, t in enumerate(terms):
            a, b = self.lists[t]
            out[:, i] = a
            counts = np.zeros(self.docs, np.int32)
            counts[self.doc[a:b]] = 1
            out[1:, i] += np.cumsum(counts, dtype=np.int32)
        return out

    def maxima(self, before: np.ndarray, lo: np.ndarray, hi: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bound of each interval [lo, hi), and the document of its largest term impact."""
        a, b = before[lo], before[hi]
        size = b - a
        k = self.log[size].astype(np.int64)
        row = k * self.table.shape[1]
        # An empty range may start behind the last posting; its answer counts nothing.
        a = np.minimum(a, self.table.shape[1] - 1)
        left = self.flat[row + a]
        right = self.flat[row + np.maximum(b - (1 << k), a)]
        place = np.where(self.impact[left] >= self.impact[right], left, right)
        worth = np.where(size > 0, self.impact[place], 0) * times
        largest = worth.argmax(axis=1)
        return worth.sum(axis=1), self.doc[place[np.arange(len(lo)), largest]]


class Found:
    """The best documents of an item in a shard; ``rank`` puts equal scores in order."""

    def __init__(self, top: int, least: int) -> None:
        self.top, self.floor = top, least
        self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, score: np.ndarray, doc: np.ndarray, rank: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((rank[doc], -score))[: self.top]
        self.score, self.doc = score[order], doc[order]

    @property
    def least(self) -> int:
        """A document that scores less is not among the best."""
        return max(self.floor, int(self.score[-1])) if len(self.score) == self.top else self.floor


def search_shard(shard: Postings, item: dict[int, int], rank: np.ndarray, top: int, floor: int) -> Found:
    """Best-first search for one item in one shard, by waves of the highest bounds.

    ``floor`` is a score known to be needed, 1 at least: a document scoring 0 is not found.
    """
    found = Found(top, floor)
    terms = [t for t in item if t in shard.lists]
    if not terms:
        return found
    times = np.array([item[t] for t in terms], np.int64)
    before = shard.before(terms)
    lo, hi = np.array([0]), np.array([shard.docs])
    bound, split = shard.maxima(before, lo, hi, times)
    wave = 16
    while len(lo):
        now, later = np.arange(len(lo)), np.zeros(0, np.int64)
        if len(lo) > wave:
            parted = np.argpartition(-bound, wave)
            now, later = parted[:wave], parted[wave:]
        wave = min(2 * wave, WAVE)
        at = split[now]
        exact, _ = shard.maxima(before, at, at + 1, times)
        good = exact >= found.least
        found.add(exact[good], at[good], rank)
        new_lo, new_hi = np.concatenate([lo[now], at + 1]), np.concatenate([at, hi[now]])
        some = new_lo < new_hi
        new_lo, new_hi = new_lo[some], new_hi[some]
        new_bound, new_split = shard.maxima(before, new_lo, new_hi, times)
        lo, hi = np.concatenate([lo[later], new_lo]), np.concatenate([hi[later], new_hi])
        bound, split = np.concatenate([bound[later], new_bound]), np.concatenate([split[later], new_split])
        still = bound >= found.least
        lo, hi, bound, split = lo[still], hi[still], bound[still], split[still]
    return found


def order_key(doc) -> tuple:
    """Ids in ascending order, a missing one last."""
    return (doc is None, 0 if doc is None else doc)


def search_documents(read: DataFrame, weights: np.ndarray, items: list[dict[int, int]], n_docs: int, length: int, top: int) -> DataFrame:
    """(number of the item, doc_id, score): each task's best documents for each item."""
    shared = read.sparkSession.sparkContext.broadcast((weights, items))  # bounded by the round
    kind = read.schema["doc_id"].dataType.simpleString()

    def shards(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        held, docs, postings = [], 0, 0
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                held.append(batch)
                docs += batch.num_rows
                postings += len(batch.column("terms").flatten())
                if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, docs, postings = [], 0, 0
        if docs:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, items = shared.value
        best: list[list] = [[] for _ in items]
        for table in shards(batches):
            ids = table.column("doc_id").to_pylist()
            n = table.column("n").to_numpy()
            terms, tfs = table.column("terms").combine_chunks(), table.column("tfs").combine_chunks()
            row = np.repeat(np.arange(len(n)), terms.value_lengths().to_numpy())
            term, tf = terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            # Documents with the same most frequent term and of like length stand together,
            # so that the bounds of an interval are near the scores within it.
            chief = np.full(len(n), -1, np.int64)
            by = np.lexsort((-term, tf, row))
            chief[row[by]] = term[by]
            place = np.empty(len(n), np.int64)
            order = np.lexsort((n, chief))
            place[order] = np.arange(len(n))
            rank = np.empty(len(n), np.int64)
            rank[place[sorted(range(len(n)), key=lambda i: order_key(ids[i]))]] = np.arange(len(n))
            m = 75 + 25 * n * n_docs // length
            impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[row]))
            shard = Postings(term, place[row], impact, len(n))
            for number, item in enumerate(items):
                mine = best[number]
                floor = mine[-1][0] if len(mine) == top else 1
                found = search_shard(shard, item, rank, top, max(1, floor))
                if len(found.doc):
                    mine += [(s, ids[d]) for s, d in zip(found.score.tolist(), order[found.doc].tolist(), strict=True)]
                    mine.sort(key=lambda r: (-r[0], *order_key(r[1])))
                    del mine[top:]
        rows = [(number, *r) for number, mine in enumerate(best) for r in mine]
        if rows:
            numbers, scores, docs = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int32()), pa.array(docs, read_type), pa.array(scores, pa.int64())],
                ["number", "doc_id", "score"],
            )

    read_type = to_arrow_type(read.schema["doc_id"].dataType)
    return read.mapInArrow(run, f"number int, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents for the text of each item."""
    spark = docs.sparkSession
    folder = Written(spark, "lexical")
    asked = folder.keep(items.select("item_id", F.coalesce("text", F.lit("")).alias("text")))
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-size // ROUND_BYTES))
    results = []
    for turn in range(rounds):
        now = asked.where(F.pmod(F.xxhash64("text"), F.lit(rounds)) == turn).collect()
        numbers: dict[bytes, int] = {}
        wanted = [
            {numbers.setdefault(t, len(numbers)): k for t, k in Counter(terms_of(r.text.encode())).items()}
            for r in now
        ]
        read = folder.keep(read_documents(docs, numbers))
        totals = read.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("length")).first()
        weights = np.zeros(len(numbers), np.int64)
        for r in read.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[r.term] = math.floor(1000 * math.log((2 * totals.docs + 2) / (2 * r["count"] + 1)))
        best = search_documents(read, weights, wanted, totals.docs, totals.length or 1, top)
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        names = spark.createDataFrame(
            [(i, r.item_id) for i, r in enumerate(now)], StructType([StructField("number", IntegerType()), asked.schema["item_id"]])
        )
        results.append(folder.keep(ranked.join(F.broadcast(names), "number").select("item_id", "rank", "doc_id", "score")))
        folder.drop(read)
    folder.drop(asked)
    return functools.reduce(DataFrame.unionAll, results)
