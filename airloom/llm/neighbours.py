"""Approximate nearest neighbours by learned partitions.

1. A bounded sample gives a graph of nearest neighbours, which is cut into balanced
   partitions by recursive bisection: each cut starts at the main direction of its part and
   swaps pairs of vertices across as long as that keeps more neighbours together.
2. A small classifier (one hidden layer, trained in NumPy) learns from a vector which
   partitions its neighbours lie in. Every row of the table is indexed under its likeliest one.
3. A query is routed to its several most probable partitions. How many is measured on sample
   rows kept from training: the fewest that find ``AIM`` of their true neighbours. Vectors
   without structure need most partitions, clustered ones few.
4. All rows of those partitions are ranked by exact cosine, in blocks: a cell holds at most
   ``BLOCK`` rows and ``QUERIES`` queries, whatever the size of the partition.

The number of partitions grows with the square root of the table up to ``MOST``; beyond that, and on
vectors without structure, of which most partitions must be probed, the work grows with the square.

Of equal vectors only the first k + 1 by id can be among anyone's k nearest, so larger groups of
copies are cut to those before they move; no result changes.

Defined results: vectors that are null, zero, hold a null or non-finite component, or have
another dimension than most take no part, nor do rows without vec_id. Ties go to the
smaller vec_id. Rows that share a vec_id are candidates each on its own, but not for each other;
as a query the smallest of their vectors counts. Fewer candidates than k are all returned. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.llm.common import Written

NEAREST = 5
# Partitions, a quarter of the square root of the rows, and their bounds; with that many a query that
# probes few of them meets about as many rows as the square root of the table times its probes.
FEWEST, MOST = 32, 1024
# Sample rows a partition, and the bounds of the training sample, in expected rows.
SHARE, SAMPLE, LARGEST_SAMPLE = 32, 8192, 32768
GRAPH_NEIGHBOURS = 10
AIM = 0.97
HIDDEN, EPOCHS, BATCH, STEP = 128, 40, 256, 3e-3
BLOCK, QUERIES = 4096, 1024
SEED = 5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled by their largest component first, so nothing overflows."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest_in(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None = None) -> np.ndarray:
    """Indices of the k nearest rows of each query, in blocks; ``own`` is left out."""
    out = []
    for i in range(0, len(queries), 512):
        near = queries[i : i + 512] @ rows.T
        if own is not None:
            near[np.arange(len(near)), own[i : i + 512]] = -np.inf
        out.append(np.argpartition(-near, min(k, near.shape[1]) - 1, axis=1)[:, :k])
    return np.concatenate(out)


def bisect(rows: np.ndarray, members: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """Which half each member falls in: halves of equal size, few graph edges cut.

    ``graph`` holds for every vertex its neighbours (indices into ``rows``).
    """
    local = np.full(len(rows), -1)
    local[members] = np.arange(len(members))
    links = local[graph[members]]
    source, target = np.nonzero(links >= 0)[0], links[links >= 0]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    centred = rows[members] - rows[members].mean(axis=0)
    main = np.linalg.eigh(centred.T @ centred)[1][:, -1]
    side = np.zeros(len(members), bool)
    side[np.argsort(centred @ main, kind="stable")[len(members) // 2 :]] = True
    for _ in range(30):
        across = side[source] != side[target]
        gain = np.bincount(source, weights=np.where(across, 1, -1), minlength=len(members))
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left = left[np.argsort(-gain[left], kind="stable")]
        right = right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        pairs = int((gain[left[:n]] + gain[right[:n]] > 0).sum()) // 2
        if not pairs:
            break
        moved = np.concatenate([left[:pairs], right[:pairs]])
        changed = side.copy()
        changed[moved] = ~changed[moved]
        if (changed[source] != changed[target]).sum() >= across.sum():
            break
        side = changed
    return side


def balanced_partitions(rows: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A partition number for every row, by bisecting the neighbour graph; and the graph."""
    own = np.arange(len(rows))
    graph = nearest_in(rows, rows, min(GRAPH_NEIGHBOURS, len(rows) - 1), own)
    label = np.zeros(len(rows), np.int64)
    for _ in range(parts.bit_length() - 1):
        following = label * 2
        for p in np.unique(label):
            members = np.flatnonzero(label == p)
            following[members] += bisect(rows, members, graph)
        label = following
    return label, graph


@dataclass
class Router:
    first: np.ndarray
    shift: np.ndarray
    second: np.ndarray
    offset: np.ndarray
    probes: int = 1

    def chances(self, x: np.ndarray) -> np.ndarray:
        logit = np.maximum(x @ self.first + self.shift, 0) @ self.second + self.offset
        p = np.exp(logit - logit.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def learn_router(x: np.ndarray, target: np.ndarray) -> Router:
    """One hidden layer, softmax, Adam; ``target``: how a row's neighbours are spread."""
    rng = np.random.default_rng(SEED)
    dims, parts = x.shape[1], target.shape[1]
    weights = [
        rng.normal(0, np.sqrt(2 / dims), (dims, HIDDEN)), np.zeros(HIDDEN),
        rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts),
    ]
    mean, power, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), BATCH):
            at, step = order[i : i + BATCH], step + 1
            raw = x[at] @ weights[0] + weights[1]
            hidden = np.maximum(raw, 0)
            logit = hidden @ weights[2] + weights[3]
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - target[at]) / len(at)
            back = (error @ weights[2].T) * (raw > 0)
            for j, g in enumerate((x[at].T @ back, back.sum(0), hidden.T @ error, error.sum(0))):
                mean[j] += 0.1 * (g - mean[j])
                power[j] += 0.001 * (g * g - power[j])
                fixed = np.sqrt(power[j] / (1 - 0.999**step)) + 1e-9
                weights[j] = weights[j] - STEP * mean[j] / (1 - 0.9**step) / fixed
    return Router(*weights)


def partitions_of(rows: int) -> int:
    """A power of two that grows with the rows within its bounds."""
    return min(MOST, max(FEWEST, 1 << max(0, int(np.sqrt(rows) / 4).bit_length() - 1)))


def train(sample: np.ndarray, k: int = NEAREST, parts: int = FEWEST) -> Router:
    """Partitions, classifier and the number of probes, from unit vectors of a sample."""
    while parts > 1 and len(sample) < SHARE * parts * 3 // 4:
        parts //= 2
    held = np.arange(len(sample)) % 8 == 7
    rows, asked = sample[~held], sample[held]
    if parts == 1 or len(rows) <= k:
        dims = sample.shape[1] if len(sample) else 1
        return Router(np.zeros((dims, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1))
    label, graph = balanced_partitions(rows, parts)
    spread = np.eye(parts)[label] + np.eye(parts)[label[graph]].sum(axis=1)
    router = learn_router(rows, spread / spread.sum(axis=1, keepdims=True))
    indexed = router.chances(rows).argmax(axis=1)
    order = np.argsort(-router.chances(asked), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    needed = np.take_along_axis(place, indexed[nearest_in(asked, rows, k)], axis=1)
    found = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    router.probes = int(np.searchsorted(found, AIM)) + 1
    return router


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    c = F.col
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = (
        vectors.select(c("vec_id").cast("long").alias("vec_id"), c("embedding").alias("vector"))
        .where(c("vec_id").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    )
    dims = (
        rows.groupBy(F.size("vector").alias("dims")).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(c("n").desc(), "dims").first()
    )
    return rows.where(F.size("vector") == (dims.dims if dims else 0))


def learned(rows: DataFrame) -> Router:
    """The router, trained on a sample drawn by a hash of the id: about ``SAMPLE`` rows, more for
    more partitions, and never more than about ``LARGEST_SAMPLE``."""
    n = rows.count()
    size = min(LARGEST_SAMPLE, max(SAMPLE, SHARE * partitions_of(n)))
    part = F.pmod(F.xxhash64("vec_id", F.lit(8)), F.lit(1 << 30))
    drawn = rows.where(part < int(min(1.0, size / max(1, n)) * (1 << 30))).toPandas()
    drawn = drawn.sort_values("vec_id", kind="stable")
    if not len(drawn):
        return train(np.zeros((0, 1)))
    # Each distinct vector once, in a fixed random order.
    sample = np.unique(unit(np.stack(drawn["vector"].to_numpy())), axis=0)
    return train(np.random.default_rng(SEED).permutation(sample), parts=partitions_of(n))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), np.float64).reshape(len(flat), -1)


def routed(rows: DataFrame, router: Router, name: str, probes: int) -> DataFrame:
    """Each row once for each of its ``probes`` most probable partitions."""
    shared = rows.sparkSession.sparkContext.broadcast(router)  # hidden x (dimensions + partitions)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            chances = shared.value.chances(unit(matrix(batch.column("vector"))))
            parts = np.argsort(-chances, axis=1, kind="stable")[:, :probes]
            at = pa.array(np.repeat(np.arange(batch.num_rows), parts.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).take(at), batch.column("vector").take(at), pa.array(parts.ravel())],
                [name, "vector", "partition"],
            )

    kind = rows.schema["vector"].dataType.simpleString()
    return rows.select(name, "vector").mapInArrow(run, f"{name} long, vector {kind}, partition long")


def rank_cell(k: int):
    def run(members: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not members.num_rows or not queries.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        own, ids = matrix(members["vector"]), members["vec_id"].to_numpy()
        asked, query_ids = matrix(queries["vector"]), queries["query_id"].to_numpy()
        near = unit(asked) @ unit(own).T
        near[query_ids[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        least = np.partition(near, len(ids) - n, axis=1)[:, len(ids) - n]
        q, m = np.nonzero((near >= least[:, None] - 1e-9) & (near > -np.inf))
        size = lambda x: np.sqrt((x * x).sum(axis=1))
        score = (asked[q] * own[m]).sum(axis=1) / (size(asked)[q] * size(own)[m])
        order = np.lexsort((ids[m], -score, q))
        q, m, score = q[order], m[order], score[order]
        first = np.concatenate([[0], np.flatnonzero(np.diff(q)) + 1]) if len(q) else np.zeros(0, int)
        nth = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        top = nth < k
        return pa.table(
            [pa.array(query_ids[q[top]]), pa.array(ids[m[top]]), pa.array(score[top])], names
        )

    return run


def search(
    vectors: DataFrame, is_query, k: int = NEAREST, block: int = BLOCK, queries: int = QUERIES
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row ``is_query`` holds for."""
    c = F.col
    folder = Written(vectors.sparkSession, "neighbours")
    rows = usable(vectors)
    router = learned(rows)
    asked = rows.where(is_query).groupBy(c("vec_id").alias("query_id")).agg(F.min("vector").alias("vector"))
    copies = W.partitionBy("vector").orderBy("vec_id")
    # Distinct first: an id that is repeated must not take the place of another copy.
    few = rows.distinct().withColumn("nth", F.row_number().over(copies)).where(c("nth") <= k + 1).drop("nth")
    few = folder.keep(routed(few, router, "vec_id", 1))
    asked = folder.keep(routed(asked, router, "query_id", router.probes))
    sizes = few.groupBy("partition").agg(F.count(F.lit(1)).alias("rows"))
    loads = asked.groupBy("partition").agg(F.count(F.lit(1)).alias("asked"))
    cells = sizes.join(loads, "partition").select(
        "partition",
        F.ceil(c("rows") / block * 1.25).cast("long").alias("blocks"),
        F.ceil(c("asked") / queries * 1.25).cast("long").alias("rounds"),
    )
    blocked = (
        few.join(cells, "partition")
        .withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), c("blocks")))
        .withColumn("round", F.explode(F.sequence(F.lit(0), c("rounds").cast("int") - 1)))
        .select("partition", "block", c("round").cast("long").alias("round"), "vec_id", "vector")
    )
    asking = (
        asked.join(cells, "partition")
        .withColumn("round", F.pmod(F.xxhash64("query_id"), c("rounds")))
        .withColumn("block", F.explode(F.sequence(F.lit(0), c("blocks").cast("int") - 1)))
        .select("partition", c("block").cast("long").alias("block"), "round", "query_id", "vector")
    )
    cell = ["partition", "block", "round"]
    found = blocked.groupBy(*cell).cogroup(asking.groupBy(*cell)).applyInArrow(
        rank_cell(k), "query_id long, vec_id long, score double"
    )
    order = W.partitionBy("query_id").orderBy(c("score").desc(), "vec_id")
    return (
        found.distinct().withColumn("rank", F.row_number().over(order)).where(c("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
