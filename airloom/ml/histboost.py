"""Second-order gradient boosting on histograms of binned features.

Features are binned once at quantiles of a sketch. A tree grows level by level: every task adds
up gradients and Hessians of its rows by (node, feature, bin), the sums of all tasks meet in one
shuffle a level, and each node's best split is chosen among its features' bins there; only the
splits, a few numbers a node, reach the driver. Rows never move. The score of the trees so far
is a column of the binned table, written anew every few trees; the newest trees are
evaluated on the fly.

For the squared loss the gradient is prediction minus label and the Hessian 1. A split's gain
is GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2), a leaf's value -G / (H + l2) times the rate.
Ties go to the first feature and bin. A missing value cannot occur: the matrix is filled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.base import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.ml.prepare import FEATURES, LABEL
from airloom.session import materialise

BINS = 128
# Trees after which the scores are written anew.
WRITE_EVERY = 10
SUMS = "node int, feature int, bin int, g double, h double"


class Tree:
    """Arrays over the nodes 0, 1, 2 ... of a full binary tree: node k has children 2k+1 and 2k+2."""

    def __init__(self, depth: int):
        size = (1 << (depth + 1)) - 1
        self.depth = depth
        self.feature = np.full(size, -1, np.int32)  # -1: no split
        self.bin = np.zeros(size, np.int32)  # bins up to it go left
        self.threshold = np.zeros(size)  # so do values up to it
        self.value = np.zeros(size)

    def descend(self, columns: np.ndarray, cuts: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node of each row (a column each of ``columns``, bins or values)."""
        node = np.zeros(columns.shape[1], np.int64)
        for _ in range(self.depth if levels is None else levels):
            feature = self.feature[node]
            split = feature >= 0
            right = columns[np.maximum(feature, 0), np.arange(len(node))] > cuts[node]
            node = np.where(split, 2 * node + 1 + right, node)
        return node


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an array of (features, rows)."""
    return np.asarray(column.flatten()).reshape(-1, width).T


class HistogramBoosting:
    def __init__(self, rounds: int = 100, depth: int = 6, rate: float = 0.1, l2: float = 1.0,
                 bins: int = BINS, least_gain: float = 1e-12):
        self.rounds, self.depth, self.rate, self.l2 = rounds, depth, rate, l2
        self.bins, self.least_gain = bins, least_gain

    def edges(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """Upper ends of each feature's bins but the last: distinct quantiles of a sketch, one scan."""
        at = F.array(*[F.lit(k / self.bins) for k in range(1, self.bins)])
        found = rows.agg(*[F.percentile_approx(F.get("x", F.lit(j)), at, 10 * self.bins).alias(f"q{j}") for j in range(width)]).first()
        return [np.unique(np.array(found[f"q{j}"] or [], float)) for j in range(width)]

    def fit(self, train: DataFrame) -> "HistogramBoostingModel":
        rows = train.select(vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("double").alias("y"))
        facts = rows.agg(F.first(F.size("x")).alias("width"), F.avg("y").alias("base")).first()
        if facts["base"] is None:
            raise ValueError("no rows to boost on")
        width, base = facts["width"], facts["base"]
        edges = self.edges(rows, width)

        def to_bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _matrix(batch.column("x"), width)
                binned = np.stack([np.searchsorted(e, v, side="left") for e, v in zip(edges, x, strict=True)], axis=1)
                offsets = pa.array(np.arange(len(binned) + 1, dtype=np.int32) * width)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(offsets, pa.array(binned.ravel().astype(np.int32))), batch.column("y"),
                     pa.array(np.full(len(binned), base))],
                    ["b", "y", "score"],
                )

        kind = "b array<int>, y double, score double"
        table = materialise(rows.mapInArrow(to_bins, kind), "bins")
        trees, fresh = [], []
        for _ in range(self.rounds):
            tree = self.grow(table, fresh, width, edges)
            if tree.feature[0] < 0 and not trees:
                break
            trees.append(tree)
            fresh.append(tree)
            if tree.feature[0] < 0:
                break
            if len(fresh) == WRITE_EVERY:
                table, fresh = materialise(self.scored(table, fresh, width, kind), "bins"), []
        return HistogramBoostingModel(base, width, trees)

    @staticmethod
    def scored(table: DataFrame, trees: list[Tree], width: int, kind: str) -> DataFrame:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                columns, score = _matrix(batch.column("b"), width), batch.column("score").to_numpy().copy()
                for tree in trees:
                    score += tree.value[tree.descend(columns, tree.bin)]
                yield pa.RecordBatch.from_arrays([batch.column("b"), batch.column("y"), pa.array(score)], ["b", "y", "score"])

        return table.mapInArrow(run, kind)

    def grow(self, table: DataFrame, fresh: list[Tree], width: int, edges: list[np.ndarray]) -> Tree:
        tree, l2 = Tree(self.depth), self.l2
        slots = max(len(e) for e in edges) + 1
        for level in range(self.depth + 1):
            first = (1 << level) - 1

            def sums(batches: Iterable[pa.RecordBatch], level=level, first=first) -> Iterator[pa.RecordBatch]:
                size = (1 << level) * width * slots
                g, h = np.zeros(size), np.zeros(size)
                for batch in batches:
                    columns = _matrix(batch.column("b"), width)
                    score = batch.column("score").to_numpy().copy()
                    for old in fresh:
                        score += old.value[old.descend(columns, old.bin)]
                    node = tree.descend(columns, tree.bin, level) - first
                    here = node >= 0  # rows whose node was not split stay above
                    gradient = (score - batch.column("y").to_numpy())[here]
                    for j in range(width):
                        at = (node[here] * width + j) * slots + columns[j][here]
                        g += np.bincount(at, gradient, size)
                        h += np.bincount(at, minlength=size)
                at = np.flatnonzero(h)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at // slots // width + first).astype(np.int32)), pa.array((at // slots % width).astype(np.int32)),
                     pa.array((at % slots).astype(np.int32)), pa.array(g[at]), pa.array(h[at])],
                    ["node", "feature", "bin", "g", "h"],
                )

            summed = table.mapInArrow(sums, SUMS).groupBy("node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
            in_order = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
            whole = Window.partitionBy("node", "feature")
            term = lambda g, h: g * g / (h + l2)
            left = summed.select(
                "node", "feature", "bin", F.sum("g").over(in_order).alias("gl"), F.sum("h").over(in_order).alias("hl"),
                F.sum("g").over(whole).alias("gt"), F.sum("h").over(whole).alias("ht"),
            )
            gl, hl, gt, ht = (F.col(c) for c in ("gl", "hl", "gt", "ht"))
            gain = F.when(ht > hl, term(gl, hl) + term(gt - gl, ht - hl) - term(gt, ht))
            best = left.select("node", "feature", "bin", "gt", "ht", F.round(gain, 9).alias("gain")).groupBy("node").agg(
                F.max(F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("best"), F.max("gt").alias("g"), F.max("ht").alias("h")
            )
            found = best.collect()  # one row a node of the level
            for row in found:
                tree.value[row["node"]] = -self.rate * row["g"] / (row["h"] + l2)
                gain, feature, cut = row["best"]
                if level < self.depth and gain is not None and gain > self.least_gain:
                    tree.feature[row["node"]], tree.bin[row["node"]] = -feature, -cut
                    tree.threshold[row["node"]] = edges[-feature][-cut]
            if not any(tree.feature[row["node"]] >= 0 for row in found):
                break
        return tree


class HistogramBoostingModel(Model, MLWritable, MLReadable):
    """A base value and trees; saved as one row a node."""

    def __init__(self, base: float = 0.0, width: int = 0, trees: list[Tree] = ()):
        super().__init__()
        self.base, self.width, self.trees = base, width, list(trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shared = dataset.sparkSession.sparkContext.broadcast((self.base, self.width, self.trees))  # bounded by the rounds

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            base, width, trees = shared.value
            columns = np.array(x.tolist(), float).reshape(-1, width).T
            score = np.full(columns.shape[1], base)
            for tree in trees:
                score += tree.value[tree.descend(columns, tree.threshold)]
            return pd.Series(score)

        return dataset.withColumn("prediction", predict(vector_to_array(FEATURES)))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: HistogramBoostingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        depth = max((t.depth for t in self.model.trees), default=0)
        facts = {"base": self.model.base, "width": self.model.width, "trees": len(self.model.trees), "depth": depth}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=facts)
        rows = [
            (i, k, int(t.feature[k]), float(t.threshold[k]), float(t.value[k]))
            for i, t in enumerate(self.model.trees) for k in range(len(t.feature))
        ]
        table = self.sparkSession.createDataFrame(rows, "tree int, node int, feature int, threshold double, value double")
        table.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> HistogramBoostingModel:
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        trees = [Tree(facts["depth"]) for _ in range(facts["trees"])]
        for r in self.sparkSession.read.parquet(f"{path}/nodes").collect():  # bounded by the rounds
            tree = trees[r["tree"]]
            tree.feature[r["node"]], tree.threshold[r["node"]], tree.value[r["node"]] = r["feature"], r["threshold"], r["value"]
        return HistogramBoostingModel(facts["base"], facts["width"], trees)
