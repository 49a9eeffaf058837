"""Exact k-nearest-neighbour regression with inverse-distance weights.

A training set of checked size is broadcast and searched in blocks. A larger one is put into a
tree of cells: the rows of a cell are divided among pivots drawn from it, and cells of more
than ``leaf_rows`` rows are divided again, so the depth grows with the rows and a leaf does not.
Of each cell the radius around its pivot and the ``k`` reaches nearest to it are kept.

Queries go down level by level. Distances to the pivots bound the k-th neighbour's distance
from above, and a cell is left out if even its nearest possible row is further away. The most
promising leaf is searched first; its k-th distance then leaves few of the others. Queries and
rows meet only at leaves, in chunks of bounded size on both sides, and a task keeps the k best
rows per query and chunk, so no list of pairs is ever written.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.base import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.ml.prepare import FEATURES, LABEL
from airloom.session import materialise

BROADCAST_VALUES = 4_000_000  # doubles: 32 MB
FAN = 64
LEAF_ROWS = 4_000
CHUNK_ROWS = 20_000
BLOCK = 200
ROOT = 0
# Bounds are computed in floating point; they are widened by this much.
SLACK = 1e-9
# A cell that holds nearly all rows of its parent is not divided further.
SHRINK = 0.95


def _distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances by direct differences, column by column."""
    total = np.zeros((len(queries), len(points)))
    for column in range(queries.shape[1]):
        total += (queries[:, column, None] - points[None, :, column]) ** 2
    return np.sqrt(total)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


def _best(queries: np.ndarray, points: np.ndarray, labels: np.ndarray, k: int):
    distances = _distances(queries, points)
    k = min(k, len(points))
    nearest = np.argpartition(distances, k - 1, axis=1)[:, :k]
    return np.take_along_axis(distances, nearest, axis=1), labels[nearest]


def _weighted(distances: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Inverse-distance mean; exact matches alone decide where there are any."""
    exact = distances == 0
    any_exact = exact.any(axis=1, keepdims=True)
    with np.errstate(divide="ignore"):
        weights = np.where(any_exact, exact.astype(float), 1.0 / distances)
    return (weights * labels).sum(axis=1) / weights.sum(axis=1)


def _dealt(rows: DataFrame, key: str, sizes: DataFrame, chunk_rows: int) -> DataFrame:
    """``rows`` with a chunk number, so that (cell, chunk) holds about ``chunk_rows`` of them."""
    chunks = sizes.select("cell", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks"))
    return (
        rows.join(chunks, "cell")
        .withColumn("chunk", F.pmod(F.xxhash64(key), F.col("chunks")).cast("int")).drop("chunks")
    )


def _copied(table: DataFrame, sizes: DataFrame, chunk_rows: int) -> DataFrame:
    """One copy of ``table``'s rows of a cell for each of its chunks."""
    chunks = sizes.select("cell", F.ceil(F.col("n") / chunk_rows).cast("int").alias("chunks"))
    return table.join(chunks, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")


def grow(rows: DataFrame, k: int, fan: int, leaf_rows: int, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """Points (cell, id, x, y) in leaves, and nodes (cell, parent, n, radius, near, pivot, leaf)."""
    open_rows = materialise(
        rows.withColumns({"cell": F.lit(ROOT).cast("long"), "id": F.monotonically_increasing_id()}), "cells"
    )
    sizes = open_rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    points, nodes, level = [], [], 0

    def divide(known: pd.DataFrame, chosen: pd.DataFrame) -> pd.DataFrame:
        if known.empty:
            return pd.DataFrame({"cell": [], "parent": [], "id": [], "x": [], "y": [], "reach": []})
        x, pivots = _matrix(known["x"]), _matrix(pd.Series(list(chosen["pivots"].iloc[0])))
        nearest, reach = [], []
        for i in range(0, len(x), BLOCK):
            distances = _distances(x[i : i + BLOCK], pivots)
            nearest.append(distances.argmin(axis=1))
            reach.append(distances.min(axis=1))
        parent = known["cell"].to_numpy()
        return pd.DataFrame({
            "cell": parent * (fan + 1) + np.concatenate(nearest) + 1, "parent": parent, "id": known["id"],
            "x": known["x"], "y": known["y"], "reach": np.concatenate(reach),
        })

    while True:
        level += 1
        by_hash = Window.partitionBy("cell").orderBy(F.xxhash64("id", F.lit(level)))
        chosen = materialise(
            open_rows.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= fan)
            .groupBy("cell").agg(F.array_sort(F.array_distinct(F.collect_list("x"))).alias("pivots")),
            "pivots",
        )
        placed = materialise(
            _dealt(open_rows, "id", sizes, chunk_rows).groupBy("cell", "chunk")
            .cogroup(_copied(chosen, sizes, chunk_rows).groupBy("cell", "chunk"))
            .applyInPandas(divide, "cell long, parent long, id long, x array<double>, y double, reach double"),
            "cells",
        )
        nearest = Window.partitionBy("cell").orderBy("reach")
        near = (
            placed.select("cell", "reach").withColumn("rank", F.row_number().over(nearest))
            .filter(F.col("rank") <= k).groupBy("cell").agg(F.sort_array(F.collect_list("reach")).alias("near"))
        )
        pivot = chosen.select(F.col("cell").alias("parent"), F.posexplode("pivots").alias("place", "pivot")).select(
            (F.col("parent") * (fan + 1) + F.col("place") + 1).alias("cell"), "pivot"
        )
        facts = placed.groupBy("cell", "parent").agg(
            F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")
        )
        small = (F.col("n") <= leaf_rows) | (F.col("n") > SHRINK * F.col("of_parent"))
        made = materialise(
            facts.join(near, "cell").join(pivot, "cell")
            .join(sizes.select(F.col("cell").alias("parent"), F.col("n").alias("of_parent")), "parent")
            .select("cell", "parent", "n", "radius", "near", "pivot", small.alias("leaf")),
            "nodes",
        )
        nodes.append(made)
        leaves = made.filter("leaf").select("cell")
        points.append(placed.join(leaves, "cell", "left_semi").select("cell", "id", "x", "y"))
        sizes = made.filter("NOT leaf").select("cell", "n")
        if sizes.isEmpty():
            break
        open_rows = placed.join(sizes.select("cell"), "cell", "left_semi").select("x", "y", "cell", "id")
    return materialise(reduce(DataFrame.unionByName, points), "points"), materialise(
        reduce(DataFrame.unionByName, nodes), "nodes"
    )


class NearestNeighbours:
    def __init__(self, k: int = 5, broadcast_values: int = BROADCAST_VALUES, fan: int = FAN,
                 leaf_rows: int = LEAF_ROWS, chunk_rows: int = CHUNK_ROWS):
        self.k, self.broadcast_values = k, broadcast_values
        self.fan, self.leaf_rows, self.chunk_rows = fan, leaf_rows, chunk_rows

    def fit(self, train: DataFrame) -> "NearestNeighboursModel":
        rows = train.select(vector_to_array(FEATURES).alias("x"), F.col(LABEL).cast("double").alias("y"))
        first = rows.select(F.size("x")).first()
        size = rows.count() * (first[0] if first else 0)
        if size <= self.broadcast_values:
            return NearestNeighboursModel(self.k, self.chunk_rows, rows)
        points, nodes = grow(rows, self.k, self.fan, self.leaf_rows, self.chunk_rows)
        return NearestNeighboursModel(self.k, self.chunk_rows, points, nodes)


class NearestNeighboursModel(Model, MLWritable, MLReadable):
    """The training rows: all of a small set, or the leaves of a tree with its nodes."""

    def __init__(self, k: int = 5, chunk_rows: int = CHUNK_ROWS, points: DataFrame = None, nodes: DataFrame = None):
        super().__init__()
        self.k, self.chunk_rows, self.points, self.nodes = k, chunk_rows, points, nodes
        if points is not None and nodes is None:
            table = points.select("x", "y").toPandas()  # at most ``broadcast_values`` doubles
            self.small = _matrix(table["x"]), table["y"].to_numpy(float)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._scan(dataset) if self.nodes is None else self._search(dataset)

    def _scan(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.small)
        k = self.k

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            points, labels = shared.value
            queries = _matrix(x)
            out = [
                _weighted(*_best(queries[i : i + BLOCK], points, labels, k))
                for i in range(0, len(queries), BLOCK)
            ]
            return pd.Series(np.concatenate(out) if out else [])

        return df.withColumn("prediction", predict(vector_to_array(FEATURES)))

    def visits(self, queries: DataFrame) -> DataFrame:
        """(query, x, cell, lower, upper): the leaves that may hold a neighbour of each query (query, x).

        ``lower`` bounds the distance of a leaf's rows from below, ``upper`` the k-th neighbour's
        from above.
        """
        k = self.k

        def down(asked: pd.DataFrame, below: pd.DataFrame) -> pd.DataFrame:
            if asked.empty or below.empty:
                return pd.DataFrame({c: [] for c in ("query", "x", "cell", "leaf", "lower", "upper")})
            pivots, radius = _matrix(below["pivot"]), below["radius"].to_numpy(float)
            near = np.full((len(below), k), np.inf)
            for i, reaches in enumerate(below["near"]):
                near[i, : len(reaches)] = reaches
            x, known, out = _matrix(asked["x"]), asked["upper"].to_numpy(float), []
            for i in range(0, len(x), BLOCK):
                part, distances = asked.iloc[i : i + BLOCK], _distances(x[i : i + BLOCK], pivots)
                reachable = (distances[:, :, None] + near[None]).reshape(len(part), -1)
                upper = np.minimum(known[i : i + BLOCK], np.partition(reachable, k - 1, axis=1)[:, k - 1])
                lower = np.maximum(distances - radius[None], 0.0)
                row, cell = np.nonzero(lower <= upper[:, None] * (1 + SLACK) + SLACK)
                out.append(pd.DataFrame({
                    "query": part["query"].to_numpy()[row], "x": part["x"].to_numpy()[row],
                    "cell": below["cell"].to_numpy()[cell], "leaf": below["leaf"].to_numpy()[cell],
                    "lower": lower[row, cell], "upper": upper[row],
                }))
            return pd.concat(out)

        # A cell's children meet its queries in one group: no more than the fan.
        children = self.nodes.select(
            F.col("parent").alias("cell"), F.col("cell").alias("child"), "radius", "near", "pivot", "leaf"
        )
        open_ = materialise(
            queries.select("query", "x", F.lit(ROOT).cast("long").alias("cell"), F.lit(float("inf")).alias("upper")), "visits"
        )
        leaves = []
        while True:
            load = open_.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
            below = _copied(children, load, self.chunk_rows)
            step = (
                _dealt(open_, "query", load, self.chunk_rows).groupBy("cell", "chunk")
                .cogroup(below.groupBy("cell", "chunk"))
                .applyInPandas(
                    lambda asked, kids: down(asked, kids.drop(columns="cell").rename(columns={"child": "cell"})),
                    "query long, x array<double>, cell long, leaf boolean, lower double, upper double",
                )
            )
            found = materialise(self._tightened(step), "visits")
            leaves.append(found.filter("leaf").drop("leaf"))
            open_ = found.filter("NOT leaf").select("query", "x", "cell", "upper")
            if open_.isEmpty():
                break
        return self._tightened(reduce(DataFrame.unionByName, leaves))

    @staticmethod
    def _tightened(visits: DataFrame) -> DataFrame:
        """Visits within the lowest upper bound that any of a query's cells gives."""
        least = visits.groupBy("query").agg(F.min("upper").alias("least"))
        return (
            visits.join(least, "query").withColumn("upper", F.col("least")).drop("least")
            .filter(F.col("lower") <= F.col("upper") * (1 + SLACK) + SLACK)
        )

    def _found(self, visits: DataFrame) -> DataFrame:
        """(query, distances, labels): the k best rows of each chunk a query visits."""
        k = self.k

        def search(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            if asked.empty or known.empty:
                return pd.DataFrame({"query": [], "distances": [], "labels": []})
            points, labels, x = _matrix(known["x"]), known["y"].to_numpy(float), _matrix(asked["x"])
            found = [_best(x[i : i + BLOCK], points, labels, k) for i in range(0, len(x), BLOCK)]
            return pd.DataFrame({
                "query": asked["query"],
                "distances": [d for f in found for d in f[0]], "labels": [y for f in found for y in f[1]],
            })

        sizes = self.points.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        load = visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        # Both sides are cut: a group of queries meets every chunk of rows of its cell.
        left = _copied(_dealt(visits, "query", load, self.chunk_rows).withColumnRenamed("chunk", "part"), sizes, self.chunk_rows)
        right = _dealt(self.points, "id", sizes, self.chunk_rows)
        right = _copied(right.withColumnRenamed("chunk", "rows"), load, self.chunk_rows).withColumnsRenamed({"chunk": "part", "rows": "chunk"})
        by = ["cell", "chunk", "part"]
        return (
            left.groupBy(*by).cogroup(right.groupBy(*by))
            .applyInPandas(search, "query long, distances array<double>, labels array<double>")
        )

    def _search(self, df: DataFrame) -> DataFrame:
        k = self.k
        queries = materialise(df.withColumn("_query", F.monotonically_increasing_id()), "queries")
        visits = materialise(
            self.visits(queries.select(F.col("_query").alias("query"), vector_to_array(FEATURES).alias("x"))), "visits"
        )
        # First each query's most promising leaf; its k-th distance rules out most others.
        first = visits.groupBy("query").agg(F.min_by("cell", F.struct("lower", "cell")).alias("first"))
        marked = visits.join(first, "query").withColumn("now", F.col("cell") == F.col("first"))
        near = materialise(self._found(marked.filter("now").select("query", "x", "cell")), "found")
        kth = near.select("query", F.explode("distances").alias("d")).groupBy("query").agg(
            F.sort_array(F.collect_list("d")).alias("d")
        ).select("query", F.get("d", F.lit(k - 1)).alias("kth"))
        others = (
            marked.filter("NOT now").join(kth, "query", "left")
            .filter(F.coalesce(F.col("lower") <= F.col("kth") * (1 + SLACK) + SLACK, F.lit(True)))
            .select("query", "x", "cell")
        )
        found = near.unionByName(self._found(materialise(others, "visits")))
        ranked = Window.partitionBy("query").orderBy("d")
        best = (
            found.select("query", F.inline(F.arrays_zip(F.col("distances").alias("d"), F.col("labels").alias("y"))))
            .withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
            .groupBy("query")
            .agg(
                F.avg(F.when(F.col("d") == 0, F.col("y"))).alias("exact"),
                F.try_divide(
                    F.sum(F.try_divide(F.col("y"), F.col("d"))), F.sum(F.try_divide(F.lit(1.0), F.col("d")))
                ).alias("weighted"),
            )
            .select(F.col("query").alias("_query"), F.coalesce("exact", "weighted").alias("prediction"))
        )
        return queries.join(best, "_query").drop("_query")


class _Writer(MLWriter):
    def __init__(self, model: NearestNeighboursModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        facts = {"k": self.model.k, "chunk_rows": self.model.chunk_rows, "tree": self.model.nodes is not None}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=facts)
        self.model.points.write.parquet(f"{path}/points")
        if self.model.nodes is not None:
            self.model.nodes.write.parquet(f"{path}/nodes")


class _Reader(MLReader):
    def load(self, path: str) -> NearestNeighboursModel:
        spark = self.sparkSession
        facts = DefaultParamsReader.loadMetadata(path, spark)
        nodes = spark.read.parquet(f"{path}/nodes") if facts["tree"] else None
        return NearestNeighboursModel(facts["k"], facts["chunk_rows"], spark.read.parquet(f"{path}/points"), nodes)
