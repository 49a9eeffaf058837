"""AdaBoost.R2: weighted regression trees, weighted-median vote."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml.base import Model
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.ml.prepare import FEATURES, LABEL
from airloom.session import materialise

CUT_EVERY = 10


def weighted_median(predictions: Column, weights: list[float]) -> Column:
    """Smallest prediction at which half of the total weight is reached."""
    half = 0.5 * sum(weights)
    pairs = F.array_sort(
        F.zip_with(
            predictions,
            F.array(*[F.lit(w) for w in weights]),
            lambda p, w: F.struct(p.alias("p"), w.alias("w")),
        )
    )
    start = F.struct(F.lit(0.0).alias("seen"), F.lit(None).cast("double").alias("at"))
    return F.aggregate(
        pairs,
        start,
        lambda acc, x: F.struct(
            (acc["seen"] + x["w"]).alias("seen"),
            F.when(acc["at"].isNotNull(), acc["at"])
            .when(acc["seen"] + x["w"] >= half, x["p"])
            .alias("at"),
        ),
        lambda acc: acc["at"],
    )


class AdaBoostR2:
    """Linear-loss boosting; each round weighs up the rows the last tree missed.

    A round is one tree fit and two aggregates over the rows.  The row weights
    depend on all trees so far: the newest are kept cached, and every few rounds
    they are written out to cut the lineage.
    """

    def __init__(self, rounds: int = 50, rate: float = 1.0, depth: int = 3, seed: int = 42):
        self.rounds, self.rate, self.depth, self.seed = rounds, rate, depth, seed

    def fit(self, train: DataFrame) -> "AdaBoostR2Model":
        rows = train.select(FEATURES, LABEL, F.lit(1.0).alias("_weight"))
        trees, votes, cached = [], [], []
        for step in range(self.rounds):
            tree = DecisionTreeRegressor(
                maxDepth=self.depth, weightCol="_weight", seed=self.seed + step,
                featuresCol=FEATURES, labelCol=LABEL, predictionCol="_guess",
            ).fit(rows)
            missed = tree.transform(rows).withColumn("_miss", F.abs(F.col(LABEL) - F.col("_guess")))
            sums = missed.agg(
                F.max("_miss").alias("worst"),
                (F.sum(F.col("_miss") * F.col("_weight")) / F.sum("_weight")).alias("mean"),
            ).first()
            worst = sums["worst"] or 0.0
            loss = sums["mean"] / worst if worst > 0 else 0.0
            if loss <= 0:
                trees.append(tree)
                votes.append(1.0)
                break
            if loss >= 0.5:
                if not trees:
                    trees.append(tree)
                    votes.append(1.0)
                break
            beta = loss / (1 - loss)
            trees.append(tree)
            votes.append(self.rate * math.log(1 / beta))
            if step + 1 == self.rounds:
                break
            heavier = F.col("_weight") * F.pow(F.lit(beta), (1 - F.col("_miss") / worst) * self.rate)
            rows = missed.select(FEATURES, LABEL, heavier.alias("_weight"))
            if (step + 1) % CUT_EVERY == 0:
                rows = materialise(rows, "boost")
            cached.append(rows.persist(StorageLevel.MEMORY_AND_DISK))
            # The newest rows are read from the ones before until they are cached.
            if len(cached) > 2:
                cached.pop(0).unpersist()
        for old in cached:
            old.unpersist()
        return AdaBoostR2Model(trees, votes)


class AdaBoostR2Model(Model, MLWritable, MLReadable):
    """Trees and their votes; saved as one folder a tree beside the metadata."""

    def __init__(self, trees: list = (), votes: list[float] = ()):
        super().__init__()
        self.trees, self.votes = list(trees), list(votes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df, kept = dataset, dataset.columns
        for i, tree in enumerate(self.trees):
            df = tree.copy({tree.predictionCol: f"_guess_{i}"}).transform(df)
        guesses = F.array(*[F.col(f"_guess_{i}") for i in range(len(self.trees))])
        return df.select(*kept, weighted_median(guesses, self.votes).alias("prediction"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: AdaBoostR2Model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(
            self.model, path, self.sparkSession, extraMetadata={"votes": self.model.votes}
        )
        for i, tree in enumerate(self.model.trees):
            tree.write().save(f"{path}/trees/{i}")


class _Reader(MLReader):
    def load(self, path: str) -> AdaBoostR2Model:
        votes = DefaultParamsReader.loadMetadata(path, self.sparkSession)["votes"]
        trees = [DecisionTreeRegressionModel.load(f"{path}/trees/{i}") for i in range(len(votes))]
        return AdaBoostR2Model(trees, votes)
