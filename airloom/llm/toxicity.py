"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A text is the bag of the character n-grams of its words, word borders included, hashed to
buckets. Each bucket has an embedding; their mean over the text goes through a linear
softmax. Embeddings and softmax are trained jointly in NumPy on a bounded sample of
labelled documents, so a misspelling never seen shares most of its n-grams with the word.
Mean and softmax are linear, so after training each bucket's embedding collapses to its
share of the log-odds, and every whole text is scored by table look-ups.

Defined results: an empty or null text, or one without words, scores the bias alone, and
every text scores the share of toxic labels when one class has no training row. A document
with several labels counts as toxic if one says so; null labels are left out. Rows that
repeat a doc_id are scored each on its own; a null doc_id is scored, and counts as not held
out. Texts of any length are read whole.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import bucket_of, slices, texts_of

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
GRAMS = (3, 4, 5, 6)
BUCKET_BITS = 17
DIMENSIONS = 8
# Bound of the training sample, in expected documents a class.
SAMPLE_PER_CLASS = 2500
EPOCHS, BATCH, STEP = 12, 64, 0.5
SEED = 3


def gram_buckets(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n: the bucket of the n bytes from every position, and whether they count.

    They count if all but the first and last are of one word, so that words of at least
    n - 2 bytes are covered with their borders. ASCII is lower-cased, digits belong to words.
    """
    low = data | np.uint8(0x20)
    upper = (data >= 0x41) & (data <= 0x5A)
    word = (data >= 0x80) | ((low >= 0x61) & (low <= 0x7A)) | ((data >= 0x30) & (data <= 0x39))
    plain = np.where(word, np.where(upper, low, data), np.uint8(0x20)).astype(np.uint32)
    pad = max(GRAMS)
    plain = np.concatenate([[np.uint32(0x20)], plain, np.full(pad, 0x20, np.uint32)])
    word = np.concatenate([[False], word, np.zeros(pad, bool)])
    size = len(data)
    inside, hashed = np.ones(size, bool), plain[:size] * np.uint32(0x01000193)
    hashed += plain[1 : size + 1]
    for n in range(3, pad + 1):
        inside = inside & word[n - 2 : n - 2 + size]
        hashed = hashed * np.uint32(0x01000193) + plain[n - 1 : n - 1 + size]
        if n in GRAMS:
            spread = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            yield (spread >> np.uint32(32 - BUCKET_BITS)), inside


def sums_by_text(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[offsets[1:]] - total[offsets[:-1]]


@dataclass
class Model:
    odds: np.ndarray  # one number a bucket
    bias: float


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Joint training of embeddings and softmax; Adagrad on mini-batches of bags."""
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    soft = rng.normal(0, 0.1, (DIMENSIONS, 2)).astype(np.float32)
    prior = float((weight * toxic).sum() / weight.sum())
    bias = np.log(np.array([1 - prior, prior])).astype(np.float32)
    seen, seen_soft, seen_bias = np.full(len(embed), 1e-6), np.full(soft.shape, 1e-6), np.full(2, 1e-6)
    order, batches = rng.permutation(len(bags)), []
    for i in range(0, len(bags), BATCH):
        chosen = order[i : i + BATCH]
        index = np.concatenate([bags[k][0] for k in chosen])
        share = np.concatenate([bags[k][1] for k in chosen])
        row = np.repeat(np.arange(len(chosen)), [len(bags[k][0]) for k in chosen])
        by = np.argsort(index, kind="stable")
        unique, begin = np.unique(index[by], return_index=True)
        ends = np.flatnonzero(np.diff(row, prepend=-1))
        batches.append((chosen, index, share, row, by, unique, begin, ends))
    scale = weight / weight.mean()
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(batches)):
            chosen, index, share, row, by, unique, begin, ends = batches[k]
            mean = np.zeros((len(chosen), DIMENSIONS), np.float32)
            mean[row[ends]] = np.add.reduceat(embed[index] * share[:, None], ends, axis=0)
            logit = mean @ soft + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), toxic[chosen]] -= 1
            p *= (scale[chosen] / len(chosen))[:, None].astype(np.float32)
            to_mean, to_soft, to_bias = p @ soft.T, mean.T @ p, p.sum(axis=0)
            step = np.add.reduceat((share[:, None] * to_mean[row])[by], begin, axis=0)
            seen[unique] += (step**2).mean(axis=1)
            embed[unique] -= (STEP * step / np.sqrt(seen[unique])[:, None]).astype(np.float32)
            seen_soft += to_soft**2
            seen_bias += to_bias**2
            soft -= (STEP * to_soft / np.sqrt(seen_soft) * 0.2).astype(np.float32)
            bias -= (STEP * to_bias / np.sqrt(seen_bias) * 0.2).astype(np.float32)
    return Model((embed @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def bag(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one text and their shares of it."""
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for buckets, counted in gram_buckets(data):
        counts += np.bincount(buckets[counted], minlength=1 << BUCKET_BITS)
    index = np.flatnonzero(counts)
    return index, (counts[index] / max(1, counts.sum())).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Fit in one task on a sample of about ``per_class`` documents a class.

    The sample is drawn from the label rows by a hash of the id, weighted back to the share
    each class has among them, and small enough to be broadcast to the documents.
    """
    known = (
        labels.where("toxic is not null").where(bucket_of("doc_id", FOLDS) != HELD_OUT)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = {int(r.toxic): r.n for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        odds = np.zeros(1 << BUCKET_BITS, np.float32)
        return Model(odds, 30.0 if sizes.get(1) else -30.0)
    rate = {k: min(1.0, per_class / n) for k, n in sizes.items()}
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(1 << 30))
    limit = F.when(F.col("toxic") == 1, int(rate[1] * (1 << 30))).otherwise(int(rate[0] * (1 << 30)))
    sample = docs.select("doc_id", "text").join(F.broadcast(known.where(part < limit)), "doc_id")

    def learn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in slices(batches):
            data, offsets = texts_of(batch)
            for i, (doc, toxic) in enumerate(
                zip(batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist(), strict=True)
            ):
                index, share = bag(data[offsets[i] : offsets[i + 1]])
                if len(index):
                    rows.append((doc, toxic, index.astype(np.int32), share))
        rows.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2].tobytes()))
        toxic = np.array([int(r[1]) for r in rows], np.int64)
        weight = np.where(toxic == 1, 1 / rate[1], 1 / rate[0])
        if not len(rows):
            return
        model = fit([(r[2], r[3]) for r in rows], toxic, weight)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.odds.tobytes()]), pa.array([model.bias])], ["odds", "bias"]
        )

    fitted = sample.repartition(1).mapInArrow(learn, "odds binary, bias double").collect()
    if not fitted:
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), 0.0)
    return Model(np.frombuffer(fitted[0].odds, np.float32), fitted[0].bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number a bucket
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds, bias = shared.value.odds, shared.value.bias
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            total, n = np.zeros(batch.num_rows), np.zeros(batch.num_rows)
            # Texts stand one after the other: a blank between them keeps grams apart.
            spaced = np.full(len(data) + batch.num_rows, 0x20, np.uint8)
            at = offsets + np.arange(len(offsets))
            spaced[np.arange(len(data)) + np.repeat(np.arange(batch.num_rows), np.diff(offsets))] = data
            for buckets, counted in gram_buckets(spaced):
                total += sums_by_text(np.where(counted, odds[buckets], np.float32(0)), at)
                n += sums_by_text(counted, at)
            logit = bias + total / np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array(1 / (1 + np.exp(-np.clip(logit, -500, 500)))),
                ],
                ["doc_id", "held_out", "score"],
            )

    held_out = F.coalesce(bucket_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    scored = docs.select("doc_id", "text", held_out.alias("held_out")).mapInArrow(
        run, f"doc_id {kind}, held_out boolean, score double"
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
