"""Language identification by multilingual mixture inference.

Training counts byte trigrams of words per language over a bounded sample of labelled
documents. A document is read as units of a few words, each with its likelihood under
every language. Expectation-maximisation estimates the document's language proportions;
languages are dropped one by one, the least present first, and the set with the best
penalised likelihood (BIC) stays. The prediction is the most present language of that
set and the score its proportion.

Defined results: a null text, or one without any letter, is ``und`` with score 0, as is
every text when there is nothing to learn from. Equal proportions give the language that
sorts first. Rows that repeat a doc_id are predicted each on its own; a null doc_id is
predicted and counts as not held out. Texts of any length are read whole.
An empty table gives an empty result. Extra columns
are ignored by ``predict`` and kept by ``keep_identified``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import bucket_of, slices, texts_of

UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
BUCKET_BITS = 16
UNIT_WORDS = 4
# Bound of the training sample, in expected documents a language.
SAMPLE_PER_LANGUAGE = 4000
SMOOTHING = 0.5
ROUNDS, CLOSE = 40, 1e-3


def trigrams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where letters are, and the bucket of the trigram around each of them.

    ASCII is lower-cased, every other ASCII byte is a blank, further bytes are letters.
    """
    low = data | np.uint8(0x20)
    letter = (data >= 0x80) | ((low >= 0x61) & (low <= 0x7A))
    plain = np.where(letter, np.where(data >= 0x80, data, low), np.uint8(0x20)).astype(np.uint32)
    padded = np.concatenate([[np.uint32(0x20)], plain, [np.uint32(0x20)]])
    gram = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    at = np.flatnonzero(letter)
    buckets = (gram[at] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
    return at, buckets


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x buckets


def sample_of_labelled(docs: DataFrame, per_language: int) -> tuple[list[str], DataFrame]:
    """Languages learned, and about ``per_language`` training documents of each.

    The sample is a filter on a hash of the id: no text is moved to draw it.
    """
    fold = bucket_of("doc_id", FOLDS)
    learn = docs.where(F.col("lang").isNotNull() & (fold != HELD_OUT)).select("doc_id", "lang", "text")
    sizes = {r.lang: r.n for r in learn.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for lang, n in sizes.items():
        part = F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(1 << 30)) < int(
            min(1.0, per_language / n) * (1 << 30)
        )
        keep = keep | ((F.col("lang") == lang) & part)
    return sorted(sizes), learn.where(keep)


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Smoothed log-probabilities of trigram buckets; languages x buckets numbers."""
    languages, sample = sample_of_labelled(docs, per_language)
    number = {lang: i for i, lang in enumerate(languages)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(languages), 1 << BUCKET_BITS), np.int64)
        for batch in slices(batches):
            data, offsets = texts_of(batch)
            at, buckets = trigrams(data)
            cuts = np.searchsorted(at, offsets)
            for i, lang in enumerate(batch.column("lang").to_pylist()):
                counts[number[lang]] += np.bincount(
                    buckets[cuts[i] : cuts[i + 1]], minlength=1 << BUCKET_BITS
                )
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], ["lang", "bucket", "n"]
        )

    counts = np.full((len(languages), 1 << BUCKET_BITS), SMOOTHING)
    rows = sample.mapInArrow(count, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")
    ).toPandas()
    if len(rows):
        counts[rows["lang"], rows["bucket"]] += rows["n"]
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    return Model(languages, logs.astype(np.float32))


def unit_likelihoods(
    data: np.ndarray, offsets: np.ndarray, logs: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood of every unit of words under every language, and each unit's document."""
    at, buckets = trigrams(data)
    if not len(at):
        return np.zeros((0, len(logs)), np.float32), np.zeros(0, np.int64)
    doc = np.searchsorted(offsets, at, side="right") - 1
    begins = np.flatnonzero(
        np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])])
    )
    of = doc[begins]
    first = np.concatenate([[True], of[1:] != of[:-1]])
    starts = np.flatnonzero(first)
    nth = np.arange(len(begins)) - np.repeat(starts, np.diff(np.append(starts, len(begins))))
    units = begins[nth % UNIT_WORDS == 0]
    out = np.stack([np.add.reduceat(row[buckets], units) for row in logs], axis=1)
    return out, doc[units]


def expect(likely: np.ndarray, starts: np.ndarray, sizes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Shares of each document after EM; a share of 0 stays 0. ``likely``: units x languages."""
    shares = shares.copy()
    open_docs = np.arange(len(sizes))
    for _ in range(ROUNDS):
        if not len(open_docs):
            break
        if len(open_docs) == len(sizes):
            unit, begin = likely, starts
        else:
            n = sizes[open_docs]
            begin = np.concatenate([[0], np.cumsum(n)[:-1]])
            unit = likely[np.repeat(starts[open_docs] - begin, n) + np.arange(n.sum())]
        weight = unit * np.repeat(shares[open_docs], sizes[open_docs], axis=0)
        weight /= weight.sum(axis=1, keepdims=True)
        new = np.stack([np.add.reduceat(c, begin) for c in weight.T], axis=1)
        new /= sizes[open_docs][:, None]
        moved = np.abs(new - shares[open_docs]).max(axis=1)
        shares[open_docs] = new
        open_docs = open_docs[moved > CLOSE]
    return shares


def infer(logs_of_units: np.ndarray, doc: np.ndarray, rows: int) -> np.ndarray:
    """Language shares (rows x languages) of the set with the best penalised likelihood.

    Rows without units have no shares.
    """
    languages = logs_of_units.shape[1]
    out = np.zeros((rows, languages))
    if not len(doc):
        return out
    docs, starts, sizes = np.unique(doc, return_index=True, return_counts=True)
    top = logs_of_units.max(axis=1)
    likely = np.exp((logs_of_units - top[:, None]).astype(np.float32)) + np.float32(1e-30)
    base = np.add.reduceat(top.astype(np.float64), starts)

    def score(shares: np.ndarray) -> np.ndarray:
        mixed = np.log((likely * np.repeat(shares, sizes, axis=0)).sum(axis=1))
        free = np.maximum((shares > 0).sum(axis=1) - 1, 0)
        return base + np.add.reduceat(mixed.astype(np.float64), starts) - 0.5 * free * np.log(sizes)

    shares = np.full((len(docs), languages), 1.0 / languages, np.float32)
    shares = expect(likely, starts, sizes, shares)
    best, best_score = shares, score(shares)
    for _ in range(languages - 1):
        present = np.where(shares > 0, shares, np.float32(2))
        shares = shares.copy()
        several = (shares > 0).sum(axis=1) > 1
        shares[several, present.argmin(axis=1)[several]] = 0
        shares /= shares.sum(axis=1, keepdims=True)
        shares = expect(likely, starts, sizes, shares)
        now = score(shares)
        better = now >= best_score
        best, best_score = np.where(better[:, None], shares, best), np.where(better, now, best_score)
    out[docs] = best
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages (those of the chosen set) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x 65536 numbers
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs = np.array([*shared.value.languages, UNKNOWN], object), shared.value.logs
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            found = np.zeros((batch.num_rows, 1))
            if len(logs):
                found = infer(*unit_likelihoods(data, offsets, logs), batch.num_rows)
            lettered = batch.column("lettered").fill_null(False).to_numpy(zero_copy_only=False)
            found[~lettered] = 0
            top, share = found.argmax(axis=1), found.max(axis=1)
            top[share == 0] = len(names) - 1
            sets = [names[:-1][row > 0].tolist() if len(logs) else [] for row in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("held_out"),
                    pa.array(names[top].tolist(), pa.string()), pa.array(np.clip(share, 0, 1)),
                    pa.array(sets, pa.list_(pa.string())),
                ],
                ["doc_id", "held_out", "lang_pred", "score", "languages"],
            )

    held_out = F.coalesce(bucket_of("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    lettered = F.col("text").rlike(r"\p{L}")
    return docs.select(
        "doc_id", "text", held_out.alias("held_out"), lettered.alias("lettered")
    ).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, lang_pred string, score double, languages array<string>"
    )


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, train(docs))


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """Documents in which any language was found: those ``predict`` does not call ``und``.

    With nothing to learn from, every text with a letter stays. The text's own row is filtered where it is read: nothing is joined or shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shared.value.logs
        for batch in slices(batches, most=1 << 20):
            data, offsets = texts_of(batch)
            found = np.zeros((batch.num_rows, 1))
            if len(logs):
                found = infer(*unit_likelihoods(data, offsets, logs), batch.num_rows)
            kept = pa.array(found.max(axis=1) > 0)
            yield batch.filter(kept) if len(logs) else batch

    return docs.where(F.col("text").rlike(r"\p{L}")).mapInArrow(keep, docs.schema)
