"""Token counts with the whole-token shortcut.

Before any text is read, the driver proves which vocabulary strings come out as exactly one
token when they stand as a pre-token. Texts are split into pre-tokens; those strings count
one without merging, only the rest is merged, by the library's own model, and remembered up
to a bound. Texts the vocabulary's proofs do not cover are counted by the library itself.

Defined results: a null text is empty and has 0 tokens; rows are independent, so repeated
rows repeat their counts; a null doc_id is kept. Texts of any length are read whole.
An empty table gives an empty result.
Extra columns are ignored. The counts do not depend on partitions or order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import slices, texts_of
from airloom.llm.vocabulary import Vocabulary, long_runs, vocabulary

LIMIT = 512
REMEMBERED = 400_000


class Counter(dict):
    """Tokens of a pre-token; merged on first sight and remembered up to a bound."""

    def __init__(self, vocab: Vocabulary, bound: int = REMEMBERED) -> None:
        super().__init__(vocab.whole_tokens)
        self.vocab, self.bound = vocab, bound + len(self)

    def __missing__(self, piece: str) -> int:
        n = len(self.vocab.merged(piece))
        if len(self) >= self.bound:
            self.clear()
            self.update(self.vocab.whole_tokens)
        self[piece] = n
        return n

    def tokens(self, text: str, long_run: bool) -> int:
        if long_run or self.vocab.needs_library(text):
            return len(self.vocab.library.encode(text, add_special_tokens=False).ids)
        parts = [text]
        for special in self.vocab.specials:
            parts = [p for part in parts for p in part.split(special)]
        found = len(parts) - 1
        return found + sum(sum(map(self.__getitem__, self.vocab.pieces(p))) for p in parts)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))  # a file of fixed size

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in slices(batches):
            _, offsets = texts_of(batch)
            long, texts = long_runs(batch), batch.column("text").to_pylist()
            n = [counter.tokens(t or "", bool(x)) for t, x in zip(texts, long, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(offsets[1:] - offsets[:-1]), pa.array(n, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
