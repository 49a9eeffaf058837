"""A training-data pipeline over ``documents``: identify, de-duplicate, mix, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. ``run`` writes each result as Parquet and hands it to the next stage.

* language ID: documents in which no language is found, such as those without a letter, go;
* exact de-duplication: of texts equal but for white space, the longest, then smallest id stays;
* near duplicates: of each group linked at 80 % of shared five-word shingles one stays;
* mixing: documents are drawn to their sources' targets, in whole or cut to the word, and where
  a source is repeated a second row with the same doc_id follows;
* packing: pieces of at most 2048 ids with their places in sequences.

Nulls, empty and repeated rows are treated as each operator's module says. Rows without doc_id
go through like others; of equal or near ones one stays. Columns beyond doc_id, text, lang, source
and n_chars are carried through unchanged, whatever their names. A stage's table is removed once
the next one is written.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from airloom.llm import exact, languages, mixing, neardup, packing
from airloom.llm.common import Written, table

TOKENIZER = "byte_bpe_50k.json"
SIMILAR = 80


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return languages.keep_identified(docs, languages.train(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_one_of_each(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.keep_one_of_each(docs, percent=SIMILAR)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", identify_languages),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    folder = Written(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = folder.keep(stage(spark, docs, sf_dir))
        if before is not None:
            folder.drop(before)
        before = docs
    return docs


# SQL cannot express the mixture inference, the minima or the packing: see tests/llm.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
