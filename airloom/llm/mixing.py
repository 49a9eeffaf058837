"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of at most ``block_words`` words. Within a source the blocks
stand in the order of a hash of (seed, doc_id, block): a fixed permutation. A source's
target decides exactly how many words are drawn: the permuted blocks from the first on,
the last one cut to the word, and where the target is above the source's size a second
round from the start. The exact number of blocks drawn from each source is split over the
output shards by a binary tree whose nodes draw from the multivariate hypergeometric
distribution; each shard owns disjoint ranges of the permuted blocks and orders them by
a hash of its own.

Only one row a source reaches the driver (its number of blocks drawn), and the plan sent
back holds sources x shards numbers.

Defined results: a null text has no words and is never drawn; a null source is a source of
its own, last in order; rows that repeat a doc_id are documents of their own, told apart by
source, size and a hash of the text. Without any word all targets are 0. Texts of any length
are read whole. An empty table gives an empty result. Extra columns, whatever their names, are
ignored by ``draw`` and kept as they are by ``mixed_documents``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.llm.common import WORD_CLASS, Written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2.0
BLOCK_WORDS = 1024
SHARDS = 64
SEED = 17
ORDER = ["key", "doc_id", "copy", "block"]


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_CLASS)).cast("long")


def source_targets(
    sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS
) -> DataFrame:
    """source, source_size, target: shares by weight, stopped at ``repeats`` x the size.

    Sources are sorted by how soon they are full. With the first k full, the rest of the words
    is shared by weight among the others, at a level (words a unit of weight) that rises with
    every source that was over its limit and falls with every one that was not: the highest
    level is the one at which no source is above its limit. One row a source.
    """
    c = F.col
    by_name = W.orderBy(c("source").asc_nulls_last())
    full = W.orderBy("full_at", c("source").asc_nulls_last())
    before, onwards = full.rowsBetween(W.unboundedPreceding, -1), full.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    weight = F.array(*map(F.lit, map(float, weights)))
    rows = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("weight", F.element_at(weight, (F.row_number().over(by_name) - 1) % len(weights) + 1))
        .withColumn("limit", c("source_size") * repeats)
        .withColumn("full_at", c("limit") / c("weight"))
        .withColumn(
            "level",
            (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
            / F.sum("weight").over(onwards),
        )
        .withColumn("level", F.max("level").over(everything))
    )
    return rows.select(
        "source", "source_size",
        F.least("limit", c("level") * c("weight")).alias("target"),
    )


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (rows) for each shard (columns); every row sums to its quota."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(quotas), shards), dtype=np.int64)

    def split(left: np.ndarray, first: int, last: int) -> None:
        if last - first == 1:
            out[:, first] = left
            return
        middle = (first + last) // 2
        share = int(left.sum()) * (middle - first) // (last - first)
        drawn = rng.multivariate_hypergeometric(left, share, method="marginals")
        split(drawn, first, middle)
        split(left - drawn, middle, last)

    split(quotas.astype(np.int64), 0, shards)
    return out


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, copy (numbers the rows that share a doc_id), source, size."""
    rows = docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), told_apart(docs))
    same = W.partitionBy("doc_id").orderBy("source", "size", "hash")
    return rows.withColumn("copy", F.row_number().over(same)).drop("hash")


def told_apart(docs: DataFrame) -> Column:
    """Puts rows that share doc_id, source and size in an order that every run finds again."""
    return F.xxhash64(docs["text"]).alias("hash")


def same_source(a: DataFrame, b: DataFrame) -> Column:
    return a["source"].eqNullSafe(b["source"])


def draw(
    sizes: DataFrame, targets: DataFrame, folder: Written,
    block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED,
) -> DataFrame:
    """Every block drawn: doc_id, copy, block, round, words, shard, place.

    Sorting by (shard, place) gives the mix.
    """
    c = F.col
    blocks = (
        sizes.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.ceil(c("size") / block_words) - 1)))
        .select(
            "doc_id", "copy", "source", "block",
            F.least(F.lit(block_words), c("size") - c("block") * block_words).alias("n"),
            F.md5(
                F.concat_ws(":", F.lit(seed), c("doc_id"), c("block")).cast("binary")
            ).alias("key"),
        )
    )
    # Prefix sums without gathering a source: ranges, their totals, offsets of the ranges.
    ordered = folder.keep(
        blocks.repartitionByRange(c("source").asc_nulls_last(), *ORDER)
        .withColumn("part", F.spark_partition_id())
    )
    parts = ordered.groupBy("source", "part").agg(
        F.sum("n").alias("part_words"), F.count(F.lit(1)).alias("part_blocks")
    )
    earlier = W.partitionBy("source").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select(
        c("source").alias("of_source"), c("part").alias("of_part"),
        F.coalesce(F.sum("part_words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("part_blocks").over(earlier), F.lit(0)).alias("blocks_before"),
        F.sum("part_blocks").over(W.partitionBy("source")).alias("source_blocks"),
    )
    facts = offsets.join(
        targets.withColumnRenamed("source", "name"), c("of_source").eqNullSafe(c("name"))
    ).drop("name")
    within = W.partitionBy("source", "part").orderBy(*ORDER)
    placed = (
        ordered.withColumn("words", F.sum("n").over(within.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("rank", F.row_number().over(within))
        .join(facts, (c("part") == c("of_part")) & c("source").eqNullSafe(c("of_source")))
    )
    begin = c("words_before") + c("words") - c("n")
    rounds = F.array(F.lit(0), F.lit(1))
    left = F.round("target").cast("long") - c("round") * c("source_size") - begin
    drawn = folder.keep(
        placed.withColumn("round", F.explode(rounds))
        .withColumn("taken", F.greatest(F.lit(0), F.least(c("n"), left)))
        .where("taken > 0")
        .select(
            "doc_id", "copy", "source", "block", "round", c("taken").alias("words"), "key",
            (c("round") * c("source_blocks") + c("blocks_before") + c("rank") - 1).alias("draw"),
        )
    )
    folder.drop(ordered)
    quotas = drawn.groupBy("source").agg(F.count(F.lit(1)).alias("n")).orderBy(
        c("source").asc_nulls_last()
    ).collect()
    ends = np.cumsum(split_quotas(np.array([q.n for q in quotas], np.int64), shards, seed), axis=1)
    plan = sizes.sparkSession.createDataFrame(
        [(q.source, e.tolist()) for q, e in zip(quotas, ends, strict=True)],
        "of_source string, ends array<bigint>",
    )
    return drawn.join(plan, c("source").eqNullSafe(c("of_source"))).select(
        "doc_id", "copy", "block", "round", "words",
        F.size(F.filter("ends", lambda e: e <= c("draw"))).alias("shard"),
        F.xxhash64("key", "round", F.lit(seed)).alias("place"),
    )


def mix_report(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, size, source_size, target and the words taken of every document."""
    folder = Written(docs.sparkSession, "mixing")
    sizes = folder.keep(sized(docs))
    targets = folder.keep(source_targets(sizes))
    drawn = draw(sizes, targets, folder, **settings)
    taken = drawn.groupBy(F.col("doc_id").alias("of_doc"), F.col("copy").alias("of_copy")).agg(
        F.sum("words").alias("taken")
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("copy") == F.col("of_copy"))
    return (
        sizes.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .join(taken, same, "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, **settings) -> DataFrame:
    """The mix as documents: the rows of ``mixed_shards`` in its order, without shard and place."""
    return mixed_shards(docs, block_words, **settings).select("row.*")


def mixed_shards(docs: DataFrame, block_words: int = BLOCK_WORDS, **settings) -> DataFrame:
    """shard, place, blocks and row: what each shard has drawn of a document in a round.

    A shard holds exactly the blocks of each source that the tree gives it: a long document whose
    blocks went to several shards has a row in each, of its blocks there. ``row`` is the document's
    own row with its text cut to the words drawn, as it is where they are all, and ``n_chars``
    counted anew. The rows are range partitioned and sorted by (shard, place): the mix is
    their order.
    """
    c = F.col
    folder = Written(docs.sparkSession, "mixing")
    sizes = folder.keep(sized(docs))
    targets = folder.keep(source_targets(sizes))
    drawn = draw(sizes, targets, folder, block_words=block_words, **settings)
    # Draws are gathered by id, so that the texts are shuffled once, by id alone.
    no_id = F.lit(-(2**63))
    draws = (
        drawn.groupBy(F.coalesce("doc_id", no_id).alias("of_id"), "copy", "round", "shard")
        .agg(
            F.sum("words").alias("taken"), F.min("place").alias("place"),
            F.array_sort(F.collect_list(F.struct("block", "words"))).alias("blocks"),
        )
        .groupBy("of_id")
        .agg(F.collect_list(F.struct("copy", "round", "shard", "place", "taken", "blocks")).alias("draws"))
    )
    columns = [f"`{name}`" for name in docs.columns]
    same = W.partitionBy("id").orderBy("source", "size", "hash")
    numbered = docs.select(
        F.coalesce(docs["doc_id"], no_id).alias("id"), docs["source"].alias("source"),
        docs["text"].alias("text"), words_in(docs["text"]).alias("size"), told_apart(docs),
        F.struct(*columns).alias("row"),
    ).withColumn("number", F.row_number().over(same))
    words = F.expr(r"regexp_extract_all(text, r'[\x20\x09-\x0D]*[^\x20\x09-\x0D]+', 0)")
    cut = F.array_join(
        F.flatten(
            F.transform("draw.blocks", lambda b: F.slice(c("words"), b["block"] * block_words + 1, b["words"]))
        ),
        "",
    )
    part = c("draw.taken") < c("size")
    out = (
        numbered.join(draws, c("id") == c("of_id"))
        .withColumn("mine", F.filter("draws", lambda d: d["copy"] == c("number"))).drop("draws")
        # A text is taken apart once, however many shards have a part of it.
        .withColumn("words", F.when(F.exists("mine", lambda d: d["taken"] < c("size")), words))
        .withColumn("draw", F.explode("mine")).drop("mine")
        .withColumn("text", F.when(part, cut).otherwise(c("text")))
        .withColumn("row", c("row").withField("text", c("text")))
    )
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("row", c("row").withField("n_chars", F.length("text").cast(kind)))
    stands = out.select(
        c("draw.shard").alias("shard"), c("draw.place").alias("place"), F.size("draw.blocks").alias("blocks"), "row"
    )
    return stands.repartitionByRange("shard", "place").sortWithinPartitions("shard", "place")
