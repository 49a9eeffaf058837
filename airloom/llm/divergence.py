"""Audit of how sources of a language differ, from one-hot level products.

The kept terms of a language are dealt to blocks by a hash. In a block a term is a row of
indicators: one column for each (group, count level), a level being a count that occurs in
the group within the block, zero included. The indicators times their transpose are the
joint tables of all pairs of groups at once: how many terms stand at level c of one group
and level d of another. The product is taken in tiles of columns, in floats that hold its
whole numbers exactly. Every cell has one price, so a table is priced by cells, not by terms,
and the prices of blocks are added up. The language is one more group: its table with a
group prices the group's terms, of which a block hands on its first ``TOP``.

All prices are whole numbers: p = 1 + floor(SCALE * (count + 1) / (N + V)) and
f = floor((p - q)^2 / q) are taken in Python integers or in 64 bits, whose bound (p - q)^2
keeps, since p is at most SCALE + 1.

Defined results: null text, lang and source are empty strings. A text without terms, an empty
or a null one adds nothing but its group, which has rows of ``pair`` all the same. Repeated
rows count each, doc_id is not read. A language without kept terms prices every pair 0. A
language with one source has no pairs. Equal values rank by the bytes of the item. Very long
texts are read in pieces, never cut. An empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter, _count_elements
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.llm.common import Written

SCALE = 1_000_000_000
LEAST_DOCS = 3
TOP = 200
# Terms a block and sources a tile hold on average: a task has those of two tiles at most.
BLOCK_TERMS, TILE_SOURCES = 1024, 128
# Columns of a tile of the product; its cells are counts of a block's terms, exact in 24 bits.
TILE = 2048
# Different terms held in a task before they are handed on.
HELD = 400_000
# A text of more bytes is counted as it is read, without a list of its words.
LONG = 16 << 20

TERM = re.compile(rb"[a-z\x80-\xff]+")


def words_of(text: bytes) -> Iterable[bytes]:
    low = text.lower()  # of bytes: A-Z alone
    return TERM.findall(low) if len(low) <= LONG else (m.group() for m in TERM.finditer(low))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, docs, n) of every document, added up; a row '' for each group."""
    kind = "lang string, source string, term string, docs long, n long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        seen: dict = {}

        def rows() -> pa.RecordBatch:
            sizes = [len(of) for of in total.values()]
            entries, group = sum(sizes), pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))
            names = [pa.array(part, pa.string()) for part in zip(*total, strict=True)]
            docs = chain.from_iterable(map(seen[g].__getitem__, of) for g, of in total.items())
            counts = chain.from_iterable(of.values() for of in total.values())
            columns = [
                *(pa.DictionaryArray.from_arrays(group, part).dictionary_decode() for part in names),
                pa.array(list(chain.from_iterable(total.values())), pa.binary()).cast(pa.string()),
                pa.array(np.fromiter(docs, np.int64, entries)), pa.array(np.fromiter(counts, np.int64, entries)),
            ]
            total.clear()
            seen.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "docs", "n"])

        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for text, group in zip(texts, groups, strict=True):
                if group not in total:
                    total[group], seen[group] = {b"": 0}, {b"": 0}
                words = words_of(text.as_py())
                if not isinstance(words, list):
                    of = Counter(words)
                    for word, n in of.items():
                        total[group][word] = total[group].get(word, 0) + n
                    _count_elements(seen[group], of)
                else:
                    _count_elements(total[group], words)
                    _count_elements(seen[group], set(words))
            if sum(map(len, total.values())) > HELD:
                yield rows()
        if total:
            yield rows()

    plain = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = plain.mapInArrow(run, kind)
    return found.groupBy("lang", "source", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"))


def shares(counts: np.ndarray, total: int, vocabulary: int) -> np.ndarray:
    """p of each count: Python integers where 64 bits could run over."""
    return np.array([1 + SCALE * (int(c) + 1) // (total + vocabulary) for c in counts], np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def joint_prices(groups: int, group: np.ndarray, p: np.ndarray, indicators: np.ndarray) -> np.ndarray:
    """Sum of f over a block's terms for every ordered pair of groups.

    ``indicators`` has a row a term and a column a (group, level); ``group`` and ``p`` are the
    columns' own, in order of group.
    """
    value = np.zeros((groups, groups), np.int64)
    columns = len(group)
    for i in range(0, columns, TILE):
        left = indicators[:, i : i + TILE]
        for j in range(0, columns, TILE):
            joint = (left.T @ indicators[:, j : j + TILE]).astype(np.int64)
            priced = joint * price(p[i : i + TILE, None], p[None, j : j + TILE])
            a, begin_a = np.unique(group[i : i + TILE], return_index=True)
            b, begin_b = np.unique(group[j : j + TILE], return_index=True)
            by_group = np.add.reduceat(np.add.reduceat(priced, begin_a, axis=0), begin_b, axis=1)
            value[np.ix_(a, b)] += by_group
    return value


def price_block(counts: pa.Table, groups: pa.Table) -> pa.Table:
    """A block's rows of ``pair`` (sums still to be added) and ``term`` (its first ``TOP``).

    The groups are those of one or two tiles; pairs within a tile are left to the task that
    has the tile alone, and so are the terms.
    """
    known = sorted(groups.to_pylist(), key=lambda r: r["source"].encode())
    out: dict = {"source": [], "part": [], "item": [], "value": []}
    lang = known[0]["lang"] if known else None
    alone = not known or known[0]["i"] == known[0]["j"]
    sources = [r["source"] for r in known]
    encoded = counts.column("term").combine_chunks().dictionary_encode()
    names = np.array([t.encode() for t in encoded.dictionary.to_pylist()], object)
    order = np.argsort(names) if len(names) else np.zeros(0, np.int64)
    place = np.empty(len(names), np.int64)
    place[order] = np.arange(len(names))
    names = names[order]
    value = np.zeros((len(sources), len(sources)), np.int64)
    if len(names) and len(sources):
        of = {s: i for i, s in enumerate(sources)}
        row = np.array([of[s] for s in counts.column("source").to_pylist()], np.int64)
        term = place[encoded.indices.to_numpy()]
        table = np.zeros((len(sources), len(names)), np.int64)
        table[row, term] = counts.column("n").to_numpy()
        whole = np.zeros(len(names), np.int64)
        whole[term] = counts.column("of_term").to_numpy()
        # Columns: a group's levels in order, one group after the other.
        begin, columns, p = [], [], []
        for i, r in enumerate(known):
            unique, which = np.unique(table[i], return_inverse=True)
            begin.append(sum(map(len, p)))
            columns.append(begin[-1] + which)
            p.append(shares(unique, r["total"], r["vocabulary"]))
        group = np.repeat(np.arange(len(known)), [len(x) for x in p])
        indicators = np.zeros((len(names), len(group)), np.float32)
        for at in columns:
            indicators[np.arange(len(names)), at] = 1
        value = joint_prices(len(known), group, np.concatenate(p), indicators)
        unique, which = np.unique(whole, return_inverse=True)
        q = shares(unique, known[0]["of_lang"], known[0]["vocabulary"])
        for i, source in enumerate(sources) if alone else ():
            # The cells of the joint table of the group and its language hold the terms' prices.
            cell, mine = price(p[i][:, None], q[None, :]), columns[i] - begin[i]
            found = np.flatnonzero((table[i] > 0) & (p[i][mine] > q[which]))
            worth = cell[mine[found], which[found]]
            best = np.lexsort((found, -worth))[:TOP]
            out["source"] += [source] * len(best)
            out["part"] += ["term"] * len(best)
            out["item"] += [names[k].decode() for k in found[best]]
            out["value"] += worth[best].tolist()
    # Terms of the block that no source of the task has are at level 0 of all.
    absent = max((r["terms"] for r in known), default=0) - len(names)
    if absent:
        p = np.concatenate([shares(np.zeros(1, np.int64), r["total"], r["vocabulary"]) for r in known])
        value += absent * price(p[:, None], p[None, :])
    for i, r in enumerate(known):
        others = [j for j, o in enumerate(known) if j != i and (alone or o["tile"] != r["tile"])]
        out["source"] += [sources[i]] * len(others)
        out["part"] += ["pair"] * len(others)
        out["item"] += [sources[j] for j in others]
        out["value"] += value[i, others].tolist()
    kinds = {"source": pa.string(), "part": pa.string(), "item": pa.string(), "value": pa.int64()}
    table = pa.table({k: pa.array(v, kinds[k]) for k, v in out.items()})
    return table.add_column(0, "lang", pa.array([lang] * len(table), pa.string()))


def audit(docs: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank; ``top`` of at most ``TOP`` terms a group."""
    if not 0 < top <= TOP:
        raise ValueError(f"top is 1 to {TOP}")
    folder = Written(docs.sparkSession, "divergence")
    counts = folder.keep(term_counts(docs))
    vocabulary = folder.keep(
        counts.where("term != ''").groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_term"))
        .where(F.col("docs") >= LEAST_DOCS).drop("docs")
    )
    kept = folder.keep(counts.drop("docs").join(vocabulary, ["lang", "term"]))
    of_lang = vocabulary.groupBy("lang").agg(
        F.count(F.lit(1)).alias("vocabulary"), F.sum("of_term").alias("of_lang")
    )
    all_groups = counts.where("term = ''").select("lang", "source")
    zero, tile = F.lit(0).cast("long"), F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    languages = folder.keep(
        all_groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / TILE_SOURCES).cast("int").alias("tiles"))
        .join(of_lang, "lang", "left").na.fill(0, ["vocabulary", "of_lang"])
        .withColumn("blocks", F.ceil(F.greatest(F.col("vocabulary"), F.lit(1)) / BLOCK_TERMS).cast("int"))
    )
    groups = folder.keep(
        all_groups.join(kept.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(languages, "lang").withColumn("total", F.coalesce("total", zero)).withColumn("tile", tile)
    )
    # A row goes to every pair of tiles that holds its own: one pair, unless sources are many.
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    pair = [F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j")]
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    sizes = folder.keep(
        vocabulary.join(languages, "lang").select("lang", block).groupBy("lang", "block")
        .agg(F.count(F.lit(1)).alias("terms"))
    )
    dealt = (
        kept.join(languages, "lang").withColumn("tile", tile).withColumn("block", block)
        .select("*", other).select("lang", "block", *pair, "source", "term", "n", "of_term")
    )
    spread = (
        groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .join(sizes, ["lang", "block"], "left").na.fill(0, ["terms"]).select("*", other)
        .select("lang", "block", *pair, "tile", "source", "total", "vocabulary", "of_lang", "terms")
    )
    key = ("lang", "block", "i", "j")
    priced = folder.keep(
        dealt.groupBy(*key).cogroup(spread.groupBy(*key)).applyInArrow(
            price_block, "lang string, source string, part string, item string, value long"
        )
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = (
        priced.where("part = 'pair'").groupBy("lang", "source", "part", "item")
        .agg(F.sum("value").alias("value")).withColumn("rank", F.row_number().over(order))
    )
    terms = (
        priced.where("part = 'term'").withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
    )
    folder.drop(counts, vocabulary, kept, languages, groups, sizes)
    return pairs.unionByName(terms.select(*pairs.columns)).select("lang", "source", "part", "item", "value", "rank")
