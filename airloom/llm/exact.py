"""Exact de-duplication by content-defined chunk recipes, in DataFrame functions only.

A normalised text (white space deleted) is cut into chunks where its own characters say
so, hence equal stretches are cut alike. Each chunk gets a 64-bit identifier. One shuffle
of the distinct chunk texts verifies the identifiers: an identifier that two different
chunk texts share is a clash, and documents that hold one are compared by their chunk
texts instead. All others are compared by their ordered identifier lists, so a long
document moves once, as distinct chunks, and afterwards as eight bytes a chunk.

Defined results: a null text counts as empty, and all empty texts are equal. Rows that
repeat a ``doc_id`` each count as a row of the group. A row without ``doc_id`` counts in
its group and is never the one that stays in the report; ``keep_one_of_each`` keeps one row of
a group without any doc_id, its longest. Of rows equal in doc_id and normalised text the
longest stays, then the first by a hash of the text, then by the other columns. Texts of any length are
read whole. Extra columns are ignored, whatever their names. An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from airloom.llm.common import SPACE_CHARS, Written

# Chunk sizes in characters, before a boundary may come and where one is forced.
SHORTEST, LONGEST = 192, 4096
# A boundary follows two characters of this class: of ASCII and Latin letters every fourth
# code point, of other scripts every fourth block of 4096 or of 64.
BOUNDARY = (
    "".join(f"\\x{c:02x}" for c in range(0x21, 0x100, 4))
    + "".join(f"\\x{{{c:x}}}-\\x{{{c + 63:x}}}" for c in range(0x340, 0x1000, 256))
    + "".join(f"\\x{{{c:x}}}-\\x{{{c + 1023:x}}}" for c in range(0x3000, 0xD000, 4096))
)


def chunk_pattern(shortest: int = SHORTEST, longest: int = LONGEST) -> str:
    pair = f"[{BOUNDARY}][{BOUNDARY}]"
    return f"(?s).{{{shortest},{longest - 2}}}?{pair}|.{{1,{longest}}}"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE_CHARS, "")


def recipes(docs: DataFrame, identify: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """doc_id, length (code points of the original), digest, chunks and their identifiers."""
    norm = docs.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("length"),
        normalised(F.col("text")).alias("norm"),
    )
    cut = norm.select(
        "doc_id", "length", F.sha2("norm", 256).alias("digest"),
        F.expr(f"regexp_extract_all(norm, r'{chunk_pattern()}', 0)").alias("chunks"),
    )
    return cut.withColumn("ids", F.transform("chunks", lambda c: identify(c)))


def clashes(cut: DataFrame) -> DataFrame:
    """Identifiers that stand for more than one chunk text."""
    distinct = (
        cut.select(F.explode(F.arrays_zip("ids", "chunks")).alias("c"))
        .select(F.col("c.ids").alias("id"), F.col("c.chunks").alias("chunk"))
        .distinct()
    )
    return distinct.groupBy("id").count().where("count > 1").select("id")


def exact_groups(
    docs: DataFrame, identify: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """Every row of ``docs`` with the row of its group that stays.

    Columns: doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the one with
    the most code points in the original stays, then the smallest doc_id.
    """
    spark = docs.sparkSession
    folder = Written(spark, "exact")
    docs = docs.select("doc_id", "text")
    cut = recipes(docs, identify)
    shared = folder.keep(clashes(cut))
    keyed = cut.select("doc_id", "length", "digest", "ids", "chunks")
    if shared.isEmpty():
        keyed = keyed.withColumn("verbatim", F.lit(None).cast("array<string>"))
    else:
        # Clashing identifiers are few; one row each, joined on the identifier alone.
        marked = (
            cut.select("digest", F.explode("ids").alias("id"))
            .join(shared, "id", "left_semi").select("digest").distinct()
        )
        keyed = keyed.join(marked.withColumn("marked", F.lit(True)), "digest", "left").withColumn(
            "verbatim", F.when(F.col("marked"), F.col("chunks"))
        )
    rows = folder.keep(
        keyed.select("doc_id", "length", "digest", F.struct("ids", "verbatim").alias("recipe"))
    )
    folder.drop(shared)
    by_length = rows.groupBy("recipe", "length").agg(
        F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    # Groups of one need no partner. Written, so that the join can split a large group's rows.
    groups = folder.keep(
        by_length.groupBy("recipe").agg(
            F.max_by("first", F.when(F.col("first").isNotNull(), F.col("length"))).alias("keep_id"),
            F.sum("n").alias("group_size"),
        ).where("group_size > 1")
    )
    # Recipes are equal exactly when the texts are; identical lists join on their hash first.
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(groups, "recipe", "left").select(
        "doc_id", keep_id.alias("keep_id"), F.coalesce("group_size", F.lit(1)).alias("group_size"),
        (F.coalesce(F.col("doc_id") == keep_id, F.lit(False))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The documents that stay, all columns as they were; of repeated rows one stays."""
    groups = exact_groups(docs)
    kept = groups.where("kept or keep_id is null").select(
        F.when(F.col("kept"), F.col("doc_id")).alias("kept"), F.col("text_sha256").alias("digest")
    ).distinct()
    others = [docs[f"`{name}`"] for name in docs.columns if name != "text"]
    rows = docs.select(
        docs["doc_id"].alias("id"), F.sha2(normalised(docs["text"]), 256).alias("norm"),
        F.length(docs["text"]).alias("length"), F.xxhash64(docs["text"]).alias("hash"),
        F.to_json(F.struct(*others)).alias("rest"), F.struct(*[f"`{name}`" for name in docs.columns]).alias("row"),
    )
    same = W.partitionBy("id", "norm").orderBy(F.col("length").desc(), "hash", "rest")
    return (
        rows.join(kept, rows["id"].eqNullSafe(kept["kept"]) & (rows["norm"] == kept["digest"]), "left_semi")
        .withColumn("nth", F.row_number().over(same))
        .where("nth = 1").select("row.*")
    )
