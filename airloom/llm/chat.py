"""Chat formatting from an event log, in DataFrame functions only.

``reconstruct`` folds a log (conv_id, seq, kind, message, role, text) into final messages:

* ``message`` begins a message with its text, ``delta`` appends to it;
* ``edit`` replaces the text so far, ``regenerate`` empties it (deltas follow) and
  withdraws every later message that had begun before it.

``render`` turns each final message into template text with its loss span, ``read_back``
parses such text again, ``digests`` gathers one row a conversation.

Events are grouped by message, never by conversation; only the digests, whose hash runs
over the whole conversation, hold a conversation's text in one row.

Defined results: a null text or role is empty; an unknown kind counts as ``message``; a
null ``seq`` comes first; events of one message with equal ``seq`` are folded in the order
of kind (message, edit and regenerate before deltas) and text; a null conv_id is a
conversation of its own. An empty log gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
TRAINED = "assistant"


def escape(text: Column) -> Column:
    """One backslash more between ``<`` and ``|``: no control string is left, none is lost."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """As ``escape``, and on one line, since the line end closes the role."""
    line = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape(line)


def unescape_role(role: Column) -> Column:
    line = F.replace(unescape(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(line, F.lit("%25"), F.lit("%"))


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, message, role, text) of an event log."""
    c = F.col
    log = events.select(
        "conv_id", "message", "role",
        F.coalesce(c("seq"), F.lit(-(2**63))).alias("seq"),
        F.when(c("kind").isin("delta", "edit", "regenerate"), c("kind"))
        .otherwise("message").alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    redone = c("kind") == "regenerate"
    messages = log.groupBy("conv_id", "message").agg(
        F.min("seq").alias("begun"),
        F.max(F.when(c("kind") != "delta", c("seq"))).alias("reset"),
        F.max(F.when(redone, c("seq"))).alias("redone"),
        F.min(F.when(c("role").isNotNull(), F.struct("seq", "role"))).alias("named"),
        F.collect_list(
            F.struct(
                "seq", (c("kind") == "delta").alias("added"),
                F.when(redone, "").otherwise(c("text")).alias("text"),
            )
        ).alias("pieces"),
    )
    earlier = W.partitionBy("conv_id").orderBy("message").rowsBetween(W.unboundedPreceding, -1)
    withdrawn = F.coalesce(F.max("redone").over(earlier) > c("begun"), F.lit(False))
    live = F.filter(
        F.array_sort("pieces"), lambda p: c("reset").isNull() | (p["seq"] >= c("reset"))
    )
    return (
        messages.withColumn("withdrawn", withdrawn)
        .where(~c("withdrawn"))
        .select(
            "conv_id", "message",
            F.coalesce(c("named.role"), F.lit("")).alias("role"),
            F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """Each message as template text, with the loss span in code points (null: no loss)."""
    c = F.col
    head = F.concat(F.lit(START), escape_role(c("role")), F.lit("\n"))
    body = escape(c("text"))
    trained = c("role") == TRAINED
    return messages.select(
        "conv_id", "message", head.alias("head"), body.alias("body"), trained.alias("trained")
    ).select(
        "conv_id", "message",
        F.concat("head", "body", F.lit(END + "\n")).alias("formatted"),
        F.when(c("trained"), F.length("head")).alias("loss_start"),
        F.when(c("trained"), F.length("body")).alias("loss_length"),
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """Turns found in the template text, and the text under the loss span."""
    c = F.col
    parts = F.filter(F.split(c("formatted"), r"<\|im_start\|>", -1), lambda p: p != "")
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(
                F.substring_index(F.regexp_replace(p, r"^[^\n]*\n", ""), END, 1)
            ).alias("text"),
        ),
    )
    under = F.substr(c("formatted"), c("loss_start") + 1, c("loss_length"))
    return rendered.select(
        "conv_id", "message", turns.alias("turns"),
        unescape(under).alias("loss_text"),
        F.length("formatted").alias("chars"),
    )


def digests(read: DataFrame) -> DataFrame:
    """One row a conversation: turns, hashes of them and of the loss text, sizes."""
    c = F.col
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("n_turns"),
        F.array_sort(
            F.collect_list(
                F.struct(
                    "message",
                    F.array_join(
                        F.transform(
                            "turns",
                            lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")),
                        ),
                        "",
                    ).alias("turns"),
                    F.coalesce("loss_text", F.lit("")).alias("loss"),
                )
            )
        ).alias("parts"),
        F.sum(F.coalesce(F.length("loss_text"), F.lit(0))).alias("loss_chars"),
        F.sum("chars").alias("formatted_chars"),
    )
    hashed = lambda name: F.sha2(
        F.array_join(F.transform("parts", lambda p: p[name]), ""), 256
    )
    return whole.select(
        "conv_id", "n_turns", hashed("turns").alias("turns_sha256"),
        "loss_chars", hashed("loss").alias("loss_sha256"), "formatted_chars",
    )


def log_of_turns(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as an event log; each row is a message of its own.

    Rows that share a turn follow each other by role and text.
    """
    same = W.partitionBy("conv_id", "turn").orderBy("role", "text")
    return turns.select(
        "conv_id",
        F.col("turn").cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        F.struct(
            F.col("turn").cast("long").alias("turn"), F.row_number().over(same).alias("nth")
        ).alias("message"),
        F.col("role"),
        "text",
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Template text of every final message of an event log."""
    return render(reconstruct(events))
