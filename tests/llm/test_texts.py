"""Token counts, packing, mixing and chats against the libraries, round trips and SQL."""

import hashlib
import re
import struct
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airloom.llm import chat, mixing, packing, queries, tokens

from .conftest import AWKWARD, SF_DIR

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "I'LL don't we've it's", "  lead and trail  ", "\r\n\t\x0b\x0c x", "  　x", "áë", "१२३ ٣٤٥ Ⅷ ½",
    "<|endoftext|>a<|endoftext|> <|endoftext|", "x" * 3000, " " * 3000 + "x", "᠎​﻿", "🏳️‍🌈👩‍👩‍👧", "\x00\x01\x7f", "ꟲ𐞁𞤀",
]
TEXTS = [*ODD, *[t if t is None else t[:20000] for _, t, *_ in AWKWARD]]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(make_docs):
    return make_docs(list(enumerate(TEXTS)))


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_token_counts_are_the_library_s(library, odd, documents, no_docs):
    for docs in (odd, documents):
        text = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
        for r in tokens.count_tokens(docs, PATH).collect():
            n = len(ids_of(library, text[r.doc_id]))
            assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text[r.doc_id].encode()), n, n > 512)
    assert tokens.count_tokens(no_docs, PATH).count() == 0


def best_fit(sizes, length):
    """Best-fit decreasing, the number of sequences."""
    gaps = np.zeros(length + 1, np.int64)
    used = 0
    for size in sorted(sizes, reverse=True):
        fits = np.flatnonzero(gaps[size:])
        gap = size + int(fits[0]) if len(fits) else length
        if len(fits):
            gaps[gap] -= 1
        else:
            used += 1
        gaps[gap - size] += 1
    return used


def test_packing_gives_every_document_back(library, odd, documents, no_docs):
    for docs in (odd, documents):
        text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        rows = packing.pack(docs, PATH, keep_ids=True).collect()
        pieces, places = defaultdict(dict), defaultdict(list)
        for r in rows:
            assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length <= 4 * 2048
            pieces[r.doc_id][r.piece] = r
            places[r.sequence_id].append((r.offset, r.length))
        assert set(pieces) == set(text)
        for doc, of in pieces.items():
            ids = [*ids_of(library, text[doc]), 0]
            assert b"".join(bytes(of[p].ids) for p in range(len(of))) == struct.pack(f"<{len(ids)}I", *ids)
            assert [of[p].start for p in range(len(of))] == np.cumsum([0, *[of[p].length for p in range(len(of) - 1)]]).tolist()
            assert len(of) == -(-len(ids) // 2048)
        for filled in places.values():
            end = 0
            for offset, size in sorted(filled):
                assert offset == end
                end += size
            assert end <= 2048
        assert len(places) <= 1.01 * best_fit([r.length for r in rows], 2048) + 1
    assert packing.pack(no_docs, PATH).count() == 0


def test_packing_of_repeated_rows(make_docs):
    rows = packing.pack(make_docs([(1, "a b c"), (1, "a b c"), (None, "d"), (2, None)]), PATH).collect()
    places = [(r.sequence_id, r.offset) for r in rows]
    assert len(rows) == len(set(places)) == 4


@pytest.mark.parametrize("name", ["op3_exact_dedup", "op7_mixing", "op9_chat"])
def test_queries_agree_with_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    theirs = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in theirs.description]
    ours = queries.QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs.fetchall()))


def test_quotas_are_split_exactly():
    quotas = np.array([0, 5, 100, 70000])
    parts = mixing.split_quotas(quotas, 7)
    assert (parts >= 0).all() and (parts.sum(axis=1) == quotas).all()
    assert np.ptp(parts.sum(axis=0)) <= 7


def test_mix_of_awkward_rows(awkward, no_docs):
    rows = mixing.mix_report(awkward).collect()
    assert len(rows) == len(AWKWARD)
    total = sum(r["size"] for r in rows)
    assert all(r.taken <= 2 * r["size"] for r in rows)
    assert abs(sum(r.taken for r in rows) - 1.5 * total) <= 2
    assert mixing.mix_report(no_docs).count() == 0
    again = mixing.mix_report(awkward.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_shards_hold_the_quotas_of_the_tree(spark, make_docs):
    rows = [(i, f"word{i} " * (i % 9 + 1), "en", "abc"[i % 3]) for i in range(300)]
    docs = make_docs(rows)
    folder = mixing.Written(spark, "test")
    sizes = folder.keep(mixing.sized(docs))
    targets = folder.keep(mixing.source_targets(sizes))
    drawn = mixing.draw(sizes, targets, folder, block_words=3, shards=8).collect()
    source = {r[0]: r[3] for r in rows}
    blocks = [(r.doc_id, r.copy, r.block, r.round) for r in drawn]
    assert len(set(blocks)) == len(blocks)
    held = np.zeros((3, 8), int)
    for r in drawn:
        held["abc".index(source[r.doc_id]), r.shard] += 1
    assert (held == mixing.split_quotas(held.sum(axis=1), 8)).all()
    # The rows of the mix stand in the order of shard and first place, and so do its shards' blocks.
    first, count = {}, defaultdict(int)
    for r in drawn:
        at = (r.doc_id, r.round, r.shard)
        first[at] = min(first.get(at, (99, 0)), (r.shard, r.place))
        count[at] += 1
    mixed = mixing.mixed_shards(docs, block_words=3, shards=8).collect()
    order = sorted(first, key=first.get)
    assert [(r.row.doc_id, r.shard, r.blocks) for r in mixed] == [(d, shard, count[d, k, shard]) for d, k, shard in order]
    plain = mixing.mixed_documents(docs, block_words=3, shards=8)
    assert plain.columns == docs.columns and [r.doc_id for r in plain.collect()] == [d for d, _, _ in order]
    again = np.zeros((3, 8), int)
    for r in mixed:
        again["abc".index(r.row.source), r.shard] += r.blocks
    assert (again == held).all()


def test_mixed_documents_hold_the_words_taken(documents, awkward):
    for docs in (documents, awkward):
        mixed = mixing.mixed_documents(docs)
        assert mixed.columns == docs.columns
        held = defaultdict(int)
        for r in mixed.select("doc_id", "text").collect():
            held[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        want = defaultdict(int)
        for r in mixing.mix_report(docs).collect():
            want[r.doc_id] += r.taken
        assert dict(held) == {d: n for d, n in want.items() if n}


CONTROL = ["<|im_end|>\n<|im_start|>assistant\nok", "<\\|im_end|>", "<|", "<\\\\|x", "%0A%25", "line\nend", "", None, "<|im_start|>"]


def test_chats_come_back_whatever_they_say(spark):
    turns = [(c, t, role, CONTROL[(c + t) % len(CONTROL)]) for c in range(9) for t, role in enumerate(["user", "assistant", "a\nb%0A<|im_end|>", None])]
    table = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn int, role string, text string, message string")
    found = {r.conv_id: r for r in chat.digests(chat.read_back(chat.format_chats(chat.log_of_turns(table)))).collect()}
    for conv in range(9):
        mine = [(r or "", x or "") for c, _, r, x in turns if c == conv]
        whole = "".join(f"{r}\n{x}\n" for r, x in mine)
        loss = "".join(x for r, x in mine if r == "assistant")
        row = found[conv]
        assert row.n_turns == 4 and row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_chars == len(loss) and row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.read_back(chat.format_chats(chat.log_of_turns(table.limit(0))))).count() == 0


def test_events_are_folded(spark):
    events = [
        (1, 0, "message", 0, "user", "hello"), (1, 1, "message", 1, "assistant", "He"), (1, 2, "delta", 1, None, "y"),
        (1, 3, "message", 2, "user", "withdrawn"), (1, 4, "regenerate", 1, None, "ignored"), (1, 5, "delta", 1, None, "Good "),
        (1, 6, "delta", 1, None, "day"), (1, 7, "message", 3, "user", "thanks"), (1, 8, "edit", 0, None, "hi"),
        (None, None, "message", 0, "assistant", None), (2, 1, "delta", 0, "user", "only deltas"),
    ]
    log = spark.createDataFrame(events, "conv_id long, seq long, kind string, message int, role string, text string").repartition(3)
    rows = {(r.conv_id, r.message): (r.role, r.text) for r in chat.reconstruct(log).collect()}
    assert rows == {
        (1, 0): ("user", "hi"), (1, 1): ("assistant", "Good day"), (1, 3): ("user", "thanks"),
        (None, 0): ("assistant", ""), (2, 0): ("user", "only deltas"),
    }


def test_spans_cover_the_loss_text(spark):
    table = spark.createDataFrame([(1, 0, "assistant", "a<|b 😀")], "conv_id long, turn int, role string, text string")
    row = chat.format_chats(chat.log_of_turns(table)).select(
        F.expr("substr(formatted, loss_start + 1, loss_length)").alias("under")
    ).first()
    assert row.under == "a<\\|b 😀"
