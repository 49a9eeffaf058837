"""Exact, near and byte-level de-duplication against brute force."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.llm import exact, neardup, suffixes
from airloom.llm.common import Written

from .conftest import AWKWARD

SPACE = re.compile(r"[\x20\x09-\x0D]")


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[SPACE.sub("", text or "")].append((doc, len(text or "")))
    out = []
    for norm, members in groups.items():
        named = [m for m in members if m[0] is not None]
        keep = min(named, key=lambda m: (-m[1], m[0]))[0] if named else None
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(d, keep, len(members), d is not None and d == keep, digest) for d, _ in members]
    return sorted(out, key=str)


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("identify", [F.xxhash64, lambda c: F.length(c).cast("long"), lambda c: F.lit(0).cast("long")])
def test_exact_groups_also_when_identifiers_clash(awkward, identify):
    assert as_rows(exact.exact_groups(awkward, identify)) == exact_by_hand([r[:2] for r in AWKWARD])


def test_exact_groups_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert as_rows(exact.exact_groups(documents)) == exact_by_hand(rows)


def test_exact_keeps_columns_and_one_row_a_group(awkward, no_docs):
    kept = exact.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    expected = {r[1] for r in exact_by_hand([r[:2] for r in AWKWARD])}  # None: a group without any id
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(expected, key=str)
    assert exact.exact_groups(no_docs).count() == exact.keep_one_of_each(no_docs).count() == 0


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def near_by_hand(rows, percent):
    sets, parent = [(d, shingles(t)) for d, t in rows], {d: d for d, _ in rows}
    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            holders[x].append(i)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    common = defaultdict(int)
    for members in holders.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                common[j, i] += 1
    for (i, j), both in common.items():
        (a, s), (b, t) = sets[i], sets[j]
        if 100 * both >= percent * (len(s) + len(t) - both):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return sorted((d, len(s), root(d), root(d) == d) for d, s in sets)


def near_rows(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def chains(seed):
    """Texts that drift apart step by step, so that links form chains and stars."""
    rng, rows = random.Random(seed), []
    for _ in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([8, 60, 200]))]
        for _ in range(rng.randrange(2, 14)):
            rows.append((len(rows), " ".join(words)))
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, (_, t) in enumerate(rows)]


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_of_chains(make_docs, percent):
    rows = chains(percent)
    assert near_rows(neardup.near_duplicates(make_docs(rows), percent=percent)) == near_by_hand(rows, percent)


def test_near_duplicates_of_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert near_rows(neardup.near_duplicates(documents)) == near_by_hand(rows, 85)


def test_near_duplicates_of_awkward_rows(awkward, no_docs):
    found = neardup.near_duplicates(awkward).collect()
    of = {r.doc_id: r for r in found if r.doc_id is not None}
    assert len(found) == len(AWKWARD)
    assert of[1].component_id == of[2].component_id == of[3].component_id == 1
    assert of[8].component_id == 7 and of[15].component_id == 14
    assert all(of[d].n_shingles == 0 and of[d].component_id == d and of[d].kept for d in (4, 5, 6, 12))
    assert of[11].n_shingles == 1
    assert neardup.near_duplicates(no_docs).count() == 0
    kept = neardup.keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, r in of.items() if r.kept} | {None}


def test_near_duplicates_of_rows_with_one_id(make_docs):
    """A document with several texts is linked with all that any of them is linked with."""
    x, y = (" ".join(f"{c}{i}" for i in range(40)) for c in "xy")
    found = neardup.near_duplicates(make_docs([(3, x), (7, x), (7, y), (8, y + " more"), (9, None), (9, y)])).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(3, 3), (7, 3), (8, 3), (9, 3)}
    rows = [(None, x), (None, x + " more"), (None, y), (None, None), (5, "some other words that stand alone here")]
    kept = [r.text for r in neardup.keep_one_of_each(make_docs(rows)).collect()]
    assert len(kept) == 4 and len({x, x + " more"} & set(kept)) == 1 and {y, None} <= set(kept)


def test_words_are_not_told_by_a_hash_that_collides(make_docs):
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    found = neardup.near_duplicates(make_docs([(1, word), (2, other), (3, f"p q r s {word}"), (4, f"p q r s {other}")]))
    assert all(r.kept for r in found.collect())


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_of_a_large_loose_group(make_docs, percent):
    """Copies of one text at all distances: many share bands and are not linked."""
    rng, rows = random.Random(percent), []
    base = [f"w{i}" for i in range(120)]
    for d in range(300):
        words = list(base)
        for _ in range(rng.randrange(9)):
            at = rng.randrange(len(words) - 1)
            words[at : at + rng.randrange(1, 3)] = [f"w{rng.randrange(10**6)}"] if rng.random() < 0.5 else []
        rows.append((d, " ".join(words)))
    rows += [(1000 + d, " ".join(f"v{(d * 7 + i) % 400}" for i in range(90))) for d in range(60)]
    docs = make_docs(rows)
    assert near_rows(neardup.near_duplicates(docs, percent=percent)) == near_by_hand(rows, percent)
    spark = docs.sparkSession
    # All pairs across components that are linked are among the candidates, and few others.
    sets = {d: shingles(t) for d, t in rows}
    links = {(a, b) for a, b in itertools.combinations(sorted(sets), 2)
             if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])}
    nodes = spark.createDataFrame([(d, d) for d in sets], "node long, component long")
    texts = docs.select(F.col("doc_id").alias("node"), "text")
    found = neardup.across_components(nodes, texts, 5, percent, Written(spark, "test"))
    pairs = {(r.a, r.b) for r in found.collect()}
    assert links <= pairs and len(pairs) < 2 * len(links) + 300


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates_of_many_variants_that_are_hardly_linked(make_docs, monkeypatch, percent):
    """Two variants have about the threshold's share in common: few are linked, and few pairs are looked at."""
    rng, rows = random.Random(percent), []
    base = [f"w{i}" for i in range(120 if percent == 85 else 90)]
    for d in range(400):
        words = list(base)
        for _ in range(1 + (d % 10 == 0)):
            words[rng.randrange(5, len(words) - 5)] = f"x{rng.randrange(10**6)}"
        rows.append((d, " ".join(words[: rng.choice([-1, -2, -3])])))
    rows += [(1000 + d, t + " and one or two words more") for d, t in rows[:300:3]]
    looked_at = []

    def counted(pairs, *rest, plain=neardup.verified):
        looked_at.append(pairs.count())
        return plain(pairs, *rest)

    monkeypatch.setattr(neardup, "verified", counted)
    assert near_rows(neardup.near_duplicates(make_docs(rows), percent=percent)) == near_by_hand(rows, percent)
    assert sum(looked_at) < 30 * len(rows)  # of 125,000


def removed_by_hand(rows, length):
    first, out = {}, []
    ordered = sorted((d, (t or "").encode()) for d, t in rows)
    for d, data in ordered:
        for i in range(len(data) - length + 1):
            first.setdefault(data[i : i + length], (d, i))
    for d, data in ordered:
        gone = np.zeros(len(data) + 2, bool)
        for i in range(len(data) - length + 1):
            if first[data[i : i + length]] != (d, i):
                gone[1 + i : 1 + i + length] = True
        spans = int((gone[1:] > gone[:-1]).sum())
        kept = bytes(b for b, g in zip(data, gone[1:-1], strict=True) if not g)
        out.append((d, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def removed(df):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("seed", range(3))
def test_repeats_in_small_alphabets(make_docs, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abé ") for _ in range(rng.randrange(10, 60))) for _ in range(6)]
    rows = []
    for d in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(6))]
        rows.append((d, "".join(parts) if rng.random() < 0.95 else None))
    rows += [(100, "a" * 300), (101, "a" * 50), (102, "ab" * 200)]
    found = suffixes.remove_repeats(make_docs(rows), length=12, gram=4, block=512)
    assert removed(found) == removed_by_hand(rows, 12)


def test_repeats_in_documents(documents):
    few = documents.where("length(text) < 20000 or text is null")
    rows = [(r.doc_id, r.text) for r in few.select("doc_id", "text").collect()]
    assert removed(suffixes.remove_repeats(few)) == removed_by_hand(rows, 100)


def test_repeats_in_awkward_rows(make_docs, no_docs):
    rows = [(d, t) for d, t, *_ in AWKWARD[:13] if t is None or len(t) < 20000]
    found = suffixes.remove_repeats(make_docs([*rows, (None, "x" * 400)]))
    assert removed(found.where("doc_id is not null")) == removed_by_hand(rows, 100)
    assert found.where("doc_id is null").first().n_removed == 0
    assert suffixes.remove_repeats(no_docs).count() == 0


def test_repeats_leave_rows_of_one_id_alike(make_docs):
    text = "".join(random.Random(9).choices("abcdefghij", k=400))
    found = suffixes.remove_repeats(make_docs([(1, text), (2, text), (2, text)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (2, 400), (2, 400)]


def test_repeats_are_cut_from_their_own_text(make_docs):
    """Different texts of one id: what repeats in one is not cut out of the other."""
    rng = random.Random(12)
    a, b = ("".join(rng.choices("abcdefghij", k=400)) for _ in range(2))
    found = suffixes.remove_repeats(make_docs([(1, a), (2, a), (2, b), (3, "x" + b[:150])])).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed) for r in found) == [(1, 400, 0), (2, 400, 0), (2, 400, 400), (3, 151, 150)]
    kept = {r.kept_sha256 for r in found if r.doc_id == 2}
    assert kept == {hashlib.sha256(x).hexdigest() for x in (b"", b.encode())}


def test_repeats_in_a_long_text(make_docs):
    rng = random.Random(13)
    passage = "".join(rng.choices("abcdefgh ", k=30_000))
    long = passage + "".join(rng.choices("abcdefgh ", k=40_000)) + passage[:20_000] + "é" * 500
    rows = [(1, long), (2, "y" + passage[5_000:29_000]), (3, "é" * 300)]
    assert removed(suffixes.remove_repeats(make_docs(rows))) == removed_by_hand(rows, 100)


def test_contexts_of_a_hot_anchor_do_not_meet(make_docs):
    """One passage in every document, with different text around it: block 512 holds 25 contexts."""
    rng = random.Random(4)
    around = lambda: "".join(rng.choices("abcdefgh", k=20))
    rows = [(d, around() + "the very same words" + around()) for d in range(300)]
    docs = make_docs(rows).repartition(3)
    assert removed(suffixes.remove_repeats(docs, length=12, gram=4, block=512)) == removed_by_hand(rows, 12)
    again = suffixes.repeated(suffixes.anchor_rows(suffixes.summaries(docs, 12, 4)))
    keys = suffixes.repeated_anchors(again, 25)
    texts = docs.select(F.col("doc_id").alias("doc"), "text", F.lit(0).alias("version"))
    found = suffixes.contexts(texts.join(F.broadcast(keys), "doc"), 12, 4).where("context is not null")
    assert found.groupBy("key").count().agg(F.max("count")).first()[0] <= 25
