"""Source divergence and lexical search against brute force and their SQL."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from airloom.llm import divergence, lexical, queries

from .conftest import CLASHING, SF_DIR

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def words(pattern, text):
    return pattern.findall((text or "").translate(LOWER))


@pytest.mark.parametrize("name", ["op12_divergence", "op13_lexical"])
def test_queries_agree_with_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    theirs = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in theirs.description]
    ours = queries.QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(str, map(tuple, ours.collect()))) == sorted(map(str, theirs.fetchall()))


def audit_by_hand(rows):
    counts, docs, groups = Counter(), Counter(), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = words(TERM, text)
        counts.update((lang, source, w) for w in found)
        docs.update({(lang, w) for w in found})
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for (of, w), n in docs.items() if of == lang and n >= 3)
        sources = sorted(s for of, s in groups if of == lang)

        def p(of, kept=kept, lang=lang):
            n = {w: sum(counts[lang, s, w] for s in of) for w in kept}
            total = sum(n.values())
            return {w: 1 + 10**9 * (n[w] + 1) // (total + len(kept)) for w in kept}

        whole, by = p(sources), {s: p([s]) for s in sources}
        for s in sources:
            pairs = [(t, sum((by[s][w] - by[t][w]) ** 2 // by[t][w] for w in kept)) for t in sources if t != s]
            terms = [(w, (by[s][w] - whole[w]) ** 2 // whole[w]) for w in kept if counts[lang, s, w] and by[s][w] > whole[w]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda r: (-r[1], r[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items) if part == "pair" or i < 200]
    return sorted(out)


def made_up(seed, n=400):
    rng = np.random.default_rng(seed)
    return [
        (" ".join(f"W{chr(97 + k % 26)}é{'x' * (k // 26)}" for k in rng.zipf(1.3, rng.integers(0, 60)) % 300),
         ("aa", "bb", None)[int(rng.integers(0, 3))], (None, "", *"stuvw")[int(rng.integers(0, 7) * rng.random())])
        for _ in range(n)
    ]


def as_docs(spark, rows):
    columns = "doc_id long, text string, lang string, source string" + "".join(f", `{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, *r, *CLASHING) for i, r in enumerate(rows)], columns)


@pytest.mark.parametrize("block, tile, product", [(1024, 128, 2048), (16, 2, 7)])
def test_divergence_by_brute_force(spark, monkeypatch, block, tile, product):
    for name, value in (("BLOCK_TERMS", block), ("TILE_SOURCES", tile)):
        monkeypatch.setattr(divergence, name, value)
    rows = [*made_up(1), ("z" * 70_000, "aa", "s"), (None, "cc", "only"), ("", "dd", "one"), ("1 2 3", "dd", "two"), ("!", "dd", "")]
    found = divergence.audit(as_docs(spark, rows)).collect()
    assert sorted(map(tuple, found)) == audit_by_hand(rows)
    # The product in tiles of columns gives what the price of each term by itself gives.
    table = np.random.default_rng(2).integers(0, 4, (5, 50))
    monkeypatch.setattr(divergence, "TILE", product)
    columns, p, each = [], [], []
    for counts in table:
        unique, which = np.unique(counts, return_inverse=True)
        columns.append(sum(map(len, p)) + which)
        p.append(divergence.shares(unique, int(counts.sum()), 50))
        each.append(p[-1][which])
    group = np.repeat(np.arange(5), [len(x) for x in p])
    one_hot = np.zeros((50, len(group)), np.float32)
    for at in columns:
        one_hot[np.arange(50), at] = 1
    got = divergence.joint_prices(5, group, np.concatenate(p), one_hot)
    assert got.tolist() == [[int(divergence.price(a, b).sum()) for b in each] for a in each]


def test_divergence_of_awkward_rows(spark, awkward, no_docs):
    found = divergence.audit(awkward).collect()
    assert sorted(map(tuple, found)) == audit_by_hand([(r.text, r.lang, r.source) for r in awkward.collect()])
    assert divergence.audit(no_docs).count() == 0
    assert divergence.shares(np.array([10**15]), 10**15, 5)[0] == 1 + 10**9 * (10**15 + 1) // (10**15 + 5)


def search_by_hand(docs, items, top=20):
    read = [(doc, words(WORD, text)) for doc, text in docs]
    read = [(doc, Counter(w), len(w)) for doc, w in read if w]
    n_docs, length = len(read), sum(n for _, _, n in read)
    df = Counter(w for _, held, _ in read for w in held)
    out = []
    for item, text in items:
        scored = []
        for doc, held, n in read:
            m = 75 + 25 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * held[w] // (1000 * held[w] + 12 * m))
                for w in words(WORD, text) if w in held
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


ITEMS = [(1, "the quick brown fox the"), (2, None), (3, ""), (4, "no such terms zzz"), (5, "word"), (None, "alpha BETA 12 ümläut"), (1, "fox"), (1, "fox")]


@pytest.mark.parametrize("shard, wave, round_bytes", [(8192, 4096, 4 << 20), (3, 4, 10)])
def test_search_by_brute_force(spark, monkeypatch, awkward, shard, wave, round_bytes):
    monkeypatch.setattr(lexical, "ROUND_BYTES", round_bytes)
    columns = "item_id long, text string" + "".join(f", `{c}` string" for c in CLASHING)
    items = spark.createDataFrame([(*r, *CLASHING) for r in ITEMS], columns)
    more = [(i + 100, t) for i, (t, _, _) in enumerate(made_up(3))] + [(7, "the fox " * 50)] * 30
    for docs in (awkward, as_docs(spark, [(t, None, None) for _, t in more])):
        found = lexical.search(docs, items).collect()
        want = search_by_hand([(r.doc_id, r.text) for r in docs.collect()], ITEMS)
        assert sorted(map(tuple, found), key=str) == want
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_best_first_search_of_a_shard(seed):
    rng = np.random.default_rng(seed)
    docs, terms = int(rng.integers(1, 200)), int(rng.integers(1, 12))
    impact = rng.integers(0, 6, (docs, terms)) * (rng.random((docs, terms)) < 0.4)
    doc, term = np.nonzero(impact)
    shard = lexical.Postings(term, doc, impact[doc, term], docs)
    rank = rng.permutation(docs)
    for _ in range(20):
        item = {int(t): int(rng.integers(1, 4)) for t in rng.integers(0, terms + 1, 5)}
        found = lexical.search_shard(shard, item, rank, 7, 1)
        score = sum(k * impact[:, t] for t, k in item.items() if t < terms) + np.zeros(docs, int)
        best = sorted((-int(s), int(r), d) for d, (s, r) in enumerate(zip(score, rank, strict=True)) if s > 0)[:7]
        assert list(zip(found.score.tolist(), found.doc.tolist(), strict=True)) == [(-s, d) for s, _, d in best]

