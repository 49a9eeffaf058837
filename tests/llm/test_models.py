"""Toxicity and languages by held-out accuracy; neighbours by recall against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from airloom.llm import languages, neighbours, queries, toxicity
from airloom.llm.common import bucket_of

from .conftest import AWKWARD

SF = "/root/testdata/sf0.01"
MORE = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def scored(spark):
    return queries.op1_toxicity(spark, SF).toPandas()


def test_toxicity_of_held_out_documents(spark):
    # The smaller tables hold some forty toxic texts to learn from, too few to judge by.
    scored = queries.op1_toxicity(spark, MORE).toPandas()
    truth = spark.read.parquet(f"{MORE}/labels.parquet").where("toxic is not null").toPandas()
    rows = scored[scored.held_out].merge(truth, on="doc_id")
    bad, good = rows.score[rows.toxic == 1].to_numpy(), rows.score[rows.toxic == 0].to_numpy()
    area = ((bad[:, None] > good[None]).mean() + (bad[:, None] == good[None]).mean() / 2)
    assert len(bad) and area > 0.95
    assert ((rows.predicted == 1) == (rows.toxic == 1)).mean() > 0.95
    assert (bad >= 0.3).mean() > 0.85 and (good >= 0.3).mean() < 0.05
    assert scored.score.between(0, 1).all() and len(scored) == 10000
    assert ((scored.score >= 0.3) == (scored.predicted == 1)).all()


def test_toxicity_learns_nothing_from_held_out_rows(spark, scored):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = F.when(bucket_of("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    again = toxicity.score_toxicity(docs, labels.withColumn("toxic", flipped)).toPandas()
    both = again.merge(scored, on="doc_id")
    assert np.allclose(both.score_x, both.score_y)


def test_toxicity_of_awkward_rows(spark, awkward, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (8, 1), (9, 1), (9, None), (10, 1), (None, 1), (11, 0)], "doc_id long, toxic int"
    )
    found = toxicity.score_toxicity(awkward, labels).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id in (4, 5, 12)}
    assert len(empty) == 1
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    assert toxicity.score_toxicity(awkward, labels.limit(0)).where("predicted = 1").count() == 0


def plain_grams(text):
    """The buckets of a text's n-grams, byte by byte."""
    data = text.encode()
    word = [b >= 0x80 or chr(b).isalnum() for b in data]
    plain = [0x20, *(b | 0x20 if 65 <= b <= 90 else b if w else 0x20 for b, w in zip(data, word, strict=True)), *[0x20] * 6]
    word = [False, *word, *[False] * 6]
    for n in toxicity.GRAMS:
        for i in range(len(data)):
            if all(word[i + 1 : i + n - 1]):
                h = 0
                for b in plain[i : i + n]:
                    h = (h * 0x01000193 + b) % 2**32
                yield ((h ^ (h >> 15)) * 0x85EBCA6B) % 2**32 >> (32 - toxicity.BUCKET_BITS)


def test_toxicity_is_the_mean_of_bucket_odds(spark, awkward, documents):
    rng = np.random.default_rng(6)
    model = toxicity.Model(rng.normal(0, 3, 1 << toxicity.BUCKET_BITS).astype(np.float32), -0.7)
    for docs in (awkward.where("length(text) < 20000 or text is null"), documents.where("length(text) < 3000")):
        found = toxicity.score(docs, model).collect()
        texts = [r.text or "" for r in docs.collect()]
        assert len(found) == len(texts)
        for r, text in zip(found, texts, strict=True):
            odds = [float(model.odds[b]) for b in plain_grams(text)]
            logit = model.bias + (sum(odds) / len(odds) if odds else 0.0)
            assert abs(r.score - 1 / (1 + math.exp(-logit))) < 1e-5 and r.predicted == (r.score >= 0.3)


def plain_units(text, logs):
    """Log-likelihoods of units of four words, trigram by trigram."""
    data = text.encode()
    letter = [b >= 0x80 or chr(b).isalpha() for b in data]
    plain = [0x20, *((b if b >= 0x80 else b | 0x20) if w else 0x20 for b, w in zip(data, letter, strict=True)), 0x20]
    words, units = -1, []
    for i, w in enumerate(letter):
        if not w:
            continue
        if i == 0 or not letter[i - 1]:
            words += 1
            if words % 4 == 0:
                units.append(np.zeros(len(logs)))
        gram = plain[i] << 16 | plain[i + 1] << 8 | plain[i + 2]
        units[-1] += logs[:, (gram * 0x9E3779B1) % 2**32 >> 16]
    return np.array(units)


def mixture_of(units, chosen):
    """Shares of the chosen languages after many rounds, and their penalised likelihood."""
    top = units.max(axis=1, keepdims=True)
    likely, shares = np.exp(units - top)[:, chosen] + 1e-30, np.full(len(chosen), 1 / len(chosen))
    for _ in range(3000):
        weight = likely * shares
        shares = (weight / weight.sum(axis=1, keepdims=True)).mean(axis=0)
    return shares, top.sum() + np.log(likely @ shares).sum() - 0.5 * (len(chosen) - 1) * math.log(len(units))


def test_languages_are_the_best_of_all_mixtures(spark, documents, make_docs):
    """The set found by dropping languages is the best of all sets, and its shares are EM's."""
    model = languages.train(documents)
    parts = {r.lang: r.text for r in documents.where("lang is not null and length(text) > 400").collect()}
    mixed = [(i, a[:400] + " " + b[:300]) for i, (a, b) in enumerate(itertools.permutations(parts.values(), 2))]
    rows = [(r.doc_id + 100, r.text) for r in documents.where("length(text) between 1 and 1500").limit(60).collect()] + mixed
    found = {r.doc_id: r for r in languages.predict(make_docs(rows), model).collect()}
    names, same = model.languages, 0
    for doc, text in rows:
        units = plain_units(text, model.logs.astype(float))
        if not len(units):
            assert found[doc].lang_pred == "und"
            continue
        sets = [list(s) for n in range(1, len(names) + 1) for s in itertools.combinations(range(len(names)), n)]
        best = max(((mixture_of(units, s), s) for s in sets), key=lambda x: x[0][1])
        (shares, _), chosen = best
        assert abs(found[doc].score - shares.max()) < 0.1
        same += found[doc].lang_pred == names[chosen[shares.argmax()]] and abs(found[doc].score - shares.max()) < 0.02
    assert same >= 0.95 * len(rows)


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = languages.identify(docs).toPandas()
    rows = found[found.held_out].merge(docs.select("doc_id", "lang").where("lang is not null").toPandas(), on="doc_id")
    said = rows[rows.lang_pred != "und"]
    assert (said.lang_pred == said.lang).mean() > 0.97 and len(said) > 200
    relabelled = F.when(bucket_of("doc_id", 3) == 1, F.lit("zz")).otherwise(F.col("lang"))
    again = languages.identify(docs.withColumn("lang", relabelled)).toPandas().merge(found, on="doc_id")
    assert (again.lang_pred_x == again.lang_pred_y).all() and np.allclose(again.score_x, again.score_y)


def test_languages_of_mixed_texts(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null and length(text) > 400")
    model = languages.train(spark.read.parquet(f"{SF}/documents.parquet"))
    texts = {r.lang: r.text[:300] for r in docs.select("lang", "text").dropDuplicates(["lang"]).collect()}
    (a, x), (b, y), *_ = sorted(texts.items())
    found = {r.doc_id: r for r in languages.predict(make_docs([(1, x * 3 + " " + y), (2, x + " " + y * 3)]), model).collect()}
    assert found[1].lang_pred == a and found[2].lang_pred == b
    assert 0.5 < found[1].score < 0.95 and 0.5 < found[2].score < 0.95


def test_mixed_texts_are_kept_without_a_language_for_half(spark, make_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = languages.train(docs)
    texts = docs.where("lang is not null and length(text) > 400").dropDuplicates(["lang"])
    cut = [r.text[:300] for r in texts.orderBy("lang").select("text").collect()][:4]
    mixed = make_docs([(1, " ".join(cut)), (2, "12 34 !!")])
    found = {r.doc_id: r for r in languages.predict(mixed, model).collect()}
    assert 0 < found[1].score < 0.5 and found[2].lang_pred == "und"
    assert [r.doc_id for r in languages.keep_identified(mixed, model).collect()] == [1]
    said = languages.predict(docs, model).where("lang_pred != 'und'").count()
    assert languages.keep_identified(docs, model).count() == said


def test_languages_of_awkward_rows(awkward, no_docs):
    found = languages.identify(awkward).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 for r in found)
    assert all(r.lang_pred == "und" for r in found if r.doc_id in (4, 5, 6, 12, 13))
    assert languages.identify(no_docs).count() == 0
    model = languages.train(awkward)
    kept = languages.keep_identified(awkward, model)
    assert kept.columns == awkward.columns
    assert not {4, 5, 6, 12, 13} & {r.doc_id for r in kept.collect()}


def nearest_by_hand(rows, asked, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    out = {}
    for q in asked:
        score = x @ x[ids == q][0]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_neighbours_recall_and_scores(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet")
    vector = next(f.name for f in table.schema if f.dataType.typeName() == "array")
    rows = [(r.vec_id, r[vector]) for r in table.collect() if r[vector] is not None]
    rows = [(i, v) for i, v in rows if all(e is not None and np.isfinite(e) for e in v) and any(v)]
    found = queries.op8_neighbours(spark, SF).toPandas()
    truth = nearest_by_hand(rows, [i for i, _ in rows if i % 50 == 0], 5)
    assert set(found.query_id) == set(truth)
    hits, exact = 0, {q: dict(near) for q, near in nearest_by_hand(rows, truth, len(rows)).items()}
    for q, part in found.groupby("query_id"):
        part = part.sort_values("rank")
        assert part["rank"].tolist() == [1, 2, 3, 4, 5] and q not in set(part.vec_id)
        assert np.allclose(part.score, [exact[q][v] for v in part.vec_id], atol=1e-12)
        assert (part.score.diff().dropna() <= 0).all()
        hits += len(set(part.vec_id) & {v for v, _ in truth[q]})
    assert hits >= 0.9 * 5 * len(truth)


def test_neighbours_of_awkward_rows(spark):
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [2.0, 2.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.1]), (50, [-1.0, 0.0]), (8, [1.0, 2.0, 3.0]),
    ]
    table = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<float>, score double, partition int")
    found = neighbours.search(table, F.col("vec_id") % 50 == 0)
    got = [(r.query_id, r["rank"], r.vec_id) for r in found.orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0)]
    assert neighbours.search(table.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("block,queries_", [(16, 3)])
def test_neighbours_in_small_cells(spark, block, queries_):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)] + [(1000 + i, [1.0] * 6) for i in range(80)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.search(table, F.col("vec_id") % 20 == 0, block=block, queries=queries_).toPandas()
    truth = nearest_by_hand(rows, [i for i, _ in rows if i % 20 == 0], 5)
    hits = sum(len(set(p.vec_id) & {v for v, _ in truth[q]}) for q, p in found.groupby("query_id"))
    assert hits >= 0.9 * 5 * len(truth)
    of = found[found.query_id == 1020].sort_values("rank").vec_id.tolist()
    assert of == [1000, 1001, 1002, 1003, 1004]


def test_partitions_grow_with_the_table():
    assert [neighbours.partitions_of(n) for n in (0, 5000, 150_000, 10**6, 10**9)] == [32, 32, 64, 128, 1024]


def test_clustered_vectors_are_found_with_few_probes(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (200, 16))[rng.integers(0, 200, 20_000)] + rng.normal(0, 0.3, (20_000, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    router = neighbours.learned(neighbours.usable(df))
    assert router.probes <= 8 and router.offset.shape == (32,)
    asked = np.arange(0, 20_000, 200)
    found = neighbours.search(df, F.col("vec_id") % 200 == 0).toPandas()
    unit = neighbours.unit(x)
    near = unit[asked] @ unit.T
    near[np.arange(len(asked)), asked] = -9
    best = np.argsort(-near, axis=1)[:, :5]
    hits = sum(len(set(best[i]) & set(found[found.query_id == q].vec_id)) for i, q in enumerate(asked))
    assert hits >= 0.9 * 5 * len(asked)
