from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.operators import similarity as sim


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    data = rng.normal(size=(300, 8))
    data[7] = 0.0
    data[11] = data[10]
    rows = [(i, [float(x) for x in v], i % 4) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    return data, df


def brute(queries, data, k):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    s = np.round(unit(queries) @ unit(data).T, 9)
    return {
        (q, int(i), r + 1) for q in range(len(queries)) for r, i in enumerate(np.lexsort((np.arange(len(data)), -s[q]))[:k])
    }


@pytest.mark.parametrize("block_values, corpus_values", [(8_000_000, 8_000_000), (40, 700)])
def test_topk_is_exact(spark, vectors, block_values, corpus_values):
    data, df = vectors
    q = np.vstack([data[10], data[3], np.zeros(8), data[:9]])
    queries = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(q)], "query_id long, embedding array<double>")
    out = sim.cosine_topk(queries, df, 6, block_values=block_values, corpus_values=corpus_values)
    assert {(r["query_id"], r["vec_id"], r["rank"]) for r in out.collect()} == brute(q, data, 6)


def test_no_queries(spark, vectors):
    none = spark.createDataFrame([], "query_id long, embedding array<double>")
    assert sim.cosine_topk(none, vectors[1]).isEmpty()


def test_centroids_and_vote(spark, vectors):
    data, df = vectors
    cen = {r["query_id"]: r["embedding"] for r in sim.centroids(df, "label").collect()}
    for label in range(4):
        assert cen[label] == pytest.approx(data[label::4].mean(axis=0))
    near = spark.createDataFrame([(1, 0, 0.9), (1, 1, 0.8), (1, 5, 0.2), (2, 4, 0.5), (2, 5, 0.5)], "query_id long, vec_id long, similarity double")
    plain = {r["query_id"]: (r["label"], r["votes"]) for r in sim.vote(near, df, "label").collect()}
    assert plain == {1: (1, 2), 2: (0, 1)}
    heavy = near.withColumn("similarity", F.when(F.col("vec_id") == 0, 5.0).otherwise(F.col("similarity")))
    assert {r["query_id"]: r["label"] for r in sim.vote(heavy, df, "label", weighted=True).collect()}[1] == 0


@pytest.mark.parametrize("block_values, corpus_values", [(8_000_000, 8_000_000), (10, 400)])
def test_hybrid_is_exact_against_all_pairs(spark, vectors, block_values, corpus_values):
    """Rows 250 to 299 have no vector, row 300 and up no text, query 2 no known word, query 3 no
    vector and query 4 no text."""
    data, df = vectors
    words = ["alpha", "beta", "gamma", "delta"]
    held = [[words[j] for j in range(4) if (i >> j) % 5 == 1] for i in range(300)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(held)], "vec_id long, text string")
    corpus = df.where("vec_id < 250").unionByName(df.where("vec_id < 5").withColumn("vec_id", F.col("vec_id") + 300))
    asked = spark.createDataFrame(
        [(0, "alpha beta"), (1, "gamma"), (2, "unknown"), (3, "delta alpha")], "query_id long, text string"
    )
    queries = df.where("vec_id in (0, 1, 2, 4)").select(F.col("vec_id").alias("query_id"), "embedding")
    out = sim.hybrid_topk(queries, asked, corpus, docs, 5, block_values=block_values, corpus_values=corpus_values)

    grams = [set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])} for w in held]
    count = lambda t: sum(t in g for g in grams)
    weight = lambda t: np.log(301 / (1 + count(t))) + 1
    wanted = {0: ["alpha", "beta", "alpha beta"], 1: ["gamma"], 2: ["unknown"], 3: ["delta", "alpha", "delta alpha"]}
    unit = np.divide(data, np.linalg.norm(data, axis=1, keepdims=True), out=np.zeros_like(data), where=np.linalg.norm(data, axis=1, keepdims=True) > 0)
    vector_of = {**{i: unit[i] for i in range(250)}, **{300 + i: unit[i] for i in range(5)}}
    for q in range(5):
        scores = []
        for i in range(305):
            shared = [t for t in wanted.get(q, []) if i < 300 and t in grams[i]]
            keyword = sum(map(weight, shared)) / sum(map(weight, wanted[q])) if shared else 0.0
            both = q != 3 and i in vector_of
            near = round(float(unit[q] @ vector_of[i]), 9) if both else 0.0
            if both or shared:
                scores.append((-round(0.3 * keyword + 0.7 * near, 9), i))
        got = out.where(F.col("query_id") == q).orderBy("rank").collect()
        assert [r["vec_id"] for r in got] == [i for _, i in sorted(scores)[:5]]
        assert [r["score"] for r in got] == pytest.approx([-x for x, _ in sorted(scores)[:5]], abs=2e-9)


def test_upsert(spark):
    base = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id long, version long, payload string")
    new = spark.createDataFrame([(2, 5, "new"), (2, 3, "old"), (3, 1, None)], "id long, version long, payload string")
    out = sim.upsert_latest(base, new, "id", "version")
    assert sorted(tuple(r) for r in out.collect()) == [(1, 0, "a"), (2, 5, "new"), (3, 1, None)]


def test_only_asked_terms_are_counted(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "red apple red"), (2, "green apple"), (2, "apple tart"), (3, None)], "vec_id long, text string")
    asked = spark.createDataFrame([(7, "apple pie"), (8, "red apple")], "query_id long, text string")
    terms = sim.query_terms(asked)
    out = lambda: sorted(tuple(r) for r in sim.weighted_terms(docs, terms).collect())
    few = out()
    plan = sim.weighted_terms(docs, terms)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    monkeypatch.setattr(sim, "ASKED_TERMS", 0)
    assert out() == few and len(few) == 6
