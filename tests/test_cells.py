"""Cell index and hybrid index against all pairs, and how many pairs they look at."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sievewright.operators import cells as ci, similarity as sim
from sievewright.operators.features import with_grams
from sievewright.session import shared_dir


def clustered(seed: int, n: int, dims: int, groups: int, spread: float) -> np.ndarray:
    rng = np.random.default_rng(seed)
    data = rng.normal(size=(groups, dims))[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))
    data[7] = 0.0
    data[20:60] = data[19]  # copies
    return data


def frame(spark, data, name="vec_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(data)], f"{name} long, embedding array<double>")


def stored(df):
    return df.select(F.col("vec_id").alias("row"), F.col("embedding").alias("v"), F.array().cast("array<long>").alias("terms"))


def triples(found):
    return sorted((r["query"], r["row"], r["rank"]) for r in found.rows.collect())


@pytest.mark.parametrize("spread", [0.02, 0.3, 2.0])
def test_topk_equals_all_pairs_and_skips(spark, monkeypatch, spread):
    monkeypatch.setattr(ci, "FIRST_LOOK", 40)
    monkeypatch.setattr(ci, "ROWS_PER_PART", 30)
    data = clustered(3, 2_500, 12, 20, spread)
    queries = np.vstack([data[[19, 7, 100, 2_000]], np.random.default_rng(5).normal(size=(6, 12))])
    index = ci.CellIndex.build(stored(frame(spark, data)), cells=25)
    found = index.topk(frame(spark, queries, "query_id"), 10)
    plain = sim.cosine_topk(frame(spark, queries, "query_id"), frame(spark, data), 10)
    assert triples(found) == sorted((r["query_id"], r["vec_id"], r["rank"]) for r in plain.collect())
    work = {r["query"]: r["looked"] / r["stored"] for r in found.work.collect()}
    assert set(work) == set(range(10)) and max(work.values()) <= 1.0
    if spread == 0.02:  # the zero vector (query 1) ties with every row
        assert max(v for q, v in work.items() if q in (2, 3)) < 0.25


def test_work_is_a_small_share_of_a_large_clustered_table(spark):
    data = clustered(8, 20_000, 16, 60, 0.03)
    index = ci.CellIndex.build(stored(frame(spark, data)))
    asked = frame(spark, data[::500], "query_id")
    found = index.topk(asked, 10)
    work = found.work.agg(F.sum("looked"), F.sum("stored")).head()
    print("looked at", work[0], "of", work[1])
    assert work[0] < 0.2 * work[1]
    assert found.rows.count() == 400


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 8), st.sampled_from([0.0, 1e-9, 0.01, 1.0]))
def test_bounds_hold(seed, dims, spread):
    rng = np.random.default_rng(seed)
    rows = ci.unit(rng.normal(size=dims) + spread * rng.normal(size=(40, dims)))
    centres = ci.centres_of(rows, 3)
    near = rows @ centres.T
    cell, angle = near.argmax(1), np.arccos(np.clip(near.max(1), -1, 1))
    keys = sorted(set(zip(cell.tolist(), (angle * 20).astype(int).tolist())))
    member = [np.array([(c, int(a * 20)) == k for c, a in zip(cell, angle)]) for k in keys]
    rings = ci.Rings(*(np.array(x) for x in zip(*[(k[0], k[1], m.sum(), angle[m].min(), angle[m].max()) for k, m in zip(keys, member)])))
    queries = ci.unit(np.vstack([rows[:5], rng.normal(size=(5, dims)), centres]))
    bound = rings.bounds(queries, centres)
    for g, m in enumerate(member):
        assert (np.round(queries @ rows[m].T, 9) <= bound[:, g, None]).all()


def test_nothing_stored_nothing_asked_and_few_rows(spark):
    none = stored(spark.createDataFrame([], "vec_id long, embedding array<double>"))
    asked = frame(spark, np.eye(3), "query_id")
    assert ci.CellIndex.build(none).topk(asked, 5).rows.isEmpty()
    few = ci.CellIndex.build(stored(frame(spark, np.eye(3))))
    assert few.topk(asked.limit(0), 5).rows.isEmpty()
    assert len(triples(few.topk(asked, 5))) == 9
    gaps = stored(frame(spark, np.eye(3))).unionByName(spark.createDataFrame([(9, None, [])], "row long, v array<double>, terms array<long>"))
    assert len(triples(ci.CellIndex.build(gaps).topk(asked, 5))) == 9


WORDS = [f"word{i}" for i in range(40)]


@pytest.mark.parametrize("seed", range(3))
def test_hybrid_equals_all_pairs(spark, monkeypatch, seed):
    """Frequent and rare words, rows without vector or text, queries without either."""
    monkeypatch.setattr(ci, "FIRST_LOOK", 30)
    monkeypatch.setattr(ci, "FIRST_POSTINGS", 12)
    monkeypatch.setattr(ci, "ROWS_PER_PART", 25)
    rng = np.random.default_rng(seed)
    data = clustered(seed, 600, 6, 12, 0.2)
    share = 1 / (1 + np.arange(40))
    texts = [" ".join(rng.choice(WORDS, size=rng.integers(0, 8), p=share / share.sum())) for _ in range(700)]
    docs = spark.createDataFrame([(i + 100, t) for i, t in enumerate(texts)], "vec_id long, text string")
    corpus = frame(spark, data)
    asked = spark.createDataFrame([(i, t) for i, t in enumerate([texts[3], "word0 word1", "word39 word0", "unknown", "", None, *texts[50:60]])], "query_id long, text string")
    queries = frame(spark, np.vstack([data[[3, 30, 7]], rng.normal(size=(9, 6))]), "query_id")
    index = ci.HybridIndex.build(corpus, docs)
    found = index.topk(queries, asked, 7)
    plain = sim.hybrid_topk(queries, asked, corpus, docs, 7)
    want = {(r["query_id"], r["rank"]): (r["vec_id"], round(r["score"], 7)) for r in plain.collect()}
    got = {(r["query"], r["rank"]): (r["row"], round(r["score"], 7)) for r in found.rows.collect()}
    assert got == want


def test_hybrid_follows_postings_instead_of_all_rows(spark):
    """A rare word leads to its rows; the rest is skipped where cells allow it."""
    data = clustered(2, 5_000, 16, 40, 0.02)
    docs = spark.createDataFrame([(i, f"common rare{i // 10}") for i in range(5_000)], "vec_id long, text string")
    index = ci.HybridIndex.build(frame(spark, data), docs)
    asked = spark.createDataFrame([(i, f"common rare{i}") for i in range(20)], "query_id long, text string")
    queries = frame(spark, data[100:120], "query_id")
    found = index.topk(queries, asked, 5)
    plain = sim.hybrid_topk(queries, asked, frame(spark, data), docs, 5)
    assert triples(found) == sorted((r["query_id"], r["vec_id"], r["rank"]) for r in plain.collect())
    work = found.work.agg(F.sum("looked"), F.sum("stored")).head()
    assert work[0] < 0.5 * work[1]


def test_a_plan_passes_visits_on_in_bounded_batches():
    rng = np.random.default_rng(3)
    groups, queries = 300, 100
    centres = ci.unit(rng.normal(size=(20, 8)))
    rings = ci.Rings(rng.integers(0, 20, groups), np.arange(groups) % 64, np.full(groups, 10), np.zeros(groups), np.full(groups, 3.0))
    v = rng.normal(size=(queries, 8)).tolist()
    none = [[]] * queries
    columns = [
        pa.array(range(queries), pa.int64()), pa.array(v, pa.list_(pa.float64())), pa.array(none, pa.list_(pa.int64())),
        pa.array(none, pa.list_(pa.float64())), pa.array(none, pa.list_(pa.int64())), pa.array([None] * queries, pa.float64()),
    ]
    batch = pa.RecordBatch.from_arrays(columns, names=["query", "v", "terms", "idfs", "dfs", "reach"])
    out = list(ci._Plan(centres, rings, 5, 0.0, 1.0).task(False)(iter([batch])))
    assert max(b.num_rows for b in out) <= 8_192
    seen = sorted((q, c, r) for b in out for q, c, r in zip(*(b.column(x).to_pylist() for x in ("query", "cell", "ring"))))
    first = ci._Plan(centres, rings, 5, 0.0, 1.0)
    bounds = rings.bounds(ci.unit(np.array(v)), centres)
    wanted = []
    for q in range(queries):
        left = set(range(groups)) - set(first.first_look(bounds[q], True).tolist())
        wanted += [(q, int(rings.cell[g]), int(rings.ring[g])) for g in left]
    assert seen == sorted(wanted)


def test_an_index_writes_a_pair_of_row_and_term_once(spark):
    """All that building leaves on disk, beside the eight bytes a term's hash has."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(20_000)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words, 250))) for i in range(800)], "vec_id long, text string")
    corpus = frame(spark, rng.normal(size=(40, 4)))
    before = set(os.listdir(shared_dir(spark)))
    ci.HybridIndex.build(corpus, docs.repartition(2))
    left = [os.path.join(shared_dir(spark), x) for x in set(os.listdir(shared_dir(spark))) - before]
    size = sum(os.path.getsize(os.path.join(at, x)) for top in left for at, _, names in os.walk(top) for x in names)
    pairs = with_grams(docs, "text").select(F.sum(F.size(F.array_distinct("grams")))).head()[0]
    print("bytes a pair", size / pairs)
    assert size < 12 * pairs


@pytest.mark.parametrize("segment_terms, asked_terms", [(40, 3), (1_000_000, 1_000_000)])
def test_held_terms_are_those_of_the_rows(spark, monkeypatch, segment_terms, asked_terms):
    """Keys that repeat on either side, empty and null texts, terms that nothing holds."""
    monkeypatch.setattr(ci, "SEGMENT_TERMS", segment_terms)
    monkeypatch.setattr(ci, "ASKED_TERMS", asked_terms)
    rng = np.random.default_rng(6)
    texts = [" ".join(rng.choice(WORDS, size=rng.integers(0, 9))) for _ in range(120)] + ["", None]
    docs = spark.createDataFrame([(i % 100, t) for i, t in enumerate(texts)], "vec_id long, text string")
    vectors = [(i % 50 + 30, [float(x) for x in rng.normal(size=3)]) for i in range(70)]
    corpus = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    index = ci.HybridIndex.build(corpus, docs.repartition(3))
    asked = spark.createDataFrame([(t,) for t in (*WORDS[:25], "word3 word9", "no such term")], "t string").select(F.xxhash64("t").alias("term"))
    wanted = {r["term"] for r in asked.collect()}
    grams = with_grams(docs, "text").select("vec_id", F.transform(F.array_distinct("grams"), lambda x: F.xxhash64(x)).alias("terms"))
    copies = {i: max(1, sum(v[0] == i for v in vectors)) for i in range(100)}
    want = sorted((r["vec_id"], tuple(sorted(wanted & set(r["terms"])))) for r in grams.collect() for _ in range(copies[r["vec_id"]]) if wanted & set(r["terms"]))
    got = index.held(asked).collect()
    assert sorted((r["row"], tuple(sorted(r["terms"]))) for r in got) == want
    assert index.n_docs == sum(copies[i % 100] for i in range(len(texts)))


def test_packed_numbers_come_back():
    for numbers in (np.array([0, 0, 0]), np.array([0, 255, 256, 70_000]), np.array([1, 2**63, 2**64 - 1], np.uint64)):
        assert ci.unpacked(ci.packed(numbers), len(numbers)).tolist() == numbers.tolist()
