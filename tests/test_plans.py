"""The physical plans that the large-table promises rest on."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewright.catalog import queries as registered
from sievewright.operators import dedup, features as ft, similarity as sim, split as sp
from sievewright.session import shared_dir


@pytest.fixture()
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def folder(spark, tmp_path):
    """Tiny tables in the layout of the candidates view."""
    data = {
        "documents": spark.range(20).selectExpr("id doc_id", "concat('text ', id) text", "'en' lang", "'s' source", "6L n_chars"),
        "labels": spark.range(5).selectExpr("id doc_id", "1 quality", "0 toxic"),
        "embeddings": spark.range(20).selectExpr("id vec_id", "array(1f, cast(id as float)) embedding", "cast(id % 2 as int) label"),
    }
    for name, df in data.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_only_needed_tables_and_columns_are_read(spark, tmp_path):
    p = plan(registered.label_clean(spark, folder(spark, tmp_path)))
    assert "ReadSchema: struct<doc_id:bigint>" in p
    assert "text" not in p and "customer" not in p and "conversations" not in p


def test_dedup_combines_before_the_shuffle(spark, no_auto_broadcast):
    df = spark.range(100).selectExpr("id candidate_id", "concat('u', id % 3) resume_url", "repeat('x', 50) resume_text")
    p = plan(dedup.dedup_first(df))
    lines = p.split("\n")
    by_url = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(resume_url" in line]
    # One exchange by address, of partial minima; the wide rows go by the unique id.
    assert len(by_url) == 1 and "partial_min" in lines[by_url[0] + 1]
    assert sum("Exchange hashpartitioning(candidate_id" in line for line in lines) == 2


def test_split_never_sorts_a_label(spark, no_auto_broadcast):
    df = spark.range(100).selectExpr("id k", "if(id % 9 = 0, 'Yes', 'No') label", "repeat('x', 50) body")
    p = plan(sp.stratified_split(df, "k", "label"))
    # The wide side meets the cuts by broadcast and is not exchanged at all.
    for line in p.split("\n"):
        if "Exchange" in line or "Sort " in line:
            assert "body" not in line
    assert p.count("BroadcastHashJoin") == 2


def test_topk_is_pruned_before_the_exchange(spark, no_auto_broadcast):
    df = spark.range(100).selectExpr("id % 3 g", "id", "cast(id as double) s")
    p = plan(sim.top_k(df, "g", "s", "id", 5))
    assert p.index("WindowGroupLimit") < p.rindex("WindowGroupLimit")
    assert "Partial" in p


def test_vocabulary_has_one_shuffle_of_terms(spark, no_auto_broadcast):
    df = spark.range(10).selectExpr("id k", "concat('some words ', id) text")
    p = plan(ft.term_statistics(ft.with_grams(df, "text")))
    assert p.count("Exchange") == 1 and "partial_count" in p
    # Token expressions are computed once: nothing was inferred from explode.
    assert p.count("regexp_extract_all") == 1


def test_tfidf_drops_foreign_grams_in_the_task(spark, no_auto_broadcast):
    df = spark.range(10).selectExpr("id k", "concat('some words ', id) text")
    vocab = spark.createDataFrame([("words", 1.0)], "term string, idf double")
    p = plan(ft.tfidf(df, "k", "text", vocab))
    assert "BroadcastHashJoin" in p.split("Exchange hashpartitioning")[1]
    assert p.count("Exchange hashpartitioning") == 1


def test_tfidf_makes_no_row_for_a_gram(spark, no_auto_broadcast):
    df = spark.range(10).selectExpr("id k", "concat('some words ', id) text")
    vocab = spark.createDataFrame([("words", 1.0)], "term string, idf double")
    for made in (ft.tfidf(df, "k", "text", vocab), ft.vocabulary(df, "k", "text")):
        assert "Generate" not in plan(made) and "Window" not in plan(made)


def test_ml_features_reads_no_dense_vector(spark, tmp_path):
    sf = folder(spark, tmp_path)
    spark.createDataFrame([(1, "")], "p_partkey long, p_name string").write.parquet(f"{sf}/part.parquet")
    spark.createDataFrame([(0, "about things")], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    found = registered.ml_features(spark, sf)
    assert "unwrap_udt" in plan(found)
    # role, title, things and their pairs, alike in 18 rows of 20; one of the rows without an address has no description.
    want = {i: (0, 0.0) if i % 17 == 0 else (6, 0.408248) for i in range(20) if i % 5}
    assert {r.candidate_id: (r.n_terms, r.top_weight) for r in found.where("candidate_id % 5 <> 0").collect()} == want


def test_search_makes_no_pairs(spark, tmp_path, no_auto_broadcast):
    corpus = spark.read.parquet(folder(spark, tmp_path) + "/embeddings.parquet")
    queries = corpus.where("vec_id < 3").select(F.col("vec_id").alias("query_id"), "embedding")
    few, many = (plan(sim.cosine_topk(queries, corpus, 2, block_values=b)) for b in (1_000_000, 20))
    for p in (few, many):
        assert "CartesianProduct" not in p and "NestedLoop" not in p and "Broadcast" not in p
        assert p.count("FlatMapCoGroupsInPandas") == 1


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
