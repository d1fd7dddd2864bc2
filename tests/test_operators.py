"""Dedup, merges, weights, splits, features and reports on small tables."""

from __future__ import annotations

import collections
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from sievewright import schema
from sievewright.operators import compare, dedup, evaluate as ev, features as ft, merge, skew, split as sp, weights as wt


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture()
def urls(spark):
    data = [(1, "a"), (2, None), (3, "b"), (4, "a"), (5, None), (6, "b"), (7, "c")]
    return spark.createDataFrame(data, "candidate_id long, resume_url string")


def test_dedup_keeps_the_first(urls):
    out = dedup.dedup_first(urls)
    assert rows(out.select("candidate_id"), "candidate_id") == [(1,), (2,), (3,), (7,)]
    assert rows(dedup.dedup_first(out), "candidate_id") == rows(out, "candidate_id")
    kept = dedup.dedup_first(urls, keep_null_keys=True)
    assert rows(kept.select("candidate_id"), "candidate_id") == [(1,), (2,), (3,), (5,), (7,)]
    assert rows(dedup.dedup_report(urls), "n_rows") == [(7, 4, 3, 2)]
    with pytest.raises(ValueError, match="url"):
        dedup.dedup_first(urls, by="url")


def test_dedup_of_nothing(urls):
    assert rows(dedup.dedup_report(urls.where("false")), "n_rows") == [(0, 0, 0, 0)]


def test_merges(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "candidate_id long, a string")
    new = spark.createDataFrame([(2, "Y", "n"), (3, None, "m")], "candidate_id long, a string, b string")
    assert rows(merge.update_merge(base, new, ("a", "b")), "candidate_id") == [(1, "x", ""), (2, "Y", "n"), (3, "z", "m")]
    assert rows(merge.scatter(base, new, "b", "none"), "candidate_id")[0] == (1, "x", "none")
    assert rows(merge.write_back(base, new, ("b",)), "candidate_id") == [(1, "x", None), (2, "y", "n"), (3, "z", "m")]


def test_salted_join_is_a_left_join(spark):
    left = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, concat('k', id), null)) as k")
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, v int")
    out = skew.salted_left_join(left, right, "k", "id", salts=16)
    got = {r.id: r.v for r in out.collect()}
    assert out.columns == ["id", "k", "v"] and len(got) == 3000 == out.count()
    assert got == {i: 1 if i % 3 == 0 else 2 if i == 1 else None for i in range(3000)}


def test_class_weights(spark):
    df = spark.createDataFrame([("Yes",)] * 2 + [("Maybe",)] * 1 + [("No",)] * 7 + [(None,)], "label string")
    got = {r["label"]: r["weight"] for r in wt.class_weights(df, "label", wt.BOOSTS).collect()}
    assert got == pytest.approx({"Yes": 10 / 3 / 2 * 2.0, "Maybe": 10 / 3 / 1 * 1.5, "No": 10 / 3 / 7})
    plain = wt.class_weights(df, "label")
    total = wt.attach_weights(df.where("label is not null"), plain, "label").agg(F.sum("weight")).head()[0]
    assert total == pytest.approx(10.0)


def _expected_test(ids, fraction, seed=42):
    ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
    return set(ranked[: math.floor(len(ids) * fraction + 0.5)])


@pytest.mark.parametrize("fraction", [0.0, 0.01, 0.2, 0.5, 1.0])
def test_stratified_split_is_exact(spark, fraction):
    label = F.when(F.col("id") % 50 == 0, "Maybe").when(F.col("id") % 7 == 0, "Yes").otherwise("No")
    df = spark.range(5000).select(F.col("id").alias("k"), label.alias("label"))
    out = sp.stratified_split(df, "k", "label", fraction)
    by = collections.defaultdict(list)
    for r in df.collect():
        by[r["label"]].append(r["k"])
    want = set().union(*(_expected_test(ids, fraction) for ids in by.values()))
    got = out.collect()
    assert len(got) == 5000 and {r["k"] for r in got if r["is_test"]} == want


def test_plain_split(spark):
    out = sp.stratified_split(spark.range(333).withColumnRenamed("id", "k"), "k", None, 0.2)
    assert {r["k"] for r in out.where("is_test").collect()} == _expected_test(range(333), 0.2)


@pytest.mark.parametrize("n", [1, 5, 9, 10, 4321])
def test_sequential_split(spark, n):
    keys = [i * i - 50 for i in range(n)] if n < 100 else [i ** 3 for i in range(n)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "k long")
    out = sp.sequential_split(df, "k")
    assert sorted(r["k"] for r in out.where("not is_test").collect()) == keys[: int(n * 0.8)]


def test_kth_smallest_of_any_ordered_type(spark):
    df = spark.range(1000).selectExpr("(id * 7919) % 1000 as n").selectExpr("n", "format_string('%04d', n) as t").repartition(7)
    for k in (1, 2, 500, 999, 1000):
        assert sp.kth_smallest(df, "n", k) == k - 1
        assert sp.kth_smallest(df, "t", k) == f"{k - 1:04d}"
    assert sp.kth_smallest(df, "n", 0) is None and sp.kth_smallest(df, "n", 1001) is None
    marked = sp.sequential_split(df, "t", 0.8)
    assert marked.where("is_test").count() == 200 and marked.where("is_test").agg(F.min("t")).head()[0] == "0800"


def test_log_loss_of_an_impossible_truth_is_large(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.5, 1.0), (None, 1.0)], "p double, w double")
    loss = ev.weighted_log_loss(df, F.col("p"), F.col("w")).head()["log_loss"]
    assert 300 < loss < 400


def test_drift_sees_labels_outside_the_list(spark):
    rows = [("a", "x"), ("a", "y"), ("a", "y"), ("b", "x"), ("b", "x"), ("b", "z")]
    df = spark.createDataFrame(rows, "period string, label string")
    psi = {r.period: r.psi_baseline for r in compare.label_drift(df, "period", "label", ["x"]).collect()}
    assert psi["a"] == 0 and psi["b"] > 0.1


def test_split_modes(spark):
    few = spark.createDataFrame([(i, "Yes" if i % 2 else "No") for i in range(9)], "k long, label string")
    train, test, how = sp.train_test_split(few, "k", "label")
    assert how == "reused" and train.count() == test.count() == 9
    train, test, how = sp.train_test_split(few, "k", "label", small="sequential")
    assert how == "sequential" and (train.count(), test.count()) == (7, 2)
    single = spark.createDataFrame([(i, "Yes" if i == 3 else "No") for i in range(20)], "k long, label string")
    train, test, how = sp.train_test_split(single, "k", "label")
    assert how == "plain" and (train.count(), test.count()) == (16, 4)
    assert not {r["k"] for r in train.collect()} & {r["k"] for r in test.collect()}


def test_folds_cover_everything(spark):
    out = spark.range(1000).groupBy(sp.fold_of(F.col("id"), 5).alias("f")).count().collect()
    assert sorted(r["f"] for r in out) == list(range(5)) and sum(r["count"] for r in out) == 1000


TEXTS = {1: "The red fox and a red dog", 2: "red fox RED fox", 3: "", 4: None, 5: "x dog_1 élan don't", 6: "fox fox"}


def _python_grams(text):
    import re

    toks = [t for t in re.findall(r"\w{2,}", (text or "").lower()) if t not in ft.STOP_WORDS]
    return toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(ft.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_grams(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "k long, text string")
    got = {r["k"]: r["grams"] for r in ft.with_grams(df, "text").collect()}
    assert got == {k: _python_grams(t) for k, t in TEXTS.items()}


def test_vocabulary_and_tfidf_by_hand(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "k long, text string")
    grams = {k: _python_grams(t) for k, t in TEXTS.items()}
    tf = collections.Counter(g for gs in grams.values() for g in gs)
    dfreq = collections.Counter(g for gs in grams.values() for g in set(gs))
    want = [g for g in sorted(tf, key=lambda g: (-tf[g], g)) if dfreq[g] >= 2 and dfreq[g] <= 0.95 * 6][:3]
    vocab = ft.vocabulary(df, "k", "text", size=3)
    got = {r["term"]: r for r in vocab.collect()}
    assert set(got) == set(want)
    for g in want:
        assert (got[g]["tf"], got[g]["df"]) == (tf[g], dfreq[g])
        assert got[g]["idf"] == pytest.approx(math.log((1 + 6) / (1 + dfreq[g])) + 1)
    for k, gs in grams.items():
        raw = {g: gs.count(g) * got[g]["idf"] for g in want if g in gs}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        found = {r["term"]: r["weight"] for r in ft.tfidf(df, "k", "text", vocab).where(F.col("k") == k).collect()}
        assert found == pytest.approx({g: x / norm for g, x in raw.items()})


def test_terms_are_counted_where_the_texts_are(spark, monkeypatch):
    """Slices of few tokens, keys that repeat or are null, and words too rare for a pair."""
    monkeypatch.setattr(ft, "TOKENS_PER_SLICE", 3)
    usual = "red fox red fox blue fox"
    texts = [(1, usual), (1, "red fox green"), (None, usual), (None, "fox fox"), (2, None), (3, "rare words rare words"), (4, "")]
    df = spark.createDataFrame(texts, "k long, text string").repartition(2)
    grams = [_python_grams(t or "") for _, t in texts]
    tf = collections.Counter(g for gs in grams for g in gs)
    dfreq = collections.Counter(g for gs in grams for g in set(gs))
    want = [g for g in sorted(tf, key=lambda g: (-tf[g], g)) if 2 <= dfreq[g] <= 0.95 * len(texts)][:2]
    asked, count = [], ft.counted_terms
    monkeypatch.setattr(ft, "counted_terms", lambda *a, **k: asked.append(k) or count(*a, **k))
    vocab = ft.vocabulary(df, "k", "text", size=2)
    assert [(r.term, r.tf, r.df) for r in vocab.orderBy(F.desc("tf"), "term").collect()] == [(g, tf[g], dfreq[g]) for g in want]
    assert sorted(asked[-1]["among"]) == ["fox", "red"] and asked[-1]["pairs"]
    known = {"fox": 1.5, "red fox": 2.0, "fox fox": 3.0, "none": 1.0}
    table = spark.createDataFrame(list(known.items()), "term string, idf double")
    by_key = collections.defaultdict(collections.Counter)
    for (k, _), gs in zip(texts, grams):
        by_key[k].update(g for g in gs if g in known)
    wanted = {}
    for k, own in by_key.items():
        norm = math.sqrt(sum((n * known[g]) ** 2 for g, n in own.items()))
        wanted |= {(k, g): (n, round(n * known[g] / norm, 9)) for g, n in own.items()}
    found = ft.tfidf(df, "k", "text", table).collect()
    assert {(r.k, r.term): (r.tf, round(r.weight, 9)) for r in found} == wanted and len(found) == len(wanted)
    assert ft.tfidf(df.limit(0), "k", "text", table).count() == 0 == ft.tfidf(df, "k", "text", table.limit(0)).count()


def test_counts_of_a_key_go_over_batches():
    import pyarrow as pa

    def batch(keys, terms, tf):
        columns = [pa.array(keys, pa.int64()), pa.array(terms, pa.int32()), pa.array(tf, pa.int64()), pa.array([1.0] * len(tf))]
        return pa.RecordBatch.from_arrays(columns, ["k", "t", "tf", "idf"])

    parts = [batch([None, None], [1, 1], [2, 3]), batch([None, 5], [4, 0], [1, 1]), batch([], [], []), batch([5, 5, 6], [0, 2, 2], [1, 7, 9])]
    got = [(keys[int(o)].as_py(), int(t), int(n)) for keys, owner, term, tf, _ in ft._key_counts(iter(parts)) for o, t, n in zip(owner, term, tf)]
    assert got == [(None, 1, 5), (None, 4, 1), (5, 0, 2), (5, 2, 7), (6, 2, 9)]


def test_reports(spark):
    data = [("Yes", "Yes")] * 3 + [("Yes", "No")] * 1 + [("No", "No")] * 5 + [("No", "Maybe")] * 1
    df = spark.createDataFrame(data, "t string, p string")
    assert rows(ev.confusion_matrix(df, "t", "p"), "t") == [("No", 1, 5, 0), ("Yes", 0, 1, 3)]
    report = {r["label"]: r.asDict() for r in ev.classification_report(df, "t", "p").collect()}
    assert report["Yes"]["precision"] == 1.0 and report["Yes"]["recall"] == 0.75
    assert report["Maybe"]["precision"] == report["Maybe"]["recall"] == report["Maybe"]["f1"] == 0.0
    assert report["No"]["f1"] == pytest.approx(2 * (5 / 6) * (5 / 6) / (5 / 6 + 5 / 6))
    assert report["accuracy"]["f1"] == 0.8 and report["accuracy"]["support"] == 10
    assert report["weighted avg"]["recall"] == pytest.approx(0.8)
    assert report["macro avg"]["recall"] == pytest.approx((0.75 + 5 / 6) / 3)
    assert ev.accuracy(df, "t", "p").head().asDict() == {"n": 10, "accuracy": 0.8, "majority_baseline": 0.6}


def test_report_leaves_out_absent_labels(spark):
    df = spark.createDataFrame([("Yes", "Yes"), ("No", "Yes")], "t string, p string")
    assert {r["label"] for r in ev.classification_report(df, "t", "p").collect()} == {
        "Yes", "No", "accuracy", "macro avg", "weighted avg",
    }


def test_log_loss_and_summary(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.25, 3.0)], "p double, w double")
    got = ev.weighted_log_loss(df, F.col("p"), F.col("w")).head()
    assert got["log_loss"] == pytest.approx((math.log(2) + 3 * math.log(4)) / 4)
    s = spark.createDataFrame([(True, 0.4), (True, 0.8), (False, None)], "m boolean, c double")
    assert tuple(ev.prediction_summary(s, F.col("m"), F.col("c"), 0.5).head()) == (3, 2, pytest.approx(0.6), 1)


def test_drift_and_agreement(spark):
    data = [("d1", "a")] * 5 + [("d1", "b")] * 5 + [("d2", "a")] * 8 + [("d2", "b")] * 2 + [("d3", "a")] * 10
    out = rows(compare.label_drift(spark.createDataFrame(data, "d string, l string"), "d", "l", ("a", "b")), "d")
    psi = (0.8 - 0.5) * math.log(0.8 / 0.5) + (0.2 - 0.5) * math.log(0.2 / 0.5)
    assert out[0] == ("d1", 10, 0.0, None)
    assert out[1][2] == pytest.approx(psi) and out[1][3] == pytest.approx(psi)
    assert out[2][2] > out[1][2]
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "b")], "x string, y string")
    cells = {(r["x"], r["y"]): (r["n"], r["agreement_rate"]) for r in compare.agreement(pairs, "x", "y").collect()}
    assert cells == {("a", "a"): (1, 0.75), ("a", "b"): (1, 0.75), ("b", "b"): (2, 0.75)}


def test_funnel_and_errors(spark):
    df = spark.createDataFrame([("Reject", "x"), (None, "Error: 401"), ("Advanced", "Error: late")], "r string, a string")
    assert tuple(wt.stage_funnel(df, "r").head()) == (3, 1, 2)
    got = wt.error_counts(df.withColumn("stage", F.lit("s")), "stage", "a").head()
    assert tuple(got) == ("s", 3, 2, 1)


def test_schema_helpers(spark):
    df = spark.createDataFrame([("x", "y")], "`Job → Description` string, `Recruiter Notes ` string")
    headings = {"Job → Description": "job_desc", "Recruiter Notes ": "criteria", "Result[LLM]": "result_llm"}
    short = schema.rename_in(df, headings)
    assert short.columns == ["job_desc", "criteria"]
    assert schema.rename_out(short, headings).columns == df.columns
    with pytest.raises(ValueError, match="resume_text.*verdict"):
        schema.require_columns(short, schema.TRAIN_REQUIRED)
    full = schema.ensure_columns(short, {"verdict": None, "criteria": "z"})
    assert full.columns == ["job_desc", "criteria", "verdict"] and full.head()["criteria"] == "y"
    assert short.select(schema.column_or(short, "none", "d")).head()[0] == "d"
    own = short.withColumn("text", F.lit("kept"))
    assert schema.drop_working(own.withColumn(schema.TEXT_COL, F.lit(""))).columns == [*short.columns, "text"]


def test_confusion_counts_every_row_with_a_column_for_other_predictions(spark):
    df = spark.createDataFrame([("Yes", "No"), ("Yes", "Perhaps"), ("Yes", None), ("odd", "Yes")], "truth string, predicted string")
    got = {r["truth"]: r.asDict() for r in ev.confusion_matrix(df, "truth", "predicted", other="other").collect()}
    assert got["Yes"]["No"] == 1 and got["Yes"]["other"] == 2 and got["odd"]["Yes"] == 1
    assert sum(v for r in got.values() for k, v in r.items() if k != "truth") == 4
