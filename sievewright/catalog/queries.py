"""The registered queries: each takes a session and a table folder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import labels as lab, parse, scores as sc, templates as tpl, text as tx
from ..operators import cluster, compare, dedup, evaluate as ev, features as ft, inference as inf, merge, scoring
from ..operators import similarity as sim, split as sp, weights as wt
from ..operators.model import FEATURES, FitSettings, apply_model, feature_stages, load_model, model_labels, save_model
from ..plans import evaluation as flow, prediction, training
from ..schema import TEXT_COL, column_or
from ..session import new_path
from ..sources import tables
from ..sources.candidates import candidates, table
from . import stub

Query = Callable[[SparkSession, str], DataFrame]
KEY = "candidate_id"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
LOGIT_SCALE = 3.0
REVIEW_BELOW = 0.6


# -- sources ---------------------------------------------------------------


def na_normalise(spark: SparkSession, sf: str) -> DataFrame:
    raw = candidates(spark, sf, "phone", "verdict", "result_llm").select(
        KEY,
        F.coalesce("phone", F.lit("NA")).alias("phone"),
        F.coalesce("verdict", F.lit("nan")).alias("verdict"),
        F.when(F.col("result_llm") == "Advanced", "None").otherwise(F.col("result_llm")).alias("result_llm"),
    )
    return tables.na_to_null(raw)


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Résumés with line breaks and quotes, out to CSV and back."""
    path = new_path(spark, "csv")
    tables.write_csv(candidates(spark, sf, "resume_text", "verdict"), path, bom=False)
    back = tables.read_csv(spark, path)
    return back.select(
        F.col(KEY).cast("bigint").alias(KEY), F.md5("resume_text").alias("resume_md5"), "verdict"
    )


# -- projections ------------------------------------------------------------


def combined_text(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "job_desc", "resume_text")
    text = tx.combined_text(F.col("job_desc"), F.col("resume_text"))
    return df.select(KEY, F.md5(text).alias("text_md5"), F.length(text).cast("bigint").alias("n_chars"))


def title_case(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "name", "resume_text")
    return df.select(
        KEY,
        tx.title_case(F.col("name")).alias("name"),
        F.md5(tx.title_case(F.col("resume_text"))).alias("resume_md5"),
    )


def phone_clean(spark: SparkSession, sf: str) -> DataFrame:
    return tx.clean_phone(candidates(spark, sf, "phone"))


def job_title(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf, "job_desc").select(KEY, tx.job_title(F.col("job_desc")).alias("job_title"))


def profile_url(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf, "resume_text").select(
        KEY, tx.profile_url(F.col("resume_text")).alias("profile_url")
    )


def first_name(spark: SparkSession, sf: str) -> DataFrame:
    """First words of the name and of the job text, which has blanks in it."""
    df = candidates(spark, sf, "name", "job_desc")
    return df.select(
        KEY,
        tx.first_name(F.col("name")).alias("first_name"),
        tx.first_name(F.col("job_desc")).alias("first_word"),
    )


def hyperlink(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "resume_url", "resume_text", "verdict")
    return df.select(
        KEY,
        tx.hyperlink("Resume", F.when(F.col("verdict").isNotNull(), F.col("resume_url"))).alias("resume_link"),
        tx.profile_link(tx.profile_url(F.col("resume_text"))).alias("profile_link"),
    )


def profile_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "resume_text", "job_desc")
    raw = F.concat(F.lit("```markdown\n{"), F.coalesce("job_desc", F.lit("")), F.lit("}\n"), "resume_text", F.lit("\n```"))
    cleaned = tx.clean_profile(raw)
    return df.select(KEY, F.md5(cleaned).alias("profile_md5"), F.length(cleaned).cast("bigint").alias("n_chars"))


# -- labels and filters ------------------------------------------------------


def label_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    return df.select(
        KEY,
        lab.clean_label(F.col("verdict")).alias("verdict_clean"),
        lab.clean_label(F.col("result_llm")).alias("result_clean"),
    )


def reject_map(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    v, r = F.col("verdict"), F.col("result_llm")
    return df.select(
        KEY, lab.map_reject(v, r).alias("verdict"), lab.reject_applies(v, r).alias("mapped")
    )


def verdict_norm(spark: SparkSession, sf: str) -> DataFrame:
    return candidates(spark, sf, "result_llm").select(
        KEY, lab.normalise_verdict(F.col("result_llm")).alias("result_llm")
    )


def label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    v = lab.map_reject(F.col("verdict"), F.col("result_llm"))
    both = df.select(F.explode(F.array(
        F.struct(F.lit("raw").alias("kind"), v.alias("label")),
        F.struct(F.lit("clean").alias("kind"), lab.clean_label(v).alias("label")),
    )).alias("r")).select("r.*")
    return both.where(F.col("label").isNotNull()).groupBy("kind", "label").agg(F.count(F.lit(1)).alias("n"))


def distinct_classes(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict")
    return wt.distinct_labels(df.select(lab.clean_label(F.col("verdict")).alias("label")), "label")


def empty_verdict_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict")
    return df.where(lab.to_predict(F.col("verdict"))).select(KEY)


def nonblank_text(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "job_desc", "resume_text")
    text = tx.combined_text(F.col("job_desc"), F.col("resume_text"))
    return df.where(tx.has_text(text)).select(KEY, tx.has_text(F.col("job_desc")).alias("has_job"))


def non_rejected(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm")
    v = lab.normalise_verdict(F.col("result_llm"))
    return df.select(KEY, v.alias("result_llm")).where(lab.not_rejected(F.col("result_llm")))


def manual_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm")
    return df.where(lab.needs_manual(lab.normalise_verdict(F.col("result_llm")))).select(KEY)


def has_interview(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "transcript", "duration")
    return df.where(lab.has_interview(F.col("transcript"))).select(
        KEY, F.md5("transcript").alias("transcript_md5"), "duration"
    )


# -- dedup and merges ----------------------------------------------------------


def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "resume_url", "company")
    return dedup.dedup_first(df).select(KEY, "resume_url", "company")


def dedup_report(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.dedup_report(candidates(spark, sf, "resume_url"))


def stage_funnel(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm")
    return wt.stage_funnel(df.withColumn("r", lab.normalise_verdict(F.col("result_llm"))), "r")


def interview_scatter(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "transcript")
    talks = df.where(lab.has_interview(F.col("transcript")))
    answered = talks.select(KEY, F.concat(F.lit("seen "), F.md5("transcript")).alias("interview_eval"))
    return merge.scatter(df.select(KEY), answered, "interview_eval", tpl.NO_INTERVIEW)


def update_merge(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm", "company")
    r = lab.normalise_verdict(F.col("result_llm"))
    new = df.where(lab.not_rejected(r)).select(
        KEY, F.upper("company").alias("company"), F.when(r != lab.MANUAL, r).alias("good_fit")
    )
    return merge.update_merge(df.select(KEY, "company"), new, ("company", "good_fit"))


def fill_empty(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    v = F.col("verdict")
    predicted = lab.clean_label(F.col("result_llm"))
    return df.select(KEY, lab.fill_empty(v, lab.to_predict(v), predicted).alias("verdict"))


def manual_writeback(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm", "company")
    r = lab.normalise_verdict(F.col("result_llm"))
    treated = df.where(lab.needs_manual(r)).select(
        KEY, F.lit("No").alias("manual_verdict"), F.concat(F.lit("from "), "company").alias("justification")
    )
    return merge.write_back(df.select(KEY), treated, ("manual_verdict", "justification"))


# -- class weights and splits -----------------------------------------------------


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "verdict", "result_llm")
    v = lab.map_reject(F.col("verdict"), F.col("result_llm"))
    return df.select(KEY, lab.clean_label(v).alias("verdict_clean"))


def class_weights_boosted(spark: SparkSession, sf: str) -> DataFrame:
    w = wt.class_weights(_labelled(spark, sf), "verdict_clean", wt.BOOSTS)
    return w.select("verdict_clean", "n", F.round("weight", 6).alias("weight"))


def class_weights_train(spark: SparkSession, sf: str) -> DataFrame:
    """Weights of the train part, attached to its rows and summed per label."""
    marked = sp.stratified_split(_labelled(spark, sf), KEY, "verdict_clean")
    train = marked.where(~F.col("is_test"))
    weighted = wt.attach_weights(train, wt.class_weights(train, "verdict_clean"), "verdict_clean")
    return weighted.groupBy("verdict_clean").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.max("weight"), 6).alias("weight"),
        F.round(F.sum("weight"), 4).alias("total_weight"),
    )


def split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return sp.stratified_split(_labelled(spark, sf), KEY, "verdict_clean")


def split_plain(spark: SparkSession, sf: str) -> DataFrame:
    return sp.stratified_split(candidates(spark, sf), KEY, None)


def split_sequential(spark: SparkSession, sf: str) -> DataFrame:
    return sp.sequential_split(candidates(spark, sf), KEY)


# -- text features ----------------------------------------------------------------


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "job_desc", "resume_text")
    return df.select(KEY, tx.combined_text(F.col("job_desc"), F.col("resume_text")).alias("text"))


def tokens(spark: SparkSession, sf: str) -> DataFrame:
    df = _texts(spark, sf).withColumn("t", ft.tokens(F.col("text")))
    return df.select(
        KEY, F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


def stop_filtered(spark: SparkSession, sf: str) -> DataFrame:
    df = _texts(spark, sf).withColumn("t", ft.remove_stops(ft.tokens(F.col("text"))))
    return df.select(
        KEY, F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("tokens_md5")
    )


def bigrams(spark: SparkSession, sf: str) -> DataFrame:
    df = _texts(spark, sf).withColumn("t", ft.remove_stops(ft.tokens(F.col("text"))))
    pairs = df.withColumn("b", ft.bigrams(F.col("t")))
    return pairs.select(
        KEY, F.size("b").cast("bigint").alias("n_pairs"), F.md5(F.array_join("b", "|")).alias("pairs_md5")
    )


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    vocab = ft.vocabulary(_texts(spark, sf), KEY, "text")
    return vocab.select("term", "tf", "df", F.round("idf", 6).alias("idf"))


def tfidf_relational(spark: SparkSession, sf: str) -> DataFrame:
    df = _texts(spark, sf)
    weights = ft.tfidf(df, KEY, "text", ft.vocabulary(df, KEY, "text"))
    return weights.select(KEY, "term", "tf", F.round("weight", 6).alias("weight"))


# -- scores -------------------------------------------------------------------------


def _logits(start: int) -> Column:
    """Logits in the order Maybe, No, Yes: each the scaled sum of every sixth vector position."""
    every = lambda i: F.filter("embedding", lambda x, at: at % 6 == start + i)
    total = lambda i: F.aggregate(every(i), F.lit(0.0), lambda a, x: a + x.cast("double"))
    return F.array(*[total(i) * F.lit(LOGIT_SCALE) for i in range(3)])


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "embeddings")
    truth = sc.label_at((F.col("label") % 3).cast("int"))
    return df.select("vec_id", truth.alias("truth"), sc.softmax(_logits(0)).alias("p"), sc.softmax(_logits(3)).alias("q"))


def softmax_argmax(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    return _scored(spark, sf).select(
        "vec_id",
        *[F.round(F.get(p, F.lit(i)), 6).alias(f"p_{x.lower()}") for i, x in enumerate(lab.LABELS)],
        sc.argmax(p).cast("bigint").alias("best"),
        sc.label_at(sc.argmax(p)).alias("label"),
    )


def threshold_verdict(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    return _scored(spark, sf).select(
        "vec_id", sc.threshold_label(p).alias("verdict"), F.round(sc.confidence(p), 6).alias("confidence")
    )


def confidence_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose argmax is Yes count as the scored ones."""
    df = _scored(spark, sf)
    p = F.col("p")
    mask = sc.label_at(sc.argmax(p)) == "Yes"
    out = ev.prediction_summary(df, mask, sc.confidence(p), REVIEW_BELOW)
    return out.withColumn("mean_confidence", F.round("mean_confidence", 6))


def low_confidence(spark: SparkSession, sf: str) -> DataFrame:
    conf = sc.confidence(F.col("p"))
    return _scored(spark, sf).select(
        "vec_id", F.round(conf, 6).alias("confidence"), sc.needs_review(conf, REVIEW_BELOW).alias("needs_review")
    )


def review_queue(spark: SparkSession, sf: str) -> DataFrame:
    df = _scored(spark, sf).select("vec_id", F.round(sc.confidence(F.col("p")), 6).alias("confidence"))
    return compare.review_queue(df, "vec_id", "confidence", REVIEW_BELOW)


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf).withColumn("predicted", sc.threshold_label(F.col("p")))


def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ev.confusion_matrix(_judged(spark, sf), "truth", "predicted")


def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.classification_report(_judged(spark, sf), "truth", "predicted")
    return out.select("label", "support", *[F.round(m, 6).alias(m) for m in ("precision", "recall", "f1")])


def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    out = ev.accuracy(_judged(spark, sf), "truth", "predicted")
    return out.select("n", *[F.round(m, 6).alias(m) for m in ("accuracy", "majority_baseline")])


def weighted_log_loss(spark: SparkSession, sf: str) -> DataFrame:
    df = _scored(spark, sf)
    weighted = wt.attach_weights(df, wt.class_weights(df, "truth", wt.BOOSTS), "truth")
    index = F.array_position(F.array(*[F.lit(x) for x in lab.LABELS]), F.col("truth")) - 1
    out = ev.weighted_log_loss(weighted, F.get("p", index.cast("int")), F.col("weight"))
    return out.select("n", F.round("log_loss", 6).alias("log_loss"))


def ensemble_avg(spark: SparkSession, sf: str) -> DataFrame:
    out = compare.ensemble(_scored(spark, sf), ("p", "q"), (0.6, 0.4))
    tagged = out.withColumns(
        {"a": sc.label_at(sc.argmax(F.col("p"))), "b": sc.threshold_label(F.col("q"))}
    )
    return tagged.select(
        "vec_id",
        F.round(F.get("ensemble_p", F.lit(2)), 6).alias("p_yes"),
        F.round(sc.confidence(F.col("ensemble_p")), 6).alias("confidence"),
        F.col("ensemble_label").alias("label"),
        compare.majority_vote(("a", "b", "ensemble_label")).alias("voted"),
    )


def model_agreement(spark: SparkSession, sf: str) -> DataFrame:
    df = _scored(spark, sf)
    first = df.select("vec_id", sc.label_at(sc.argmax(F.col("p"))).alias("model_a"))
    second = df.select("vec_id", sc.threshold_label(F.col("q")).alias("model_b"))
    out = compare.agreement(first.join(second, "vec_id"), "model_a", "model_b")
    return out.select("model_a", "model_b", "n", *[F.round(m, 6).alias(m) for m in ("share", "agreement_rate")])


def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf)
    return df.select(KEY, sp.fold_of(F.col(KEY), 5).cast("bigint").alias("fold"))


def label_drift(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    out = compare.label_drift(df, "day", "event_type", EVENT_TYPES)
    return out.select("day", "n", *[F.round(m, 6).alias(m) for m in ("psi_baseline", "psi_previous")])


# -- model ---------------------------------------------------------------------------


def _training(spark: SparkSession, sf: str) -> DataFrame:
    return training.prepare_training(
        candidates(spark, sf, "job_desc", "resume_text", "verdict", "result_llm")
    )


def ml_features(spark: SparkSession, sf: str) -> DataFrame:
    """The feature vectors of the saved and loaded stages: terms per candidate and
    their weights."""
    df = _texts(spark, sf)
    vocab = ft.vocabulary(df, KEY, "text").collect()  # at most 5,000 rows
    stages = feature_stages([r["term"] for r in vocab], [r["idf"] for r in vocab])
    path = new_path(spark, "model")
    save_model(PipelineModel(stages=stages), path)
    # A sparse vector's own values, not all of its 5,000 places.
    vectors = load_model(spark, path).transform(df).select(KEY, F.unwrap_udt(FEATURES)["values"].alias("__values"))
    return vectors.select(
        KEY,
        F.size(F.filter("__values", lambda x: x > 0)).cast("bigint").alias("n_terms"),
        F.round(F.coalesce(F.array_max("__values"), F.lit(0.0)), 6).alias("top_weight"),
    )


def fit_predict_tfidf_lr(spark: SparkSession, sf: str) -> DataFrame:
    prepared = _training(spark, sf)
    model = training.train(prepared, FitSettings()).model
    out = prediction.predict(
        candidates(spark, sf, "job_desc", "resume_text", "verdict"), model, confidence_threshold=REVIEW_BELOW
    )
    return out.select(KEY, "verdict", F.round("confidence", 4).alias("confidence"), "needs_review")


def train_output(spark: SparkSession, sf: str) -> DataFrame:
    rows = training.with_labels(candidates(spark, sf, "job_desc", "resume_text", "verdict", "result_llm"))
    model = training.train(_training(spark, sf), FitSettings()).model
    return training.training_output(model, rows).select(KEY, "verdict", "verdict_clean", "verdict_predicted")


def fit_masks(spark: SparkSession, sf: str) -> DataFrame:
    """What a fit may and may not do to a row, whatever its weights: rows with a verdict keep
    it unscored; the others get the label the rules give their probabilities."""
    df = candidates(spark, sf, "job_desc", "resume_text", "verdict")
    model = training.train(_training(spark, sf), FitSettings(max_iter=20)).model
    out = prediction.predict(df, model, confidence_threshold=REVIEW_BELOW).select(
        KEY, F.col("verdict").alias("after"), "confidence", "needs_review"
    )
    p = dict(zip(model_labels(model), (F.get("probabilities", F.lit(i)) for i in range(3))))
    text = tx.combined_text(F.col("job_desc"), F.col("resume_text"))
    chances = apply_model(model, df.withColumn(TEXT_COL, text)).select(
        KEY, "verdict", F.array_max("probabilities").alias("top"),
        F.expr("aggregate(probabilities, 0D, (a, x) -> a + x)").alias("sum"),
        *[c.alias(x) for x, c in p.items()],
    )
    both = chances.join(out, KEY)
    ruled = F.expr("CASE WHEN Yes > 0.25 THEN 'Yes' WHEN Maybe > 0.15 THEN 'Maybe' ELSE 'No' END")
    sound = (F.col("after") == ruled) & (F.abs(F.col("sum") - 1) < 1e-9) & (F.abs(F.col("confidence") - F.col("top")) < 1e-9)
    untouched = (F.col("after") == F.col("verdict")) & F.col("confidence").isNull() & F.col("needs_review").isNull()
    empty = lab.to_predict(F.col("verdict"))
    return both.select(
        KEY, empty.alias("masked"), F.coalesce(F.when(empty, sound).otherwise(untouched), F.lit(False)).alias("as_ruled")
    )


def cross_validate(spark: SparkSession, sf: str) -> DataFrame:
    out = training.cross_validate(_training(spark, sf), 5, FitSettings())
    return out.select(F.col("fold").cast("bigint").alias("fold"), "n", *[F.round(m, 4).alias(m) for m in ("accuracy", "macro_f1")])


def dedup_landed(spark: SparkSession, sf: str) -> DataFrame:
    """Files without a key and with foreign headings: landed with one, then deduplicated.

    ``row`` tells which file row was kept; the file is written in its order.
    """
    path = new_path(spark, "csv")
    headings = {"Resume (link)": "resume_url", "Applied at": "company"}
    df = candidates(spark, sf, "company", "resume_url").select(
        F.col(KEY).alias("row"), F.col("company").alias("Applied at"), F.col("resume_url").alias("Resume (link)")
    )
    tables.write_csv(df.repartitionByRange(4, "row").sortWithinPartitions("row"), path, bom=False)
    landed = tables.land_csv(spark, path, new_path(spark, "landed"), headings, KEY)
    return dedup.dedup_first(landed).select(F.col("row").cast("bigint").alias("row"), "resume_url", "company")


def linear_weights(width: int = 64, n_labels: int = 3) -> np.ndarray:
    """Fixed scorer weights by rule, in halves between -1.5 and 1.5."""
    i = np.arange(width)[:, None]
    j = np.arange(n_labels)[None, :]
    return ((i * n_labels + j) % 7 - 3) / 2.0


def _load_linear():
    weights = linear_weights()
    return lambda vectors: np.array([np.asarray(v, dtype=np.float64) for v in vectors]) @ weights


def score_batched(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of even labels are under the mask; the others stay unscored."""
    df = table(spark, sf, "embeddings")
    out = scoring.score_rows(df, "embedding", _load_linear, F.col("label") % 2 == 0)
    return out.select("vec_id", "predicted", F.round("confidence", 6).alias("confidence"))


def _load_encoder():
    def encode(texts):
        return np.array([[len(t), t.count("e"), t.count("n"), t.count(" ")] for t in texts], dtype=np.float64)

    return encode


def embed_text(spark: SparkSession, sf: str) -> DataFrame:
    out = scoring.embed_text(_texts(spark, sf), "text", _load_encoder)
    e = F.col("embedding")
    names = ("n_chars", "n_e", "n_n", "n_blank")
    return out.select(KEY, *[F.get(e, F.lit(i)).cast("bigint").alias(x) for i, x in enumerate(names)])


def _load_by_letters():
    """Logits from letter counts, a stand-in for a text model."""

    def model(texts):
        return np.array([[t.count("a"), t.count("e") / 2.0, t.count("o")] for t in texts], dtype=np.float64) / 100.0

    return model


def predict_scorer_flow(spark: SparkSession, sf: str) -> DataFrame:
    """The prediction flow with an injected model: only empty verdicts change."""
    df = candidates(spark, sf, "job_desc", "resume_text", "verdict")
    out = prediction.predict_with_scorer(df, _load_by_letters, confidence_threshold=REVIEW_BELOW)
    return out.select(KEY, "verdict", F.round("confidence", 6).alias("confidence"), "needs_review")


def predict_all_flow(spark: SparkSession, sf: str) -> DataFrame:
    """Without a verdict column every row is scored and the column is added."""
    df = candidates(spark, sf, "job_desc", "resume_text")
    out = prediction.predict_with_scorer(df, _load_by_letters)
    return out.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))


def row_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows seen while the candidates are landed as Parquet, and rows read back."""
    df, seen = tables.counted(candidates(spark, sf, "company", "verdict"))
    landed = tables.land(df, new_path(spark, "landed"))
    return landed.agg(F.lit(seen.get["n_rows"]).cast("bigint").alias("n_seen"), F.count(F.lit(1)).alias("n_landed"))


def column_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """A present, an absent and a null column in prompt slots."""
    df = candidates(spark, sf, "company", "duration")
    return df.select(
        KEY,
        column_or(df, "company", tpl.NOT_PROVIDED).alias("company"),
        column_or(df, "email", tpl.NOT_PROVIDED).alias("email"),
        tpl.metric_slot(F.col("duration")).alias("duration"),
    )


def kmeans5(spark: SparkSession, sf: str) -> DataFrame:
    out, _ = cluster.kmeans(table(spark, sf, "embeddings"), k=5)
    return out.select("vec_id", "cluster")


def kmeans_fit(spark: SparkSession, sf: str) -> DataFrame:
    """How the fit stands: rows, clusters in use, rows that lie nearer to another cluster's
    mean, and clusters whose mean is not the centre the fit gave, beyond its tolerance."""
    out, centres = cluster.kmeans(table(spark, sf, "embeddings"), k=5)
    means = {r["query_id"]: r["embedding"] for r in sim.centroids(out, "cluster").collect()}  # five rows
    again = cluster.with_nearest(out.select("embedding", "distance", "cluster").withColumnRenamed("distance", "own"),
                                 [means.get(i, c) for i, c in enumerate(centres)], target="nearest")
    off = sum(float(np.linalg.norm(np.subtract(means[i], centres[i]))) > 0.05 for i in means)
    return again.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct("cluster").alias("n_clusters"),
        F.count_if(F.col("distance") < F.col("own") - 0.05).alias("n_misplaced"),
        F.lit(off).cast("bigint").alias("n_off_centre"),
    )


# -- templates and parsing ---------------------------------------------------------


def render_prompt(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "name", "company", "criteria", "job_desc", "resume_text", "transcript", "duration")
    fit = flow.good_fit_prompt(df, stub.TEMPLATES.good_fit)
    talk = flow.interview_prompt(df, stub.TEMPLATES.interview)
    return df.select(KEY, F.md5(fit).alias("good_fit_md5"), F.md5(talk).alias("interview_md5"))


def guard_missing(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "job_desc", "resume_text")
    return df.select(KEY, tpl.input_error(F.col("job_desc"), F.col("resume_text")).alias("guard"))


def error_propagate(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "result_llm")
    return df.select(KEY, tpl.upstream_error(F.col("result_llm")).alias("passed"))


def _answers(spark: SparkSession, sf: str) -> DataFrame:
    """Answer texts of several shapes around whole résumés."""
    df = candidates(spark, sf, "resume_text")
    t = F.col("resume_text")
    kind = F.col(KEY) % 6
    answer = (
        F.when(kind == 0, F.concat(F.lit("\n  Final Decision: ADVANCED \nJustification: "), t))
        .when(kind == 1, F.concat(F.lit("final decision: no\n"), t))
        .when(kind == 2, F.concat(F.lit("Unclear\n \tjustification: a: b "), t))
        .when(kind == 3, t)
        .when(kind == 4, F.concat(F.lit("I do not know. Justification: inline\n"), t, F.lit("\nJUSTIFICATION:late ")))
    )
    return df.select(KEY, answer.alias("answer"))


def parse_decision(spark: SparkSession, sf: str) -> DataFrame:
    a = F.col("answer")
    return _answers(spark, sf).select(
        KEY, parse.decision(a).alias("decision"), parse.decision(a, strict=True).alias("strict_decision")
    )


def parse_justification(spark: SparkSession, sf: str) -> DataFrame:
    return _answers(spark, sf).select(KEY, parse.justification(F.col("answer")).alias("justification"))


def parse_json_eval(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as structured answers; every tenth is cut off."""
    df = table(spark, sf, "events")
    body = F.format_string(
        '{"verdict_label": "%s", "evaluation_note": "user %s", "strengths": ["%s", "b"], "red_flags": []',
        "event_type", F.col("user_id").cast("string"), "event_type",
    )
    answer = F.when(F.col("event_id") % 10 == 0, body).otherwise(F.concat(body, F.lit("}")))
    parsed = df.select("event_id", parse.parse_evaluation(answer).alias("e"))
    return parsed.select(
        "event_id",
        F.col("e.verdict_label").alias("verdict_label"),
        F.col("e.evaluation_note").alias("evaluation_note"),
        F.get("e.strengths", F.lit(0)).alias("first_strength"),
        F.when(F.col("e.strengths").isNotNull(), F.size("e.strengths")).cast("bigint").alias("n_strengths"),
        F.when(F.col("e.examples").isNotNull(), F.size("e.examples")).cast("bigint").alias("n_examples"),
    )


def api_errors(spark: SparkSession, sf: str) -> DataFrame:
    return wt.error_counts(candidates(spark, sf, "company", "result_llm"), "company", "result_llm")


# -- waves and flows -----------------------------------------------------------------


def wave_map(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "resume_text")
    return inf.run_wave(df.select(KEY, F.col("resume_text").alias("prompt")), stub.StubClient(), stub.WRITER)


def wave_cache(spark: SparkSession, sf: str) -> DataFrame:
    """Two waves over the same prompts: only those that failed are asked again."""
    cache = inf.ResponseCache(new_path(spark, "cache"))
    df = candidates(spark, sf, "resume_text").select(KEY, F.col("resume_text").alias("prompt"))
    inf.run_wave(df, stub.StubClient(), stub.WRITER, cache=cache)
    return inf.run_wave(df, stub.StubClient(tag="again", refuse=False), stub.WRITER, cache=cache)


def prompt_multiplicity(spark: SparkSession, sf: str) -> DataFrame:
    """Calls a wave needs against requests made."""
    df = candidates(spark, sf, "resume_text").select(F.col("resume_text").alias("prompt"))
    return inf.distinct_prompts(df).agg(
        F.sum("n").alias("n_requests"),
        F.count(F.lit(1)).alias("n_calls"),
        (F.sum("n") - F.count(F.lit(1))).alias("n_saved"),
    )


def _service() -> flow.Service:
    return flow.Service(stub.StubClient(), stub.WRITER, stub.JUDGE)


FLOW_COLUMNS = (
    "name", "company", "criteria", "job_desc", "resume_text", "resume_url", "phone", "transcript", "duration",
)


def eval_flow(spark: SparkSession, sf: str) -> DataFrame:
    out = flow.evaluate(candidates(spark, sf, *FLOW_COLUMNS), _service(), stub.TEMPLATES)
    return out.select(
        KEY, "phone", "resume_eval", "interview_eval", "summary", "result_llm", "good_fit", "profile",
        "manual_verdict", "justification",
    )


def profile_flow(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, *FLOW_COLUMNS, "result_llm")
    chosen = df.where(lab.not_rejected(lab.normalise_verdict(F.col("result_llm"))))
    return flow.detailed_profiles(flow.profile_rows(chosen), _service(), stub.TEMPLATES)


def manual_review_flow(spark: SparkSession, sf: str) -> DataFrame:
    df = candidates(spark, sf, "job_desc", "resume_text", "company", "result_llm")
    rows = df.where(lab.needs_manual(lab.normalise_verdict(F.col("result_llm"))))
    return flow.manual_review(rows.withColumnRenamed("company", "profile"), _service(), stub.TEMPLATES)


# -- similarity ----------------------------------------------------------------------


def knn_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors closest to the mean of each label."""
    corpus = table(spark, sf, "embeddings")
    out = sim.cosine_topk(sim.centroids(corpus, "label"), corpus, 10)
    return out.select(
        "query_id", "vec_id", F.round("similarity", 6).alias("similarity"), F.col("rank").cast("bigint").alias("rank")
    )


def knn_vote(spark: SparkSession, sf: str) -> DataFrame:
    corpus = table(spark, sf, "embeddings")
    near = sim.cosine_topk(sim.centroids(corpus, "label"), corpus, 5)
    out = sim.vote(near, corpus, "label")
    return out.select("query_id", F.col("label").cast("bigint").alias("label"), "votes")


def hybrid_topk(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark text, with the mean vector of the label of the same number where there
    is one, against all documents, with or without a vector."""
    corpus = table(spark, sf, "embeddings")
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    asked = table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    out = sim.hybrid_topk(sim.centroids(corpus, "label"), asked, corpus, docs, 10)
    return out.select(
        "query_id", "vec_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


def upsert_latest(spark: SparkSession, sf: str) -> DataFrame:
    base = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.lit(0).cast("bigint").alias("version"), F.col("label").cast("string").alias("payload")
    )
    updates = table(spark, sf, "events").select(
        F.col("user_id").alias("id"), (F.col("event_id") + 1).alias("version"), F.col("event_type").alias("payload")
    )
    return sim.upsert_latest(base, updates, "id", "version")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        na_normalise, csv_round_trip, combined_text, title_case, phone_clean, job_title, profile_url, first_name,
        hyperlink, profile_clean, label_clean, reject_map, verdict_norm, label_distribution, distinct_classes,
        empty_verdict_rows, nonblank_text, non_rejected, manual_rows, has_interview, dedup_first, dedup_report,
        stage_funnel, interview_scatter, update_merge, fill_empty, manual_writeback, class_weights_boosted,
        class_weights_train, tokens, stop_filtered, bigrams, vocabulary, tfidf_relational, split_stratified,
        split_plain, split_sequential, softmax_argmax, threshold_verdict, confidence_summary, low_confidence,
        review_queue, confusion_matrix, classification_report, accuracy, weighted_log_loss, ensemble_avg,
        model_agreement, cv_folds, label_drift, ml_features, fit_predict_tfidf_lr, train_output, score_batched, embed_text,
        kmeans5, kmeans_fit, fit_masks, cross_validate, dedup_landed, predict_scorer_flow, predict_all_flow, row_count, column_defaults, render_prompt, guard_missing, error_propagate, parse_decision, parse_justification,
        parse_json_eval, api_errors, wave_map, wave_cache, prompt_multiplicity, eval_flow, profile_flow,
        manual_review_flow, knn_topk, knn_vote, hybrid_topk, upsert_latest,
    )
}
