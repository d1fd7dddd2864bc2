"""The prediction flow: score rows with an empty verdict and fill them in."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import labels as lab, scores as sc, text as tx
from ..operators.model import apply_model, load_model, model_labels
from ..operators.scoring import BATCH, Scorer, score_rows
from ..schema import PREDICT_REQUIRED, TEXT_COL, ensure_columns, rename_in, rename_out, require_columns
from ..sources.tables import read_csv, write_csv

_MASK = "__mask"


def _prepared(df: DataFrame, predict_all: bool) -> tuple[DataFrame, Column]:
    require_columns(df, PREDICT_REQUIRED)
    mask = lab.to_predict(F.col("verdict") if "verdict" in df.columns else None, predict_all)
    df = ensure_columns(df, {"verdict": None})
    return df.withColumn(TEXT_COL, tx.combined_text(F.col("job_desc"), F.col("resume_text"))), mask


def decide(
    scored: DataFrame,
    labels: Sequence[str],
    rules: Sequence[tuple[str, float]] = sc.RULES,
    confidence_threshold: float = 0.0,
) -> DataFrame:
    """Threshold label, confidence and review flag from ``probabilities``.

    A model without probabilities falls back to its hard prediction.
    """
    if "probabilities" not in scored.columns:
        return scored.withColumns(
            {
                "label": F.col("predicted_class"),
                "confidence": F.lit(None).cast("double"),
                "needs_review": F.lit(None).cast("boolean"),
            }
        )
    p = F.col("probabilities")
    return scored.withColumns(
        {
            "label": sc.threshold_label(p, labels, rules),
            "confidence": sc.confidence(p),
            "needs_review": sc.needs_review(sc.confidence(p), confidence_threshold),
        }
    )


def predict(
    df: DataFrame,
    model: PipelineModel,
    predict_all: bool = False,
    confidence_threshold: float = 0.0,
    rules: Sequence[tuple[str, float]] = sc.RULES,
) -> DataFrame:
    """All rows; those under the mask get ``verdict``, ``confidence`` and
    ``needs_review``.

    One pass without a join or a shuffle: the model sees an empty text where the mask is
    off, and what it says there is not used. The columns are the same when there is
    nothing to do; a caller's own columns keep their names and values.
    """
    ready, mask = _prepared(df, predict_all)
    own = {c: f"__own_{c}" for c in ("label", "predicted_class", "probabilities") if c in df.columns}
    ready = ready.withColumn(_MASK, mask).withColumnsRenamed(own)
    asked = ready.withColumn(TEXT_COL, F.when(F.col(_MASK), F.col(TEXT_COL)).otherwise(""))
    scored = decide(apply_model(model, asked), model_labels(model), rules, confidence_threshold)
    return _filled(scored.withColumn("__said", F.col("label").cast("string")), own, df)


def predict_with_scorer(
    df: DataFrame,
    load: Callable[[], Scorer],
    labels: Sequence[str] = lab.LABELS,
    predict_all: bool = False,
    confidence_threshold: float = 0.0,
    batch_size: int = BATCH,
) -> DataFrame:
    """As :func:`predict` with an injected logit scorer and a plain argmax."""
    ready, mask = _prepared(df, predict_all)
    own = {c: f"__own_{c}" for c in ("predicted", "probabilities") if c in df.columns}
    ready = ready.withColumn(_MASK, mask).withColumnsRenamed(own)
    scored = score_rows(ready, TEXT_COL, load, F.col(_MASK), labels, batch_size)
    flagged = scored.withColumn("needs_review", sc.needs_review(F.col("confidence"), confidence_threshold))
    return _filled(flagged.withColumn("__said", F.col("predicted")), own, df)


def _filled(scored: DataFrame, own: Mapping[str, str], df: DataFrame) -> DataFrame:
    """The columns of ``df`` with the verdicts filled in and the scores of masked rows;
    earlier scores are replaced."""
    masked = F.col(_MASK)
    kept = [c for c in df.columns if c not in ("verdict", "confidence", "needs_review")]
    names = [c for c in df.columns if c in kept or c == "verdict"]
    names += [] if "verdict" in names else ["verdict"]
    values = {c: F.col(own.get(c, f"`{c}`")).alias(c) for c in kept}
    values["verdict"] = F.when(masked, F.col("__said")).otherwise(F.col("verdict")).alias("verdict")
    return scored.select(
        *[values[c] for c in names],
        F.when(masked, F.col("confidence")).alias("confidence"),
        F.when(masked, F.col("needs_review")).alias("needs_review"),
    )


def predict_csv(
    spark: SparkSession,
    model_path: str,
    in_csv: str,
    out_csv: str,
    predict_all: bool = False,
    confidence_threshold: float = 0.0,
    headings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Load, score and write; returns the written frame's plan.

    ``headings`` maps the file's headings to the canonical names; the output has the file's.
    """
    model = load_model(spark, model_path)
    headings = headings or {}
    out = predict(rename_in(read_csv(spark, in_csv), headings), model, predict_all, confidence_threshold)
    out = rename_out(out, headings)
    write_csv(out, out_csv, bom=False)
    return out
