"""Evaluation tables from true and predicted labels of the closed label set.

Every report is one pass of conditional counts: the table is reduced to a single
row per task before anything is exchanged, whatever the label balance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import LABELS

LEAST_PROBABILITY = 2.2250738585072014e-308  # of normal doubles


def confusion_matrix(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = LABELS, other: str | None = None
) -> DataFrame:
    """One row per true label, one count column per predicted label.

    ``other`` names a column for predictions outside the set, missing ones included, so
    that every row of the table is counted; true labels outside it have rows of their own.
    """
    cells = [F.count_if(F.col(predicted) == p).alias(p) for p in labels]
    if other is not None:
        cells.append(F.count_if(F.coalesce(~F.col(predicted).isin(*labels), F.lit(True))).alias(other))
    return df.groupBy(truth).agg(*cells).orderBy(truth)


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Accuracy next to the share of the most frequent true label, since a
    constant answer already reaches the latter."""
    per_label = df.groupBy(truth).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == F.col(predicted)).alias("hits")
    )
    return per_label.agg(
        F.sum("n").alias("n"),
        (F.sum("hits") / F.sum("n")).alias("accuracy"),
        (F.max("n") / F.sum("n")).alias("majority_baseline"),
    )


def classification_report(
    df: DataFrame, truth: str, predicted: str, labels: Sequence[str] = LABELS
) -> DataFrame:
    """Precision, recall, F1 and support per label, then accuracy, macro and
    weighted averages. Undefined ratios count as zero.

    Labels that occur neither as truth nor as prediction are left out.
    """
    t, p = F.col(truth), F.col(predicted)
    counts = []
    for i, name in enumerate(labels):
        counts += [
            F.count_if((t == name) & (p == name)).alias(f"tp{i}"),
            F.count_if(t == name).alias(f"s{i}"),
            F.count_if(p == name).alias(f"p{i}"),
        ]
    one = df.agg(*counts)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"s{i}").alias("support"),
                F.col(f"p{i}").alias("n_predicted"),
            )
            for i, name in enumerate(labels)
        ]
    )
    per = (
        one.select(F.explode(rows).alias("r"))
        .select("r.*")
        .where((F.col("support") > 0) | (F.col("n_predicted") > 0))
        .select(
            "label",
            _ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
            _ratio(F.col("tp"), F.col("support")).alias("recall"),
            _ratio(2 * F.col("tp"), F.col("support") + F.col("n_predicted")).alias("f1"),
            "support",
            "tp",
        )
    )
    total = F.sum("support")
    measures = ("precision", "recall", "f1")
    macro = [F.avg(m).alias(f"macro_{m}") for m in measures]
    weighted = [_ratio(F.sum(F.col(m) * F.col("support")), total).alias(f"weighted_{m}") for m in measures]
    # ``per`` holds one row per label from here on.
    overall = per.agg(*macro, *weighted, _ratio(F.sum("tp"), total).alias("acc"), total.alias("n")).select(
        F.explode(
            F.array(
                _line("accuracy", [F.col("acc")] * 3),
                _line("macro avg", [F.col(f"macro_{m}") for m in measures]),
                _line("weighted avg", [F.col(f"weighted_{m}") for m in measures]),
            )
        ).alias("r")
    ).select("r.*")
    return per.drop("tp").unionByName(overall)


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _line(label: str, values: Sequence[Column]) -> Column:
    precision, recall, f1 = values
    return F.struct(
        F.lit(label).alias("label"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        F.col("n").alias("support"),
    )


def weighted_log_loss(df: DataFrame, true_probability: Column, weight: Column) -> DataFrame:
    """Weighted cross-entropy ``sum(-w ln p) / sum(w)``.

    A probability that has underflowed to 0 counts as the least positive number, so
    that the worst rows weigh most; rows without a probability don't count at all.
    """
    p = F.greatest(true_probability, F.lit(LEAST_PROBABILITY))
    known = F.when(true_probability.isNotNull(), weight)
    loss = F.sum(-known * F.log(p)) / F.sum(known)
    return df.agg(loss.alias("log_loss"), F.count(F.lit(1)).alias("n"))


def prediction_summary(df: DataFrame, mask: Column, conf: Column, threshold: float = 0.0) -> DataFrame:
    """One row: all rows, scored rows, mean confidence, rows below the threshold."""
    scored = F.when(mask, conf)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(mask).alias("n_predicted"),
        F.avg(scored).alias("mean_confidence"),
        F.count_if(scored < F.lit(threshold)).alias("n_low_confidence"),
    )
