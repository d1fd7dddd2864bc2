"""Comparing models and watching label distributions over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import LABELS
from ..functions.scores import argmax, label_at, weighted_mean


def ensemble(
    df: DataFrame, vectors: Sequence[str], weights: Sequence[float], labels: Sequence[str] = LABELS
) -> DataFrame:
    """Adds the weighted mean ``p`` of probability columns and its label."""
    mean = weighted_mean([F.col(v) for v in vectors], weights)
    out = df.withColumn("ensemble_p", mean)
    return out.withColumn("ensemble_label", label_at(argmax(F.col("ensemble_p")), labels))


def majority_vote(columns: Sequence[str], labels: Sequence[str] = LABELS) -> Column:
    """Label most columns name; ties go to the first label of the set."""
    counts = F.array(
        *[sum((F.when(F.col(c) == x, 1).otherwise(0) for c in columns), F.lit(0)) for x in labels]
    )
    return label_at(argmax(counts), labels)


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cross table of two label columns with each cell's share of all rows.

    The window runs over the cells, at most one per pair of labels.
    """
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy()
    agree = F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).over(every)
    return cells.select(
        a,
        b,
        "n",
        (F.col("n") / F.sum("n").over(every)).alias("share"),
        (agree / F.sum("n").over(every)).alias("agreement_rate"),
    )


def review_queue(df: DataFrame, key: str, conf: str, threshold: float) -> DataFrame:
    """Scored rows below the confidence threshold, least certain first."""
    return df.where(F.col(conf) < F.lit(threshold)).orderBy(conf, key)


def label_drift(df: DataFrame, period: str, label: str, labels: Sequence[str]) -> DataFrame:
    """Population stability index of each period against the first one and against
    the period before.

    Counts per period and label come from one pass with partial aggregation; the
    windows run over one row per period. A share of zero is held at 1e-6. All labels
    outside the list, and missing ones, share one bucket of their own.
    """
    own = F.col(label)
    counts = [F.count_if(own == x).alias(f"c{i}") for i, x in enumerate(labels)]
    counts.append(F.count_if(F.coalesce(~own.isin(*labels), F.lit(True))).alias(f"c{len(labels)}"))
    table = df.groupBy(period).agg(F.count(F.lit(1)).alias("n"), *counts)
    shares = table.select(
        period,
        "n",
        *[F.greatest(F.col(f"c{i}") / F.col("n"), F.lit(1e-6)).alias(f"s{i}") for i in range(len(labels) + 1)],
    )
    order = Window.orderBy(period)
    first = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def psi(reference) -> Column:
        total = F.lit(0.0)
        for i in range(len(labels) + 1):
            ref = reference(F.col(f"s{i}"))
            total = total + (F.col(f"s{i}") - ref) * F.log(F.col(f"s{i}") / ref)
        return total

    return shares.select(
        period,
        "n",
        psi(lambda c: F.first(c).over(first)).alias("psi_baseline"),
        psi(lambda c: F.lag(c).over(order)).alias("psi_previous"),
    )
