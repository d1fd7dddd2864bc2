"""Batched scoring by an injected Python model or encoder."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import LABELS
from ..functions.scores import argmax, confidence, label_at, softmax

BATCH = 16
#: Characters, or numbers, of one batch, all inputs counted as long as the longest.
BATCH_CHARS = 200_000

# Takes a list of inputs, returns one row of numbers per input.
Scorer = Callable[[Sequence], np.ndarray]


def packed(sizes: Sequence[int], batch_size: int, batch_chars: int) -> Iterator[list[int]]:
    """Places of the inputs, those of like size together, in batches of at most
    ``batch_size`` inputs that take at most ``batch_chars`` when all are padded to the
    longest. An input that is longer by itself is a batch of its own."""
    held: list[int] = []
    for i in np.argsort(np.asarray(sizes), kind="stable").tolist():
        if held and (len(held) == batch_size or (len(held) + 1) * sizes[i] > batch_chars):
            yield held
            held = []
        held.append(i)
    if held:
        yield held


def _size(value) -> int:
    return len(value) if hasattr(value, "__len__") else 1


def batch_scorer(load: Callable[[], Scorer], batch_size: int = BATCH, batch_chars: int = BATCH_CHARS):
    """Column function ``input -> array<double>``.

    ``load`` runs once per task. Only the input column crosses to Python; the
    other columns of the row stay in the JVM. A null input never reaches the model and
    has a null result. Inputs of like length are scored together, so that little of a
    batch is padding and no batch but that of one very long input is over ``batch_chars``
    characters (or numbers); results are in row order. How much Spark hands over at once is
    bounded in bytes by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    """

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for series in batches:
            given = np.flatnonzero(series.notna().to_numpy())
            values = series.iloc[given].tolist()
            rows: list[np.ndarray | None] = [None] * len(series)
            for places in packed([_size(v) for v in values], batch_size, batch_chars):
                done = np.asarray(model([values[i] for i in places]), dtype=np.float64)
                for i, row in zip(given[places], done):
                    rows[i] = row
            yield pd.Series(rows, dtype=object)

    return score


def score_rows(
    df: DataFrame,
    input_col: str,
    load: Callable[[], Scorer],
    mask: Column | None = None,
    labels: Sequence[str] = LABELS,
    batch_size: int = BATCH,
) -> DataFrame:
    """Adds ``probabilities``, ``predicted`` (argmax) and ``confidence``.

    One pass: rows outside ``mask`` go through as nulls, which the model never sees, and
    stay unscored, as do rows whose input is null.
    """
    given = F.col(input_col) if mask is None else F.when(mask, F.col(input_col))
    scored = df.withColumn("__logits", batch_scorer(load, batch_size)(given))
    scored = scored.withColumn("probabilities", softmax(F.col("__logits"))).drop("__logits")
    return scored.withColumns(
        {
            "predicted": label_at(argmax(F.col("probabilities")), labels),
            "confidence": confidence(F.col("probabilities")),
        }
    )


def embed_text(df: DataFrame, text: str, load: Callable[[], Scorer], target: str = "embedding") -> DataFrame:
    """Adds the vector an injected encoder gives for a text column."""
    return df.withColumn(target, batch_scorer(load)(F.col(text)))
