"""Quality classifier (operator 7): logistic regression on hashed word n-grams.

Weights are learned by follow-the-regularised-leader updates, one document at a time, in
several shards whose states are averaged after each pass. A score is the sparse dot
product of the weights with the document's distinct hashed words and word pairs, each of
the value one over the root of their number.

The fit uses at most about ``fit_rows`` labelled rows (a documented bound, drawn by a hash
of the id); every document is scored over its whole text. Null texts are empty; an empty
text scores as the bias says. Rows without a label, or with a null one, aren't learned
from. If no row can be learned from, every score is 0.5. A label that repeats counts each
time; repeated documents each give a row. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import settle
from .common import Shared, map_batches, map_slices, mix, source_columns, word_hashes

FIT_ROWS = 20_000
BITS = 18
WORD = re.compile(r"\w+|[^\w\s]+")


def features(words: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distinct hashed words and word pairs of a document given its words' hashes."""
    if not len(words):
        return np.empty(0, np.int64)
    pairs = mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:])
    return np.unique(np.concatenate([mix(words), pairs]) & np.uint64((1 << bits) - 1)).astype(np.int64)


class Ftrl:
    """State of the updates: sums of corrected gradients and of their squares."""

    def __init__(self, bits: int = BITS, alpha: float = 20.0, beta: float = 1.0, l1: float = 0.01, l2: float = 1e-4):
        size = (1 << bits) + 1  # the last one is the bias
        self.z, self.n = np.zeros(size), np.zeros(size)
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: float) -> None:
        at = np.append(at, len(self.z) - 1)
        value = np.full(len(at), 1 / np.sqrt(max(len(at) - 1, 1)))
        value[-1] = 1.0
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        square = g * g
        self.z[at] += g - (np.sqrt(self.n[at] + square) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] += square


def learnable(doc_id: Column) -> Column:
    """Rows whose labels may be learned from; the rest is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5, F.lit(1)) != 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(id, text, label) of about ``bound`` learnable labelled rows at most, by hash of id.

    The bounded table of labels is what meets the documents, so no text is shuffled.
    """
    known = source_columns(labels, id="doc_id", label=label).where(
        F.col("label").isNotNull() & F.col("id").isNotNull() & learnable(F.col("id"))
    )
    n = known.count()
    if n > bound:
        known = known.where(F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 30)) < F.lit(int((1 << 30) * bound / n)))
    return source_columns(docs, id="doc_id", text="text").join(F.broadcast(known), "id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = FIT_ROWS, shards: int = 4, passes: int = 3) -> np.ndarray:
    """The weights. What reaches the driver is ``shards`` states of fixed size a pass."""
    spark = docs.sparkSession
    cache: dict[str, bytes] = {}

    def work(batch, texts):
        return {
            "id": batch.column("id"),
            "label": batch.column("label"),
            "at": [features(word_hashes(WORD.findall(t.lower()), cache)) for t in texts],
        }

    sample = labelled_sample(docs, labels, label, fit_rows).withColumn("label", F.col("label").cast("double"))
    kind = sample.schema["id"].dataType.simpleString()
    rows = settle(map_slices(sample, "text", f"id {kind}, label double, at array<long>", work), "quality-fit")
    order = F.xxhash64(F.lit("order"), "id", "at")
    dealt = rows.select(F.pmod(order, F.lit(shards)).cast("int").alias("shard"), order.alias("o"), "label", "at")
    state = Ftrl()
    for _ in range(passes):
        shared = Shared(spark, (state.z, state.n))

        def task(batches, shared=shared):
            own, seen = Ftrl(), 0
            own.z, own.n = (x.copy() for x in shared.value)
            for batch in batches:
                for at, y in zip(batch.column("at"), batch.column("label").to_pylist()):
                    own.learn(at.values.to_numpy(zero_copy_only=False), y)
                    seen += 1
            if seen:
                yield {"z": [own.z.tobytes()], "n": [own.n.tobytes()], "seen": [seen]}

        placed = dealt.repartitionById(shards, "shard").sortWithinPartitions("o", "label")
        states = map_batches(placed, "z binary, n binary, seen long", task).collect()
        if not states:
            return np.zeros(len(state.z))
        total = sum(s.seen for s in states)
        state.z = sum(np.frombuffer(s.z) * (s.seen / total) for s in states)
        state.n = sum(np.frombuffer(s.n) * (s.seen / total) for s in states)
    return state.weights()


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and ``score`` of every document."""
    shared = Shared(docs.sparkSession, weights.astype(np.float32))
    cache: dict[str, bytes] = {}

    def work(batch, texts):
        w = shared.value
        out = []
        for t in texts:
            at = features(word_hashes(WORD.findall(t.lower()), cache))
            total = float(w[at].sum(dtype=np.float64)) / np.sqrt(max(len(at), 1)) + float(w[-1])
            out.append(1 / (1 + np.exp(-np.clip(total, -35, 35))))
        return {"doc_id": batch.column("doc_id"), "score": out}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_slices(source_columns(docs, doc_id="doc_id", text="text"), "text", f"doc_id {kind}, score double", work)
