"""Toxicity by class-conditional Kneser-Ney models (operator 10).

A word is read as characters, each given the four before it. Either class has its own
counts of five characters; shorter contexts are shared: their Kneser-Ney counts, of
distinct characters to the left, come from both classes together. So an expression that
one class has never seen is smoothed by the same backoff in both, and only what a class
really has counts for or against it. A word's log-likelihood ratio is the sum over its
characters; a document is described by the length-normalised ratio of the whole text and
by its highest length-normalised ratio in a run of words, and a small logistic
regression, fitted on a bounded sample, turns the two into a score.

Counts cover every labelled row that may be learned from, and are added up by Spark.
Scoring holds them in tables with a row for each distinct run, by 64-bit hash. Null texts are empty; a text without
words scores 0, as nothing speaks against it. Null labels aren't learned from. With no label of one class,
every score is 0. Repeated rows count, and are scored, each time. Extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .common import Shared, ddl, map_batches, map_slices, slices, source_columns
from .quality import labelled_sample, learnable

ORDER = 5
DISCOUNT = 0.75
RUN_WORDS = 8
CALIBRATION_ROWS = 20_000
WORD = re.compile(r"\w+")
START, END = "\x02", "\x03"
SEED = 42  # of Spark's xxhash64


def grams(word: str) -> list[str]:
    padded = START * (ORDER - 1) + word + END
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


def gram_counts(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Counts by class of all runs of five characters in the labelled rows.

    Labels grow with the documents, so they are never broadcast, at any size.
    """
    known = source_columns(labels, id="doc_id", label=label).where(F.col("label").isNotNull() & learnable(F.col("id")))
    rows = source_columns(docs, id="doc_id", text="text").join(known.hint("merge"), "id").select("text", (F.col("label") > 0).alias("toxic"))

    def task(batches):
        held = (Counter(), Counter())
        words = (Counter(), Counter())

        def unfold():
            for own, into in zip(words, held):
                for w, n in own.items():
                    for g in grams(w):
                        into[g] += n
                own.clear()

        def rows():
            both = list(held[0].keys() | held[1].keys())
            out = {"gram": both, "ordinary": [held[0][g] for g in both], "toxic": [held[1][g] for g in both]}
            for own in held:
                own.clear()
            return out

        for batch, texts in slices(batches, "text"):
            for t, toxic in zip(texts, batch.column("toxic").to_pylist()):
                words[toxic].update(WORD.findall(t.lower()))
            unfold()
            if len(held[0]) + len(held[1]) > 2_000_000:
                yield rows()
        yield rows()

    counted = map_batches(rows, "gram string, ordinary long, toxic long", task)
    return counted.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


class Counts:
    """Exact sums by string: sorted 64-bit hashes and a column of sums for each name."""

    def __init__(self, keys: np.ndarray, sums: np.ndarray):
        self.keys, self.sums = keys, sums

    def any(self) -> bool:
        return bool(self.sums.any())

    def get(self, place: int) -> float:
        at = self.keys.searchsorted(place)
        return float(self.sums[at]) if at < len(self.keys) and self.keys[at] == place else 0.0


class KneserNey:
    """Exact counts of runs (``num``), of their contexts (``den``) and of the distinct
    characters after a context (``kinds``)."""

    def __init__(self):
        self.num, self.den, self.kinds = {}, {}, {}
        self.cache: dict[str, float] = {}

    @staticmethod
    def place(x: str) -> np.int64:
        from xxhash import xxh64_intdigest

        digest = xxh64_intdigest(x.encode("utf-8", "replace"), SEED)
        return np.int64(digest - (1 << 64) if digest >> 63 else digest)

    def shared(self, gram: str) -> float:
        """Probability of the last character after the others, from counts of both classes."""
        n = len(gram)
        if n == 0:
            return 1.0 / 2_000
        lower = self.shared(gram[1:])
        context = self.place(gram[:-1])
        total = self.den[n].get(context)
        if not total:
            return lower
        own = self.num[n].get(self.place(gram))
        return (max(own - DISCOUNT, 0) + DISCOUNT * self.kinds[n].get(context) * lower) / total

    def ratio(self, gram: str) -> float:
        """log of toxic over ordinary probability of the last character after the others."""
        found = self.cache.get(gram)
        if found is None:
            if len(self.cache) > 2_000_000:
                self.cache.clear()
            lower = self.shared(gram[1:])
            at, context = self.place(gram), self.place(gram[:-1])
            p = []
            for c in ("toxic", "ordinary"):
                total = self.den[c].get(context)
                own = self.num[c].get(at)
                p.append((max(own - DISCOUNT, 0) + DISCOUNT * self.kinds[c].get(context) * lower) / total if total else lower)
            found = self.cache[gram] = float(np.log(p[0] / p[1])) if min(p) > 0 else 0.0
        return found

    def word(self, word: str) -> float:
        ratio = self.ratio
        return sum([ratio(g) for g in grams(word)])


def _table(df: DataFrame, key: str, **sums) -> dict[str, Counts]:
    """Exact sums by key: a row of the driver for each distinct one."""
    rows = df.groupBy(F.xxhash64(key).alias("at")).agg(*[c.cast("double").alias(n) for n, c in sums.items()]).toArrow()
    keys = rows["at"].to_numpy()
    order = np.argsort(keys)
    keys = keys[order]
    return {n: Counts(keys, rows[n].to_numpy()[order]) for n in sums}


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> KneserNey:
    model = KneserNey()
    top = settle(gram_counts(docs, labels, label), "toxic-grams")
    context = top.withColumn("context", F.expr(f"substring(gram, 1, {ORDER - 1})"))
    num = _table(top, "gram", toxic=F.sum("toxic"), ordinary=F.sum("ordinary"))
    den = _table(
        context, "context", toxic=F.sum("toxic"), ordinary=F.sum("ordinary"),
        toxic_kinds=F.sum((F.col("toxic") > 0).cast("int")), ordinary_kinds=F.sum((F.col("ordinary") > 0).cast("int")),
    )
    for c in ("toxic", "ordinary"):
        model.num[c], model.den[c], model.kinds[c] = num[c], den[c], den[f"{c}_kinds"]
    longer = top.select("gram")
    for n in range(ORDER - 1, 0, -1):
        # One row per distinct longer run: its tail gains one distinct character to the left.
        here = longer.groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("left"))
        model.num[n] = _table(here, "gram", x=F.sum("left"))["x"]
        after = here.withColumn("context", F.expr(f"substring(gram, 1, {n - 1})"))
        both = _table(after, "context", total=F.sum("left"), kinds=F.count("*"))
        model.den[n], model.kinds[n] = both["total"], both["kinds"]
        longer = here.select("gram")
    return model


def describe(model: KneserNey, texts: list[str], cache: dict[str, float]) -> np.ndarray:
    """For each text the mean ratio per word, and the highest mean over a run of words; NaN
    for a text without words."""
    out = np.full((len(texts), 2), np.nan)
    if len(cache) > 1_000_000:
        cache.clear()
    for i, t in enumerate(texts):
        words = WORD.findall(t.lower())
        if not words:
            continue
        found = list(map(cache.get, words))
        for j, f in enumerate(found):
            if f is None:
                found[j] = cache[words[j]] = model.word(words[j])
        sums = np.concatenate([[0.0], np.cumsum(found)])
        run = min(RUN_WORDS, len(words))
        out[i] = sums[-1] / len(words), (sums[run:] - sums[:-run]).max() / RUN_WORDS
    return out


def calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60, ridge: float = 0.1) -> np.ndarray:
    """Weights and bias of a small ridge logistic regression, by damped Newton steps on
    standardised columns, so that classes that don't overlap do no harm."""
    middle, spread = x.mean(0), np.maximum(x.std(0), 1e-9)
    a = np.column_stack([(x - middle) / spread, np.ones(len(x))])
    keep = np.array([ridge] * x.shape[1] + [1e-6])

    def loss(w):
        return np.logaddexp(0, np.where(y > 0, -1, 1) * (a @ w)).sum() + (keep * w * w).sum() / 2

    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -35, 35)))
        slope = a.T @ (p - y) + keep * w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(keep), slope)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    own = w[:-1] / spread
    return np.append(own, w[-1] - own @ middle)


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", calibration_rows: int = CALIBRATION_ROWS) -> DataFrame:
    """All columns of the documents with ``__score``, and ``__mean`` and ``__peak``, the
    two ratios it comes from, as learned from ``labels``."""
    shared = Shared(docs.sparkSession, fit(docs, labels, label))

    def ratios(df: DataFrame) -> DataFrame:
        cache: dict[str, float] = {}

        def work(batch, texts):
            found = describe(shared.value, texts, cache)
            return {n: batch.column(n) for n in batch.schema.names} | {"__mean": found[:, 0], "__peak": found[:, 1]}

        return map_slices(df, "text", f"{ddl(df)}, __mean double, __peak double", work)

    sample = labelled_sample(docs, labels, label, calibration_rows).select("text", (F.col("label") > 0).cast("double").alias("y"))
    known = ratios(sample).select("y", "__mean", "__peak").where(~F.isnan("__mean")).toArrow()  # about calibration_rows at most
    y = known["y"].to_numpy()
    if 0 < y.sum() < len(y):
        w = calibrate(np.column_stack([known["__mean"].to_numpy(), known["__peak"].to_numpy()]), y)
        total = F.col("__mean") * float(w[0]) + F.col("__peak") * float(w[1]) + F.lit(float(w[2]))
        scored = F.nanvl(F.lit(1.0) / (F.lit(1.0) + F.exp(-total)), F.lit(0.0))
    else:
        scored = F.lit(0.0)
    return ratios(docs).withColumn("__score", scored)


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that score below the threshold, as they came."""
    return score(docs, labels).where(F.col("__score") < threshold).select(*docs.columns)
