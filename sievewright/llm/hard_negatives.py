"""Hard negatives by segment summaries (operator 13).

Vectors are made whole numbers (``floor(scale * x)``) and scored by their exact inner
product. A vector is cut into segments of ``WIDTH`` components, and the mean and deviation
of each are stored with it; neighbouring segments merge to coarser ones, up to the whole
vector. Over a segment of w components the inner product is w times the product of the
means, plus or minus at most w times the product of the deviations. Summed over the
segments this bounds a score from both sides: pairs whose bounds miss the wanted range, or
the worst score kept so far, are left out, the rest is bounded again by finer segments, and
only what passes the finest is scored.

Anchors and rows are cut into blocks of bounded size and every pair of blocks meets in one
task, anchors of all blocks against all rows: first for the best rows of the anchor's own
label (positives), then, per positive, for the best rows of other labels whose score lies
between ``least`` percent of the positive's and the positive's own. A task passes on a few
rows per anchor, which a ranking merges; no pair is a row otherwise.

Rows with a null id, label or vector or a null or non-finite component take no part, nor do
those whose whole numbers square to 2**62 or more. Rows of different length never meet. Of
rows that repeat an id the one with the smallest label, then vector, counts. Ties go to the
smaller id. Anchors without a positive, and positives without a negative, have no rows; an
empty table gives none. Ids are whole numbers. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle
from .common import map_batches
from .merkle import by_groups

WIDTH = 4
MERGE = 4
ANCHORS_PER_BLOCK = 32_768
ROWS_PER_BLOCK = 16_384
ANCHORS_AT_ONCE = 256
ROWS_AT_ONCE = 8_192
FIRST_ROWS = 512
# Share of pairs still open below which the rest is bounded pair by pair.
FEW = 0.04
EXACT = float(2**53)
LARGEST = float(2**62)


def summaries(whole: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of ``width`` components; the last may be shorter."""
    n, dims = whole.shape
    begins = np.arange(0, dims, width)
    if not len(begins):
        return np.zeros((n, 0)), np.zeros((n, 0))
    sizes = np.diff(np.append(begins, dims))
    mean = np.add.reduceat(whole, begins, axis=1) / sizes
    off = whole - np.repeat(mean, sizes, axis=1)
    return mean, np.sqrt(np.add.reduceat(off * off, begins, axis=1) / sizes)


def merged(mean: np.ndarray, deviation: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summaries of ``MERGE`` neighbouring segments as one."""
    begins = np.arange(0, len(sizes), MERGE)
    total = np.add.reduceat(sizes, begins)
    mid = np.add.reduceat(mean * sizes, begins, axis=1) / total
    square = np.add.reduceat((deviation**2 + mean**2) * sizes, begins, axis=1) / total
    return mid, np.sqrt(np.maximum(square - mid**2, 0)), total


class Side:
    """Vectors of one block with their summaries, coarsest first, scaled so that a bound is
    the sum of two inner products."""

    def __init__(self, table: pa.Table, dims: int):
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        n = len(self.ids)
        whole = np.frombuffer(b"".join(table.column("whole").to_pylist()), np.int32).reshape(n, dims)
        self.whole = whole.astype(np.float64)
        segments = -(-dims // WIDTH)
        mean, deviation = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), np.float64).reshape(n, segments) for c in ("mean", "deviation")
        )
        sizes = np.full(segments, WIDTH)
        if segments:
            sizes[-1] = dims - WIDTH * (segments - 1)
        self.levels = [(mean * np.sqrt(sizes), deviation * np.sqrt(sizes))]
        while len(sizes) > 1:
            mean, deviation, sizes = merged(mean, deviation, sizes)
            self.levels.insert(0, (mean * np.sqrt(sizes), deviation * np.sqrt(sizes)))
        self.norm = float(np.sqrt((self.whole**2).sum(1).max(initial=0)))


def _scores(a: Side, i, b: Side, j) -> np.ndarray:
    """Exact inner products of every anchor in ``i`` with every row in ``j``."""
    if a.norm * b.norm < EXACT:
        return a.whole[i] @ b.whole[j].T
    return a.whole[i].astype(np.int64) @ b.whole[j].astype(np.int64).T


def _pair_scores(a: Side, i, b: Side, j) -> np.ndarray:
    if a.norm * b.norm < EXACT:
        return np.einsum("ij,ij->i", a.whole[i], b.whole[j])
    return np.einsum("ij,ij->i", a.whole[i].astype(np.int64), b.whole[j].astype(np.int64))


@dataclass
class Tally:
    pairs: int = 0
    scored: int = 0


def open_pairs(a: Side, i: np.ndarray, b: Side, j: np.ndarray, low: np.ndarray, high: np.ndarray, tally: Tally):
    """(anchor, row, score) as places in ``i`` and ``j`` of all pairs whose score may lie
    within the anchor's ``low``..``high``, found level by level."""
    # Scores are whole numbers, so this is far more than rounding and far less than a step.
    slack = 1e-3 + 1e-12 * a.norm * b.norm
    least, most = (low - slack)[:, None], (high + slack)[:, None]
    tally.pairs += len(i) * len(j)
    pairs = None
    for level, (mean, deviation) in enumerate(a.levels):
        other_mean, other_deviation = b.levels[level]
        if pairs is None:
            middle, width = mean[i] @ other_mean[j].T, deviation[i] @ other_deviation[j].T
            still = (middle + width >= least) & (middle - width <= most)
            if still.mean() <= FEW:
                pairs = np.nonzero(still)
        else:
            p, q = i[pairs[0]], j[pairs[1]]
            middle = np.einsum("ij,ij->i", mean[p], other_mean[q])
            width = np.einsum("ij,ij->i", deviation[p], other_deviation[q])
            still = (middle + width >= least[pairs[0], 0]) & (middle - width <= most[pairs[0], 0])
            pairs = pairs[0][still], pairs[1][still]
        if pairs is not None and not len(pairs[0]):
            break
    if pairs is None:
        score = _scores(a, i, b, j)
        pairs = np.nonzero(still & (score >= low[:, None]) & (score <= high[:, None]))
        tally.scored += int(still.sum())
        return pairs[0], pairs[1], score[pairs]
    tally.scored += len(pairs[0])
    return *pairs, _pair_scores(a, i[pairs[0]], b, j[pairs[1]])


class Kept:
    """The ``k`` best rows per anchor and range: score down, then id up."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.worst = np.full(low.shape, np.iinfo(np.int64).min)
        empty = np.empty(0, np.int64)
        self.best = [(empty, empty, empty)] * low.shape[1]

    def reach(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What scores can still matter to an anchor, over all its ranges."""
        return np.maximum(self.low[own], self.worst[own]).min(1), self.high[own].max(1)

    def add(self, anchor: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        score = score.astype(np.int64)
        for w in range(self.low.shape[1]):
            fits = (score >= self.low[anchor, w]) & (score <= self.high[anchor, w]) & (score >= self.worst[anchor, w])
            if not fits.any():
                continue
            a, r, s = (np.concatenate([old, new[fits]]) for old, new in zip(self.best[w], (anchor, ids, score)))
            order = np.lexsort((r, -s, a))
            a, r, s = a[order], r[order], s[order]
            begins = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            place = np.arange(len(a)) - np.repeat(begins, np.diff(np.append(begins, len(a))))
            stay = place < self.k
            last = place == self.k - 1
            self.worst[a[last], w] = s[last]
            self.best[w] = a[stay], r[stay], s[stay]


def search(a: Side, low: np.ndarray, high: np.ndarray, b: Side, k: int, same: bool, tally: Tally | None = None) -> Kept:
    """For each anchor and each of its ranges the ``k`` best rows of its own label
    (``same``) or of the others. ``low`` and ``high`` have a column per range."""
    tally = tally or Tally()
    kept = Kept(low, high, k)
    for label in np.unique(a.labels):
        anchors = np.flatnonzero(a.labels == label)
        rows = np.flatnonzero(b.labels == label if same else b.labels != label)
        for at in range(0, len(anchors), ANCHORS_AT_ONCE):
            own = anchors[at : at + ANCHORS_AT_ONCE]
            own = own[(low[own] <= high[own]).any(1)]
            begin, step = 0, FIRST_ROWS
            while len(own) and begin < len(rows):
                some = rows[begin : begin + step]
                i, j, score = open_pairs(a, own, b, some, *kept.reach(own), tally)
                other = a.ids[own[i]] != b.ids[some[j]]
                kept.add(own[i[other]], b.ids[some[j[other]]], score[other])
                begin, step = begin + step, ROWS_AT_ONCE
    return kept


PACKED = "id long, label long, dims int, whole binary, mean binary, deviation binary"


def _pack(scale: float):
    def task(batches):
        for batch in batches:
            out = {n: [] for n in ("id", "label", "dims", "whole", "mean", "deviation")}
            ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
            for key, label, vector in zip(ids, labels, batch.column("v").to_pylist()):
                with np.errstate(over="ignore"):
                    whole = np.floor(scale * np.array(vector, np.float64).reshape(1, -1))
                    fits = (whole**2).sum() < LARGEST
                if fits:
                    mean, deviation = summaries(whole)
                    values = (key, label, whole.shape[1], whole.astype(np.int32).tobytes(), mean.tobytes(), deviation.tobytes())
                    for n, v in zip(out, values):
                        out[n].append(v)
            yield out

    return task


def _meet(asked: DataFrame, stored: DataFrame, k: int, same: bool, n_asked: int, n_stored: int) -> DataFrame:
    """``(query, which, row, score)``: every block of anchors meets every block of rows, and
    each meeting passes on the ``k`` best per anchor and range (``lows``, ``highs``)."""
    a, r = max(1, -(-n_asked // ANCHORS_PER_BLOCK)), max(1, -(-n_stored // ROWS_PER_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumns({"kind": F.lit(0), "asked_block": block(a)}).withColumn("stored_block", each(r))
    right = stored.withColumns({"kind": F.lit(1), "stored_block": block(r)}).withColumn("asked_block", each(a))
    keys = ["dims", "asked_block", "stored_block"]
    met = left.unionByName(right, allowMissingColumns=True).repartition(*keys).sortWithinPartitions(*keys, "kind", "id")

    def task(batches):
        for (dims, _, _), held in by_groups(batches, keys):
            kinds = held.column("kind")
            anchors, rows = held.filter(pc.equal(kinds, 0)), held.filter(pc.equal(kinds, 1))
            if not anchors.num_rows or not rows.num_rows:
                continue
            low, high = _ranges(anchors)
            found = search(Side(anchors, dims), low, high, Side(rows, dims), k, same)
            ids = anchors.column("id").to_numpy()
            for which, (anchor, row, score) in enumerate(found.best):
                yield {"query": ids[anchor], "which": np.full(len(row), which), "row": row, "score": score}

    return map_batches(met, "query long, which int, row long, score long", task)


def _ranges(anchors: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The wanted ranges, a column each; an anchor with fewer has empty ones."""
    lows, highs = anchors.column("lows").to_pylist(), anchors.column("highs").to_pylist()
    width = max(map(len, lows))
    low = np.array([x + [1] * (width - len(x)) for x in lows], np.int64).reshape(-1, width)
    return low, np.array([x + [0] * (width - len(x)) for x in highs], np.int64).reshape(-1, width)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query", "which").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``anchor`` is a condition on a column ``id``. A negative's score is at least ``least``
    percent of the positive's and at most the positive's.
    """
    named = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = named.where("id is not null and label is not null and v is not null").where(finite)
    once = sound.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")
    rows = settle(map_batches(once, PACKED, _pack(scale)), "packed-vectors")
    counts = rows.agg(F.count(F.lit(1)), F.count(F.when(anchor, True))).head()
    n, n_anchors = int(counts[0]), int(counts[1])
    anchors = rows.where(anchor)
    widest = F.lit(2**62)
    open_range = anchors.withColumns({"lows": F.array(-widest), "highs": F.array(widest)})
    found = _ranked(_meet(open_range, rows, positives, True, n_anchors, n), positives)
    positive = settle(
        found.select(F.col("query").alias("id"), (F.col("rank") - 1).alias("which"), F.col("row").alias("positive_id"), "score"),
        "positives",
    )
    # A negative score must satisfy least * p <= 100 * n <= 100 * p, in whole numbers.
    product = F.col("score").cast("decimal(38,0)") * least
    lowest = F.ceil(product / F.lit(100).cast("decimal(38,0)")).cast("long")
    ranges = positive.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("which", lowest.alias("low"), F.col("score").alias("high")))).alias("ranges")
    )
    asked = anchors.join(ranges, "id").withColumns({"lows": F.col("ranges.low"), "highs": F.col("ranges.high")}).drop("ranges")
    negative = _ranked(_meet(asked, rows, negatives, False, n_anchors, n), negatives)
    met = negative.join(positive.withColumnRenamed("score", "positive_score").withColumnRenamed("id", "query"), ["query", "which"])
    return met.select(
        F.col("query").alias("anchor_id"), "positive_id", "rank", F.col("row").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )
