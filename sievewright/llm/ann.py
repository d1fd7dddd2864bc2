"""Approximate nearest neighbours by a forest of random-projection trees (operator 1).

Trees are grown on a bounded sample (``fit_rows``): a node is cut at the median of the
projection on the line between two random points, drawn apart by a few rounds of means.
Every vector is filed in its leaf of every tree. A query walks all trees through one
priority queue, nearest leaf first over all of them, until the leaves taken hold a set
share of the index; the vectors in these leaves are ranked by their exact inner product.

The share is measured, not guessed: sample vectors are searched against the whole sample
by brute force, and the smallest share that reaches ``target`` recall is used. A leaf with
very many vectors, such as copies, is filed in parts. Vectors of unequal length are
extended by one component that makes the largest inner product the nearest vector.

Vectors that are null, zero, of another dimension than most, or hold null or non-finite
components take no part, nor do null ids. Of rows that repeat an id the smallest vector,
component by component, counts. Ties go to the smaller id; fewer candidates than ``k`` are all returned; empty
tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from .common import Shared, map_batches, source_columns

FIT_ROWS = 20_000
TREES = 12
LEAF = 32
TARGET = 0.97
ROWS_PER_TASK = 100_000
ROWS_PER_PART = 20_000
HELD_ANSWERS = 400_000


class Forest:
    """Nodes of all trees in flat arrays; a child below zero is leaf ``-child - 1``."""

    def __init__(self, sample: np.ndarray, reach: float, trees: int = TREES, leaf: int = LEAF, seed: int = 7):
        self.reach = reach
        points = self.extend(sample)
        self.normals: list[np.ndarray] = []
        self.cuts: list[float] = []
        self.children: list[list[int]] = []
        self.roots: list[int] = []
        self.members: list[np.ndarray] = []
        for t in range(trees):
            rng = np.random.default_rng(seed + t)
            self.roots.append(self._grow(points, np.arange(len(points)), leaf, rng))
        self.normals = np.array(self.normals, np.float32).reshape(-1, points.shape[1])
        self.cuts = np.array(self.cuts, np.float32)
        self.leaves = len(self.members)

    def extend(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.reach**2 - (x.astype(np.float64) ** 2).sum(1), 0))
        return np.column_stack([x, rest]).astype(np.float32)

    def _grow(self, points, start, leaf, rng) -> int:
        root = None
        todo = [(start, None, 0)]
        while todo:
            at, parent, side = todo.pop()
            cut = self._cut(points, at, rng) if len(at) > leaf else None
            if cut is None:
                self.members.append(at)
                me = -len(self.members)
            else:
                normal, value, left = cut
                me = len(self.cuts)
                self.normals.append(normal)
                self.cuts.append(value)
                self.children.append([0, 0])
                todo += [(at[left], me, 0), (at[~left], me, 1)]
            if parent is None:
                root = me
            else:
                self.children[parent][side] = me
        return root

    @staticmethod
    def _cut(points, at, rng):
        own = points[at]
        a, b = own[rng.choice(len(at), 2, replace=False)]
        for _ in range(3):
            near = own @ (a - b) > (a @ a - b @ b) / 2
            if near.all() or not near.any():
                break
            a, b = own[near].mean(0), own[~near].mean(0)
        size = np.linalg.norm(a - b)
        if size == 0:
            return None
        normal = (a - b) / size
        value = own @ normal
        cut = np.median(value)
        left = value <= cut
        if left.all():
            left = value < cut
            cut = value[left].max(initial=-np.inf)
        return None if left.all() or not left.any() else (normal, cut, left)

    def file(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector in every tree."""
        points = self.extend(vectors)
        out = np.empty((len(points), len(self.roots)), np.int32)
        for t, root in enumerate(self.roots):
            todo = [(root, np.arange(len(points)))]
            while todo:
                node, at = todo.pop()
                if node < 0:
                    out[at, t] = -node - 1
                elif len(at):
                    left = points[at] @ self.normals[node] <= self.cuts[node]
                    todo += [(self.children[node][0], at[left]), (self.children[node][1], at[~left])]
        return out

    def margins(self, queries: np.ndarray) -> np.ndarray:
        points = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
        return points @ self.normals.T - self.cuts

    def walk(self, margin: list[float]):
        """Leaves of all trees, nearest first, through one queue."""
        queue = [(-np.inf, root) for root in self.roots]
        children, push, pop = self.children, heapq.heappush, heapq.heappop
        heapq.heapify(queue)
        while queue:
            far, node = pop(queue)
            if node < 0:
                yield -node - 1
                continue
            m, (left, right) = margin[node], children[node]
            push(queue, (max(far, m), left))
            push(queue, (max(far, -m), right))

    def needed_share(self, sample: np.ndarray, k: int, target: float, tries: int = 100) -> float:
        """The share of filed vectors to visit for ``target`` recall, by brute force on the sample."""
        rng = np.random.default_rng(1)
        chosen = rng.choice(len(sample), min(tries, len(sample)), replace=False)
        exact = sample[chosen].astype(np.float64) @ sample.T.astype(np.float64)
        exact[np.arange(len(chosen)), chosen] = -np.inf
        k = min(k, len(sample) - 1)
        if k < 1:
            return 1.0
        wanted = np.argpartition(-exact, k - 1, axis=1)[:, :k]
        steps = np.linspace(0.01, 1, 100)
        total = sum(len(m) for m in self.members)
        recall = np.zeros(len(steps))
        for margin, want in zip(self.margins(sample[chosen]).tolist(), wanted):
            first = np.full(len(sample), 2.0)
            seen = 0
            for leaf in self.walk(margin):
                own = self.members[leaf]
                seen += len(own)
                first[own] = np.minimum(first[own], seen / total)
            recall += (first[want][:, None] <= steps).mean(0)
        good = np.flatnonzero(recall / len(chosen) >= target)
        return float(steps[good[0]]) if len(good) else 1.0


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows that take part, without the check of their dimension."""
    v = F.col("vector")
    return source_columns(vectors, id=id_col, vector=vector_col).where(
        F.col("id").isNotNull() & v.isNotNull()
        & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(v, lambda x: x != 0)
    )


def _once(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    fit_rows: int = FIT_ROWS, target: float = TARGET,
) -> DataFrame:
    """Each query's ``k`` nearest of ``vectors`` but its own id: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = usable(vectors, id_col, vector_col)
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max(length).alias("reach"))
    most = sizes.orderBy(F.desc("n"), "dim").head()
    if most is None:
        return empty
    dim, n, reach = most["dim"], most["n"], float(np.sqrt(most["reach"]))
    rows = _once(rows.where(F.size("vector") == dim))
    asked = _once(usable(queries, id_col, vector_col).where(F.size("vector") == dim))
    share = F.lit(min(1.0, fit_rows / n))
    sample = rows.where(F.pmod(F.xxhash64(F.lit("fit"), "id"), F.lit(1 << 30)) < share * F.lit(1 << 30)).orderBy("id")
    picked = sample.select("vector").toPandas()["vector"]  # about fit_rows at most
    if not len(picked):
        picked = rows.select("vector").limit(fit_rows).toPandas()["vector"]
    points = np.stack(picked.to_list())
    forest = Forest(points, reach)
    visit = forest.needed_share(points, k, target)
    forest.members = None
    shared = Shared(spark, forest)

    # Leaves are counted over the whole index; their number is bounded by the sample.
    def count(batches):
        f = shared.value
        total = np.zeros(f.leaves, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(f.file(_matrix(batch.column("vector"), dim)).ravel(), minlength=f.leaves)
        found = np.flatnonzero(total)
        yield {"leaf": found, "n": total[found]}

    counted = map_batches(rows, "leaf int, n long", count).groupBy("leaf").agg(F.sum("n").alias("n")).toPandas()
    held = np.zeros(forest.leaves, np.int64)
    held[counted["leaf"]] = counted["n"]
    parts = np.maximum(-(-held // ROWS_PER_PART), 1)
    first = np.concatenate([[0], np.cumsum(parts)])  # number of a leaf's first part
    filled = np.repeat(held / parts, parts)
    task_of = (np.cumsum(filled) // ROWS_PER_TASK).astype(np.int64)
    tasks = int(task_of[-1]) + 1
    plan = Shared(spark, (held, parts, first, task_of))

    def file(batches):
        f, (_, parts, first, task_of) = shared.value, plan.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.array(batch.column("id").to_pylist(), np.int64)
            leaves = f.file(_matrix(batch.column("vector"), dim))
            part = first[leaves] + own[:, None] % parts[leaves]
            row = np.repeat(np.arange(len(own)), leaves.shape[1])
            yield {
                "task": task_of[part].ravel(), "query": np.zeros(len(row), bool), "id": own[row],
                "vector": batch.column("vector").take(row), "parts": part.reshape(-1, 1).tolist(),
            }

    def ask(batches):
        f, (held, parts, first, task_of) = shared.value, plan.value
        budget = visit * held.sum()
        for batch in batches:
            if not batch.num_rows:
                continue
            out = {"task": [], "query": [], "id": [], "row": [], "parts": []}
            own = _matrix(batch.column("vector"), dim)
            for start in range(0, len(own), 256):
                for i, margin in enumerate(f.margins(own[start : start + 256]).tolist(), start):
                    taken, seen = [], 0
                    for leaf in f.walk(margin):
                        if held[leaf]:
                            taken.append(leaf)
                            seen += held[leaf]
                            if seen >= budget:
                                break
                    wanted = np.concatenate([np.arange(first[x], first[x + 1]) for x in taken])
                    to = task_of[wanted]
                    order = np.argsort(to, kind="stable")
                    edges = np.flatnonzero(np.diff(to[order])) + 1
                    for chunk in np.split(order, edges):
                        out["task"].append(int(to[chunk[0]]))
                        out["row"].append(i)
                        out["parts"].append(wanted[chunk].tolist())
            row = np.array(out["row"])
            yield {
                "task": out["task"], "query": np.ones(len(row), bool), "id": np.array(batch.column("id").to_pylist())[row],
                "vector": batch.column("vector").take(row), "parts": out["parts"],
            }

    kind = rows.schema["vector"].dataType.simpleString()
    schema = f"task int, query boolean, id long, vector {kind}, parts array<int>"
    filed = map_batches(rows.select(F.col("id").cast("long"), "vector"), schema, file)
    asks = map_batches(asked.select(F.col("id").cast("long"), "vector"), schema, ask)
    placed = filed.unionByName(asks).repartitionById(tasks, "task").sortWithinPartitions("query", "id")
    found = map_batches(placed, "query_id long, vec_id long, score double", lambda b: _rerank(b, dim, k))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _rerank(batches, dim: int, k: int):
    """Exact products of each query with the vectors filed under its leaves in this task.

    Filed vectors come first. Answers are kept per query, and passed on when many are held.
    """
    vectors, ids, parts = [], [], []
    index, held = None, 0
    out: list[list] = [[], [], []]
    for batch in batches:
        if not batch.num_rows:
            continue
        query = batch.column("query").to_numpy(zero_copy_only=False)
        own = _matrix(batch.column("vector"), dim).astype(np.float64)
        names = batch.column("id").to_numpy()
        n = int((~query).sum())
        if n:
            vectors.append(own[:n])
            ids.append(names[:n])
            parts.append(batch.column("parts").slice(0, n).flatten().to_numpy())
        if n == len(query) or not vectors:
            continue
        if index is None:
            part = np.concatenate(parts)
            order = np.argsort(part, kind="stable")
            x, name, part = np.concatenate(vectors)[order], np.concatenate(ids)[order], part[order]
            kinds, starts = np.unique(part, return_index=True)
            index = dict(zip(kinds.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(part)])))
        for i, wanted in zip(range(n, len(query)), batch.column("parts").slice(n).to_pylist()):
            spans = [index[p] for p in wanted if p in index]
            if not spans:
                continue
            at = np.concatenate([np.arange(a, b) for a, b in spans])
            # A vector reached through several trees is ranked once.
            who, once = np.unique(name[at], return_index=True)
            score = x[at[once]] @ own[i]
            score[who == names[i]] = -np.inf
            keep = np.arange(len(who))
            if len(who) > k + 1:
                least = np.partition(score, len(score) - k)[len(score) - k]
                keep = np.flatnonzero(score >= least)
            keep = keep[np.lexsort((who[keep], -score[keep]))][:k]
            keep = keep[score[keep] > -np.inf]
            for o, v in zip(out, ([int(names[i])] * len(keep), who[keep].tolist(), score[keep].tolist())):
                o += v
            held += len(keep)
            if held >= HELD_ANSWERS:
                yield {"query_id": out[0], "vec_id": out[1], "score": out[2]}
                out, held = [[], [], []], 0
    yield {"query_id": out[0], "vec_id": out[1], "score": out[2]}
