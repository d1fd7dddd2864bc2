"""Exact similarity and hybrid search that skips what can't matter.

Stored vectors are filed in cells around centres, and within a cell in rings by their angle
to its centre. By the triangle inequality no vector of a ring lies nearer to a query than
the query's own angle to the centre allows, which bounds the cosine of all its rows. A first
round looks at the rings with the best bounds and finds a score that ``k`` rows reach; a
second one looks at every other ring whose bound reaches that score. Rows skipped can't be
among the ``k`` best, so the result equals that of comparing all pairs.

With texts, postings by term are kept beside the rings, once, and the rows hold no terms. The
texts of a task are cut into segments, whose postings are written where the texts are and
packed, so that no pair of row and term is shuffled. A search takes from them the terms it
asks for, counts these, and meets rows and rings with these terms only.

A query's terms are split at the point that costs least: rows with one of its rare
(essential) terms are found through their postings; a row without one can gain from the
other terms only, so it is found through its ring if that gain on top of the ring's bound
still reaches the score of the first round.

The index is a written table and is searched any number of times. Its centres and rings are
bounded by ``CELLS`` and ``RINGS`` whatever the table holds, so tasks may hold all of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import discard, new_path, settle
from .features import token_slices, with_grams
from .similarity import DECIMALS, KEYWORD_WEIGHT, TOP_K, VECTOR_WEIGHT, query_terms
from .skew import salted_left_join

CELLS = 1_024
RINGS = 64
ROWS_PER_CELL = 400
SAMPLE_PER_CELL = 16
ROUNDS = 5
ROWS_PER_PART = 16_384
QUERIES_AT_ONCE = 4_096
# Rows a query looks at in its first round, and postings it follows there.
FIRST_LOOK = 1_000
FIRST_POSTINGS = 1_000
BUCKETS = 64
# Pairs of row and term a segment of the postings holds, and terms a task of a search asks for at a time.
SEGMENT_TERMS = 4_000_000
ASKED_TERMS = 1_000_000
# Bounds a task that plans, and similarities a task that compares, holds at a time (16 MB of
# doubles), and visits a task passes on at a time.
PLAN_VALUES = 2_000_000
NEAR_VALUES = 2_000_000
VISITS_AT_ONCE = 8_192
# More than rounding of angles and of scores can make up.
SLACK = 1e-6
NO_DIRECTION, NO_VECTOR = -1, -2

GROUP = ("cell", "ring", "part")


def unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def centres_of(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centres by a few rounds of means on the sphere, begun with evenly spaced rows."""
    if not len(sample):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 0))
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        near = (sample @ centres.T).argmax(1)
        total = np.zeros_like(centres)
        np.add.at(total, near, sample)
        moved = np.linalg.norm(total, axis=1) > 1e-9
        centres[moved] = unit(total[moved])
    return centres


@dataclass
class Rings:
    """All groups of rows that share a cell and a ring: size and range of angles."""

    cell: np.ndarray
    ring: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def parts(self) -> np.ndarray:
        return -(-self.rows // ROWS_PER_PART)

    def bounds(self, queries: np.ndarray, centres: np.ndarray) -> np.ndarray:
        """The largest cosine any row of each group can have with each (unit) query."""
        angle = np.arccos(np.clip(queries @ centres.T, -1, 1)) if centres.shape[1] else np.zeros((len(queries), len(centres)))
        own = angle[:, np.maximum(self.cell, 0)]
        least = np.maximum(np.maximum(own - self.high, self.low - own) - SLACK, 0)
        found = np.cos(least) + 2 * 10.0**-DECIMALS
        found[:, self.cell < 0] = 0.0
        found[~queries.any(1)] = 0.0
        return found


@dataclass
class Found:
    """``rows`` (query, row, score, rank) and, per query, the pairs ``looked`` at next to
    the rows ``stored``."""

    rows: DataFrame
    work: DataFrame


class CellIndex:
    """Rows (``row``, vector, text) in cells and rings, as a written table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.rows = spark.read.schema(FILED).parquet(f"{path}/rows")
        made = spark.read.parquet(f"{path}/centres").orderBy("cell").collect()  # at most CELLS
        self.centres = np.array([r["v"] for r in made], np.float64).reshape(len(made), -1)
        rings = spark.read.parquet(f"{path}/rings").orderBy("cell", "ring").collect()  # at most CELLS * RINGS
        take = lambda c, kind: np.array([r[c] for r in rings], kind)
        self.rings = Rings(take("cell", int), take("ring", int), take("n", np.int64), take("low", float), take("high", float))

    # -- building ------------------------------------------------------------------

    @classmethod
    def build(cls, stored: DataFrame, path: str | None = None, cells: int | None = None) -> "CellIndex":
        """``stored`` has ``row`` (long, unique) and ``v`` (numbers of one length, or null); rows
        with a text also its number ``doc`` and its ``segment``, where the terms are. Centres
        come from a sample of ``SAMPLE_PER_CELL`` rows for each; every row is filed."""
        spark = stored.sparkSession
        path = path or new_path(spark, "cells")
        n = stored.where("v is not null").count()
        cells = cells or max(1, min(CELLS, n // ROWS_PER_CELL))
        wanted = cells * SAMPLE_PER_CELL
        share = F.pmod(F.xxhash64("row"), F.lit(max(n, 1))) < wanted
        picked = stored.where("v is not null").where(share).select("row", "v").orderBy("row").collect()
        sample = unit(np.array([r["v"] for r in picked], np.float64).reshape(len(picked), -1 if picked else 0))
        sample = sample[sample.any(1)]
        centres = centres_of(sample, cells)
        spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "cell int, v array<double>").write.parquet(f"{path}/centres")
        texts = [F.col(c) if c in stored.columns else F.lit(None).cast("long").alias(c) for c in TEXT]
        filed = stored.select("row", "v", *texts).mapInArrow(_file(centres), FILED)
        filed = filed.repartition("cell", F.pmod(F.xxhash64("row"), F.lit(8))).sortWithinPartitions("cell", "ring")
        filed.write.partitionBy("cell").parquet(f"{path}/rows")
        kept = spark.read.schema(FILED).parquet(f"{path}/rows")
        rings = kept.groupBy("cell", "ring").agg(F.count(F.lit(1)).alias("n"), F.min("angle").alias("low"), F.max("angle").alias("high"))
        rings.write.parquet(f"{path}/rings")
        return cls(spark, path)

    # -- searching -----------------------------------------------------------------

    def placed(self, rows: DataFrame | None = None) -> DataFrame:
        """The rows with the part of their group."""
        sizes = self.rings.parts()
        parts = self.spark.createDataFrame(
            [(int(c), int(r), int(p)) for c, r, p in zip(self.rings.cell, self.rings.ring, sizes)], "cell int, ring int, parts int"
        )
        rows = self.rows if rows is None else rows
        return rows.join(F.broadcast(parts), ["cell", "ring"]).withColumn("part", _part("row")).drop("parts")

    def _meet(self, visits: DataFrame, asked: DataFrame, held: DataFrame | None, n_queries: int, k: int) -> DataFrame:
        """``(query, row, score)``: the ``k`` best of every visit to a group of rows.

        Only visited cells are read, and a group's rows are repeated once per
        ``QUERIES_AT_ONCE`` queries that visit it. A visit gets its query here, a row its terms
        in the task.
        """
        chunks = max(1, -(-n_queries // QUERIES_AT_ONCE))
        visits = visits.withColumns({"chunk": F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"), "kind": F.lit(2)})
        reached = visits.select(*GROUP, "chunk").distinct()
        cells = [r["cell"] for r in reached.select("cell").distinct().collect()]  # at most CELLS
        rows = self.placed(self.rows.where(F.col("cell").isin(cells)))
        rows = rows.join(reached, list(GROUP)).select(*GROUP, "chunk", "row", "v", "doc").withColumn("kind", F.lit(0))
        if held is not None:
            texts = held.where(F.col("cell").isin(cells)).join(reached, list(GROUP))
            texts = texts.select(*GROUP, "chunk", "doc", "terms").withColumn("kind", F.lit(1))
            rows = rows.unionByName(texts, allowMissingColumns=True)
        asking = visits.join(asked.select("ask", "v", "terms", "idfs"), "ask").drop("ask", "n")
        both = rows.unionByName(asking, allowMissingColumns=True)
        keys = [*GROUP, "chunk"]
        met = both.repartition(*keys).sortWithinPartitions(*keys, "kind")
        return met.mapInArrow(_best(keys, k), "query long, row long, score double")

    def topk(self, queries: DataFrame, k: int = TOP_K, query_id: str = "query_id", vector: str = "embedding") -> Found:
        """The ``k`` stored rows with the largest cosine, ties to the smaller ``row``; vectors
        of length zero score 0, rows and queries without one take no part."""
        none = F.array()
        asked = queries.where(F.col(vector).isNotNull()).select(
            F.col(query_id).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("v"),
            none.cast("array<long>").alias("terms"), none.cast("array<double>").alias("idfs"), none.cast("array<long>").alias("dfs"),
        )
        return self.search(asked, k, 0.0, 1.0)

    def search(self, asked: DataFrame, k: int, keyword_weight: float, vector_weight: float, held: DataFrame | None = None) -> Found:
        """``asked``: query, v, and terms with idfs and dfs, the rarest first; ``held``: the rows
        that hold any of these terms, as :meth:`HybridIndex.held` returns them.

        A pair counts when both have a vector or share a term.
        """
        asked = settle(asked.withColumn("ask", F.monotonically_increasing_id()), "asked")
        n = asked.count()
        plan = _Plan(self.centres, self.rings, k, keyword_weight, vector_weight)
        none = asked.withColumn("reach", F.lit(None).cast("double"))
        first = settle(self._visits(none, plan, held, True), "visits")
        one = self._meet(first, asked, held, n, k)
        ranked = settle(_ranked(one, k), "first-look")
        reach = ranked.where(F.col("rank") == k).select("query", F.col("score").alias("reach"))
        second = settle(self._visits(asked.join(reach, "query", "left"), plan, held, False), "visits")
        two = self._meet(second, asked, held, n, k)
        every = ranked.select("query", "row", "score").unionByName(two).groupBy("query", "row").agg(F.max("score").alias("score"))
        looked = first.unionByName(second).groupBy("query").agg(F.sum("n").alias("looked"))
        stored = int(self.rings.rows.sum())
        work = asked.select("query").join(looked, "query", "left").select(
            "query", F.coalesce("looked", F.lit(0)).alias("looked"), F.lit(stored).cast("long").alias("stored")
        )
        return Found(_ranked(every, k), work)

    def _visits(self, asked: DataFrame, plan: "_Plan", held: DataFrame | None, first: bool) -> DataFrame:
        """The groups each query looks at whole, and single rows (``only``) of other groups
        that hold one of its essential terms."""
        planned = asked.mapInArrow(plan.task(first), VISITS)
        whole = planned.where("essential is null").drop("essential")
        if plan.keyword_weight == 0 or held is None:
            return whole
        planned = settle(planned, "planned")
        whole = planned.where("essential is null").drop("essential")
        by_term = planned.where("essential is not null").select("query", F.explode("essential").alias("term"))
        hits = held.select("row", *GROUP, F.explode("terms").alias("term")).join(by_term, "term").select("query", "row", *GROUP).distinct()
        hits = hits.join(whole.select("query", *GROUP), ["query", *GROUP], "left_anti")
        only = hits.groupBy("query", *GROUP).agg(F.collect_list("row").alias("only"))
        named = only.join(asked.select("query", "ask", "reach"), "query")
        return whole.unionByName(
            named.select("query", "ask", "reach", *GROUP, F.size("only").cast("long").alias("n"), "only", *_weights(plan))
        )


def _weights(plan: "_Plan") -> list:
    return [F.lit(plan.keyword_weight).alias("wk"), F.lit(plan.vector_weight).alias("wv")]


def _part(row: str):
    return F.pmod(F.xxhash64(F.lit("part"), F.col(row)), F.col("parts")).cast("int")


def _bucket(term: str):
    return F.pmod(F.col(term), F.lit(BUCKETS)).cast("int")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# A record holds the rows of a segment, or its terms of a bucket with the places of their rows in the
# segment. ``segment`` is the number of its first text.
ROWS_OF_SEGMENT = -1
POSTINGS = "segment long, rows array<long>, n int, terms binary, counts binary, places binary, bucket int"
PICKED = "segment long, terms array<long>, places array<long>"
HELD = "row long, doc long, cell int, ring int, part int, terms array<long>"
TEXT = ("segment", "doc")
FILED = "row long, v array<double>, segment long, doc long, cell int, ring int, angle double"


def _vectors(column: pa.Array, dims: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, zeros where there is none, and which rows have one."""
    has = column.is_valid().to_numpy(zero_copy_only=False)
    lists = column.filter(pa.array(has))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = len(flat) // len(lists) if len(lists) else dims or 0
    if len(flat) != width * len(lists):
        raise ValueError("vectors of different length")
    out = np.zeros((len(column), width))
    out[has] = unit(flat.reshape(len(lists), width))
    return out, has


def _file(centres: np.ndarray):
    def task(batches):
        for batch in batches:
            v, has = _vectors(batch.column("v"), centres.shape[1])
            cell, angle = np.full(len(v), NO_VECTOR), np.zeros(len(v))
            cell[has] = NO_DIRECTION
            turned = np.flatnonzero(v.any(1)) if v.shape[1] else np.empty(0, int)
            if len(turned):
                near = v[turned] @ centres.T
                cell[turned] = near.argmax(1)
                angle[turned] = np.arccos(np.clip(near.max(1), -1, 1))
            ring = np.minimum((angle * (RINGS / math.pi)).astype(int), RINGS - 1)
            columns = [*(batch.column(c) for c in ("row", "v", *TEXT)), *(pa.array(x) for x in (cell.astype(np.int32), ring.astype(np.int32), angle))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "v", *TEXT, "cell", "ring", "angle"])

    return task


VISITS = (
    "query long, ask long, reach double, cell int, ring int, part int, n long, only array<long>, wk double, wv double, "
    "essential array<long>"
)


class _Plan:
    """Which groups, and which terms' postings, a query looks at in either round."""

    def __init__(self, centres: np.ndarray, rings: Rings, k: int, keyword_weight: float, vector_weight: float):
        self.centres, self.rings, self.k = centres, rings, k
        self.keyword_weight, self.vector_weight = keyword_weight, vector_weight

    def first_look(self, bound: np.ndarray, has: bool) -> np.ndarray:
        """Groups with the best bounds, until they hold ``FIRST_LOOK`` rows."""
        if not has:
            return np.empty(0, int)
        sound = np.flatnonzero(self.rings.cell != NO_VECTOR)
        order = sound[np.argsort(-bound[sound], kind="stable")]
        before = np.cumsum(self.rings.rows[order]) - self.rings.rows[order]
        return order[before < max(FIRST_LOOK, 2 * self.k)]

    def first_terms(self, dfs: np.ndarray) -> int:
        return int((np.cumsum(dfs) <= FIRST_POSTINGS).sum()) if self.keyword_weight else 0

    def second_look(self, bound: np.ndarray, has: bool, idfs: np.ndarray, dfs: np.ndarray, reach: float | None) -> tuple[np.ndarray, int]:
        """(groups, number of essential terms) that together hold every row that can reach
        ``reach``, at the split of the terms that looks at the fewest rows."""
        vectors = self.rings.cell != NO_VECTOR
        gain = np.where(vectors & has, self.vector_weight * bound, 0.0)
        if reach is None:
            return np.arange(len(gain)) if has or len(idfs) else np.empty(0, int), 0
        mass = idfs.sum()
        rest = self.keyword_weight * (1 - np.concatenate([[0.0], np.cumsum(idfs)]) / mass) if mass > 0 else np.zeros(1)
        rest = np.maximum(rest, 0.0)
        rest[-1] = 0.0
        best = None
        for split in range(len(rest)):
            open_ = gain + rest[split] + 2 * 10.0**-DECIMALS >= reach
            if split == len(rest) - 1:
                # No term is left that a pair without two vectors could share.
                open_ &= vectors & has
            cost = int(self.rings.rows[open_].sum()) + int(dfs[:split].sum())
            if best is None or cost < best[0]:
                best = cost, np.flatnonzero(open_), split
        return best[1], best[2]

    def task(self, first: bool):
        def run(batches):
            parts = self.rings.parts()
            names = [f.split()[0] for f in VISITS.split(", ")]
            for batch in batches:
                v, has = _vectors(batch.column("v"), self.centres.shape[1])
                rows = batch.drop_columns(["v"]).to_pylist()
                step = max(1, min(64, PLAN_VALUES // max(1, len(self.rings.cell))))
                for at in range(0, len(rows), step):
                    bounds = self.rings.bounds(v[at : at + step], self.centres)
                    out: dict[str, list] = {n: [] for n in names}
                    for r, bound, own in zip(rows[at : at + step], bounds, has[at : at + step]):
                        idfs, dfs = np.array(r["idfs"], float), np.array(r["dfs"], np.int64)
                        groups, split = self.first_look(bound, own), self.first_terms(dfs)
                        if not first:
                            seen = set(groups.tolist())
                            groups, split = self.second_look(bound, own, idfs, dfs, r["reach"])
                            groups = np.array([g for g in groups.tolist() if g not in seen], int)
                        for piece in self.pieces(r, groups, parts, split):
                            for name, value in zip(out, piece):
                                out[name].append(value)
                            # A query has many visits: a batch of visits is bounded, not one of queries.
                            if len(out["query"]) >= VISITS_AT_ONCE:
                                yield self.packed(out)
                                out = {n: [] for n in names}
                    if out["query"]:
                        yield self.packed(out)

        return run

    def packed(self, out: dict[str, list]) -> pa.RecordBatch:
        types = {"query": pa.int64(), "ask": pa.int64(), "n": pa.int64(), "cell": pa.int32(), "ring": pa.int32(), "part": pa.int32()}
        kinds = types | {c: pa.list_(pa.int64()) for c in ("only", "essential")}
        return pa.RecordBatch.from_arrays([pa.array(x, kinds.get(n, pa.float64())) for n, x in out.items()], names=list(out))

    def pieces(self, r: dict, groups: np.ndarray, parts: np.ndarray, split: int):
        """The visits of one query, in the order of ``VISITS``."""

        def visit(cell, ring, part, n, essential):
            return r["query"], r.get("ask"), r["reach"], cell, ring, part, n, None, self.keyword_weight, self.vector_weight, essential

        for g in groups.tolist():
            # The rows of a group are dealt evenly enough to its parts for the report.
            whole, share = int(self.rings.rows[g]), int(self.rings.rows[g] // parts[g])
            for p in range(int(parts[g])):
                n = share if p else whole - share * int(parts[g] - 1)
                yield visit(int(self.rings.cell[g]), int(self.rings.ring[g]), p, n, None)
        if split:
            yield visit(None, None, None, 0, r["terms"][:split])


def _groups(batches, keys: list[str]):
    mark, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.column_stack([batch.column(k).to_numpy() for k in keys])
        edges = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(1)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            key = tuple(values[a].tolist())
            if key != mark and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            mark = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name)
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _best(keys: list[str], k: int):
    """Score the visits to each group of rows that stand together."""

    def task(batches):
        for group in _groups(batches, keys):
            kinds = group.column("kind")
            rows, texts, visits = (group.filter(pc.equal(kinds, kind)) for kind in range(3))
            if not rows.num_rows or not visits.num_rows:
                continue
            ids = rows.column("row").to_numpy()
            v, has = _vectors(_column(rows, "v"))
            terms, owner = _terms_of(rows, texts)
            order = np.argsort(terms, kind="stable")
            terms, owner = terms[order], owner[order]
            q, q_has = _vectors(_column(visits, "v"), v.shape[1])
            step = max(1, NEAR_VALUES // len(ids))
            asked = visits.select(["query", "terms", "idfs", "only", "reach", "wk", "wv"])
            found: list[tuple] = []
            for i in range(len(q)):
                if i % step == 0:
                    some = q[i : i + step]
                    near = np.round(some @ v.T, DECIMALS) if v.shape[1] and q.shape[1] else np.zeros((len(some), len(ids)))
                    listed = asked.slice(i, step).to_pylist()
                visit = listed[i % step]
                counts, score = has & q_has[i], near[i % step]
                if visit["wk"]:
                    keyword = _keyword(np.array(visit["terms"], np.int64), np.array(visit["idfs"], float), terms, owner, len(ids))
                    counts = counts | (keyword > 0)
                    score = np.round(visit["wk"] * keyword + visit["wv"] * score, DECIMALS)
                if visit["only"] is not None:
                    counts = counts & np.isin(ids, visit["only"])
                if visit["reach"] is not None:
                    counts = counts & (score >= visit["reach"])
                own = np.flatnonzero(counts)
                own = own[np.lexsort((ids[own], -score[own]))[:k]]
                found.append((np.full(len(own), visit["query"]), ids[own], score[own]))
            columns = [pa.array(np.concatenate(c)) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([columns[0].cast(pa.int64()), columns[1].cast(pa.int64()), columns[2]], names=["query", "row", "score"])

    return task


def _terms_of(rows: pa.Table, texts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all rows, and the place of the row of each; ``texts`` has ``doc, terms``."""
    docs, known = _column(rows, "doc"), _column(texts, "doc").to_numpy()
    if not len(known):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(known, kind="stable")
    wanted = docs.fill_null(-1).to_numpy()
    place = order[np.minimum(np.searchsorted(known[order], wanted), len(known) - 1)]
    own = np.flatnonzero(known[place] == wanted)
    lists = _column(texts, "terms").take(pa.array(place[own]))
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(own, lists.value_lengths().to_numpy())


def _keyword(asked: np.ndarray, idfs: np.ndarray, terms: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per row the share of the query's idf mass in the terms it holds; ``terms`` is sorted,
    with the place of the row of each beside it."""
    first, last = np.searchsorted(terms, asked, "left"), np.searchsorted(terms, asked, "right")
    held = last - first
    if not held.sum():
        return np.zeros(n)
    entry = np.repeat(first - (np.cumsum(held) - held), held) + np.arange(held.sum())
    return np.bincount(owner[entry], weights=np.repeat(idfs, held), minlength=n) / idfs.sum()


# -- texts and vectors together --------------------------------------------------------


BUCKET_BITS = BUCKETS.bit_length() - 1


def _turned(terms: np.ndarray) -> np.ndarray:
    """Terms as numbers whose highest bits are the bucket."""
    bits = np.uint64(BUCKET_BITS)
    own = terms.view(np.uint64)
    return (own >> bits) | (own << (np.uint64(64) - bits))


def _turned_back(keys: np.ndarray) -> np.ndarray:
    bits = np.uint64(BUCKET_BITS)
    return ((keys << bits) | (keys >> (np.uint64(64) - bits))).view(np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, byte by byte: the lowest bytes of all, then the next, as far as any reaches."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = np.flatnonzero(planes.any(1))
    return planes[: used[-1] + 1 if len(used) else 0].tobytes()


def unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.zeros((8, n), np.uint8)
    planes[: len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(n)


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``first``, the numbers that follow it, as many as ``sizes`` says, then the next."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def _segments(batches):
    """Texts (``row, terms``) as segments of postings. Terms stand in order and so do the
    places of a term; of both the steps from one to the next are kept."""
    names = [f.split()[0] for f in POSTINGS.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32()]
    first = TaskContext.get().partitionId() << 40
    for part, flat, place in token_slices(batches, 1, SEGMENT_TERMS):
        rows = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
        columns = [pa.array([first]), rows, *(pa.nulls(1, kind) for kind in kinds[2:6]), pa.array([ROWS_OF_SEGMENT], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=names)
        keys = _turned(flat.to_numpy(zero_copy_only=False))
        order = np.argsort(keys, kind="stable")
        keys, place = keys[order], place[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(len(keys), 1), bool), keys[1:] != keys[:-1]]))
        ends = np.append(new[1:], len(keys))
        steps = np.diff(place, prepend=0)
        steps[new] = place[new]
        terms = keys[new]
        edges = np.searchsorted(terms >> np.uint64(64 - BUCKET_BITS), np.arange(BUCKETS + 1, dtype=np.uint64))
        records = []
        for bucket, (a, b) in enumerate(zip(edges, edges[1:])):
            if a < b:
                gaps = np.diff(terms[a:b], prepend=np.uint64(bucket << (64 - BUCKET_BITS)))
                records.append((first, None, b - a, packed(gaps), packed((ends - new)[a:b]), packed(steps[new[a] : ends[b - 1]]), bucket))
        if records:
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*records), kinds)], names=names)
        first += part.num_rows


def _picked(asked: np.ndarray):
    """The pairs of term and place in records of postings whose term is ``asked`` for."""
    asked = np.sort(_turned(asked))

    def pairs(record: dict) -> tuple[np.ndarray, np.ndarray]:
        start = np.uint64(record["bucket"] << (64 - BUCKET_BITS))
        keys = np.cumsum(unpacked(record["terms"], record["n"])) + start
        place = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        own = place[keys[place] == asked]
        counts = unpacked(record["counts"], record["n"]).astype(np.int64)
        ends = np.cumsum(counts)
        steps = unpacked(record["places"], int(ends[-1])).astype(np.int64) if len(own) else np.empty(0, np.int64)
        total, first, sizes = np.cumsum(steps), (ends - counts)[own], counts[own]
        places = total[_runs(first, sizes)] - np.repeat(total[first] - steps[first], sizes)
        return np.repeat(_turned_back(keys[own]), sizes), places

    def as_batch(segments: list[int], found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        offsets = pa.array(np.cumsum([0, *(len(f[0]) for f in found)]), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in zip(*found)]
        return pa.RecordBatch.from_arrays([pa.array(segments, pa.int64()), *lists], names=["segment", "terms", "places"])

    def task(batches):
        for batch in batches:
            segments, found, held = [], [], 0
            for i in range(batch.num_rows):
                record = batch.slice(i, 1).to_pylist()[0]
                some = pairs(record)
                if len(some[0]):
                    segments.append(record["segment"])
                    found.append(some)
                    held += len(some[0])
                if held >= PLAN_VALUES:
                    yield as_batch(segments, found)
                    segments, found, held = [], [], 0
            if found:
                yield as_batch(segments, found)

    return task


def _texts(batches):
    """The rows of each segment with the terms picked from it."""
    for group in _groups(batches, ["segment"]):
        kinds = group.column("kind")
        rows, picks = group.filter(pc.equal(kinds, 0)), group.filter(pc.equal(kinds, 1))
        if not rows.num_rows or not picks.num_rows:
            continue
        place, term = (_column(picks, c).flatten().to_numpy(zero_copy_only=False) for c in ("places", "terms"))
        order = np.argsort(place, kind="stable")
        place, term = place[order], term[order]
        own = rows.column("doc").to_numpy() - group.column("segment")[0].as_py()
        first, last = np.searchsorted(place, own, "left"), np.searchsorted(place, own, "right")
        some = np.flatnonzero(last > first)
        sizes = (last - first)[some]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(term[_runs(first[some], sizes)], pa.int64()))
        names = ["row", "doc", *GROUP]
        kept = rows.select(names).take(pa.array(some))
        yield pa.RecordBatch.from_arrays([*(_column(kept, c) for c in names), lists], names=[*names, "terms"])


class HybridIndex:
    """A cell index over rows with vectors, texts or both, and postings by term."""

    def __init__(self, cells: CellIndex):
        self.cells = cells
        self.postings = cells.spark.read.schema(POSTINGS).parquet(f"{cells.path}/postings")
        self.n_docs = cells.spark.read.parquet(f"{cells.path}/size").head()["n"]

    @classmethod
    def build(
        cls, corpus: DataFrame, docs: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", text: str = "text", path: str | None = None
    ) -> "HybridIndex":
        spark = docs.sparkSession
        path = path or new_path(spark, "cells")
        grams = with_grams(docs.select(vec_id, text), text)
        hashed = F.transform(F.array_distinct("grams"), lambda x: F.xxhash64(x))
        segments = grams.select(F.col(vec_id).cast("long").alias("row"), hashed.alias("terms")).mapInArrow(_segments, POSTINGS)
        segments.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{path}/postings")
        heads = spark.read.schema(POSTINGS).parquet(f"{path}/postings").where(F.col("bucket") == ROWS_OF_SEGMENT)
        texts = heads.select("segment", F.posexplode("rows").alias("place", "row")).select("row", "segment", (F.col("segment") + F.col("place")).alias("doc"))
        vectors = corpus.select(F.col(vec_id).cast("long").alias("row"), F.col(vector).cast("array<double>").alias("v"))
        joined = texts.join(vectors, "row", "full_outer")
        own = new_path(spark, "hybrid-rows")
        joined.write.parquet(own)
        rows = spark.read.schema(joined.schema).parquet(own)
        cells = CellIndex.build(rows, path)
        rows.agg(F.count("doc").alias("n")).write.parquet(f"{path}/size")
        discard(spark, own)  # its rows are in their cells now
        return cls(cells)

    def held(self, terms: DataFrame) -> DataFrame:
        """The rows that hold any ``term`` of ``terms``, their groups, and which of the terms they
        hold. Only their buckets are read, so many at a time that ``ASKED_TERMS`` terms are in
        them: that many go to every task."""
        spark = self.cells.spark
        asked = settle(terms.select("term").distinct().withColumn("bucket", _bucket("term")), "asked-terms")
        turns: list[list[int]] = []
        room = 0
        for bucket, n in asked.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("bucket").collect():  # at most BUCKETS
            if n > room:
                turns.append([])
                room = ASKED_TERMS
            turns[-1].append(bucket)
            room -= n
        picked = spark.createDataFrame([], PICKED)
        for buckets in turns:
            own = asked.where(F.col("bucket").isin(buckets)).select("term").toArrow().column("term").to_numpy()
            read = self.postings.where(F.col("bucket").isin(buckets)).select("segment", "n", "terms", "counts", "places", "bucket")
            picked = picked.unionByName(read.mapInArrow(_picked(own), PICKED))
        rows = self.cells.placed().where("doc is not null").select("segment", "doc", "row", *GROUP).withColumn("kind", F.lit(0))
        both = rows.unionByName(picked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        met = both.repartition("segment").sortWithinPartitions("segment", "kind")
        return settle(met.mapInArrow(_texts, HELD), "held-terms")

    def topk(
        self, queries: DataFrame, asked: DataFrame, k: int = TOP_K, query_id: str = "query_id", vector: str = "embedding", text: str = "text",
        keyword_weight: float = KEYWORD_WEIGHT, vector_weight: float = VECTOR_WEIGHT,
    ) -> Found:
        """As :func:`.similarity.hybrid_topk`: vectors in ``queries``, texts in ``asked``."""
        wanted = query_terms(asked, text, query_id).select(F.col(query_id).cast("long").alias("query"), F.xxhash64("term").alias("term"))
        wanted = settle(wanted, "query-terms")
        held = self.held(wanted)
        frequency = held.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        counted = salted_left_join(wanted, frequency, "term", "query")
        df = F.coalesce("df", F.lit(0))
        idf = F.log((F.lit(1.0) + self.n_docs) / (F.lit(1.0) + df)) + F.lit(1.0)
        entry = F.struct(df.alias("df"), "term", idf.alias("idf"))
        terms = counted.groupBy("query").agg(F.array_sort(F.collect_list(entry)).alias("t"))
        none = F.array()
        both = queries.select(F.col(query_id).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("v")).join(terms, "query", "full_outer")
        questions = both.select(
            "query", "v", F.coalesce("t.term", none.cast("array<long>")).alias("terms"),
            F.coalesce("t.idf", none.cast("array<double>")).alias("idfs"), F.coalesce("t.df", none.cast("array<long>")).alias("dfs"),
        )
        return self.cells.search(questions, k, keyword_weight, vector_weight, held)
