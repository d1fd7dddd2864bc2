"""Exact similarity search over embeddings, and what is built on it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import settle
from .features import exploded, idf, n_rows, with_grams
from .skew import salted_left_join

TOP_K = 10
DECIMALS = 9
# Numbers (vector positions and terms) a block of queries and a block of stored rows may hold.
BLOCK_VALUES = 2_000_000
CORPUS_VALUES = 1_000_000
# Similarities a task holds at a time (32 MB of doubles).
CHUNK_VALUES = 4_000_000
#: Up to so many distinct query terms are broadcast.
ASKED_TERMS = 1_000_000
KEYWORD_WEIGHT, VECTOR_WEIGHT = 0.3, 0.7


def _top(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best: similarity down, then id up."""
    order = np.lexsort((ids, -sims))[:k]
    return ids[order], sims[order]


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def cosine_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = TOP_K,
    query_id: str = "query_id",
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_values: int = BLOCK_VALUES,
    corpus_values: int = CORPUS_VALUES,
) -> DataFrame:
    """The ``k`` nearest corpus vectors per query: ``(query_id, vec_id, similarity, rank)``.

    Exact at every size; see :func:`_best_of_blocks`. Vectors of length zero have no
    direction and score 0; rows without a vector take no part.
    """
    asked = queries.select(F.col(query_id).cast("long").alias("query"), F.col(vector).cast("array<double>").alias("v"))
    stored = corpus.select(F.col(vec_id).cast("long").alias("row"), F.col(vector).alias("v"))
    found = _best_of_blocks(
        _without_terms(asked).where("v is not null"), _without_terms(stored).where("v is not null"),
        k, 0.0, 1.0, block_values, corpus_values,
    )
    return found.select(
        F.col("query").alias(query_id), F.col("row").alias(vec_id), F.col("score").alias("similarity"), "rank"
    )


def _without_terms(df: DataFrame) -> DataFrame:
    none = F.array()
    return df.withColumns({"terms": none.cast("array<long>"), "idfs": none.cast("array<double>")})


def _in_blocks(df: DataFrame, key: str, values: int) -> tuple[DataFrame, int]:
    """``df`` with a ``block`` of about ``values`` numbers each, and the number of blocks."""
    width = F.coalesce(F.size("v"), F.lit(0)) + F.size("terms")
    total = df.agg(F.sum(F.greatest(width, F.lit(1)))).head()[0] or 0
    blocks = max(1, -(-total // values))
    return df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")), blocks


def _best_of_blocks(
    asked: DataFrame,
    stored: DataFrame,
    k: int,
    keyword_weight: float,
    vector_weight: float,
    block_values: int,
    corpus_values: int,
) -> DataFrame:
    """``(query, row, score, rank)``: the ``k`` best stored rows of every query.

    ``asked`` has ``query, v, terms, idfs`` and ``stored`` has ``row, v, terms``. Both are cut
    into blocks of bounded size, each pair of blocks meets in one task, and a task passes on
    ``k`` rows per query: no pair is ever a row, and neither side goes through the driver. A
    pair counts when both rows have a vector or share a term.
    """
    asked, n_asked = _in_blocks(asked, "query", block_values)
    stored, n_stored = _in_blocks(stored, "row", corpus_values)
    left = asked.withColumnRenamed("block", "asked_block").withColumn(
        "stored_block", F.explode(F.sequence(F.lit(0), F.lit(n_stored - 1)))
    )
    right = stored.withColumnRenamed("block", "stored_block").withColumn(
        "asked_block", F.explode(F.sequence(F.lit(0), F.lit(n_asked - 1)))
    )

    def best(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        return _best_in_block(q, c, k, keyword_weight, vector_weight)

    meeting = ("asked_block", "stored_block")
    found = left.groupBy(*meeting).cogroup(right.groupBy(*meeting)).applyInPandas(
        best, "query long, row long, score double"
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _matrix(vectors: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors, zeros where there is none, and which rows have one."""
    has = vectors.notna().to_numpy()
    width = max((len(v) for v in vectors[has]), default=0)
    out = np.zeros((len(vectors), width))
    if has.any():
        out[has] = _unit(np.array(vectors[has].tolist(), dtype=np.float64))
    return out, has


def _best_in_block(q: pd.DataFrame, c: pd.DataFrame, k: int, keyword_weight: float, vector_weight: float) -> pd.DataFrame:
    columns = {"query": [], "row": [], "score": []}
    if not (len(q) and len(c)):
        return pd.DataFrame(columns)
    qv, q_has = _matrix(q["v"])
    sizes = q["terms"].map(len).to_numpy()
    terms = np.concatenate([np.asarray(t, dtype=np.int64) for t in q["terms"]])
    idfs = np.concatenate([np.asarray(w, dtype=np.float64) for w in q["idfs"]])
    owner = np.repeat(np.arange(len(q)), sizes)
    mass = np.bincount(owner, weights=idfs, minlength=len(q))
    order = np.argsort(terms, kind="stable")
    terms, idfs, owner = terms[order], idfs[order], owner[order]
    empty = np.empty(0, dtype=np.int64), np.empty(0)
    best = [empty] * len(q)
    step = max(1, CHUNK_VALUES // len(q))
    for at in range(0, len(c), step):
        part = c.iloc[at : at + step]
        cv, c_has = _matrix(part["v"])
        ids = part["row"].to_numpy(dtype=np.int64)
        counts = q_has[:, None] & c_has[None, :]
        score = np.zeros(counts.shape)
        if qv.shape[1] and cv.shape[1]:
            score = np.round(qv @ cv.T, DECIMALS)
        if len(terms):
            keyword = _keyword(terms, idfs, owner, mass, part["terms"])
            counts |= keyword > 0
            score = np.round(keyword_weight * keyword + vector_weight * score, DECIMALS)
        for i in np.flatnonzero(counts.any(axis=1)):
            own = counts[i]
            best[i] = _top(np.concatenate([best[i][0], ids[own]]), np.concatenate([best[i][1], score[i, own]]), k)
    numbers = q["query"].to_numpy(dtype=np.int64)
    return pd.DataFrame(
        {
            "query": np.repeat(numbers, [len(b[0]) for b in best]),
            "row": np.concatenate([b[0] for b in best]),
            "score": np.concatenate([b[1] for b in best]),
        }
    )


def _keyword(terms: np.ndarray, idfs: np.ndarray, owner: np.ndarray, mass: np.ndarray, rows: pd.Series) -> np.ndarray:
    """Per (query, row) the share of the query's idf mass in the terms both have.

    ``terms`` is sorted, with the weight and the query of each entry beside it.
    """
    place = np.repeat(np.arange(len(rows)), rows.map(len).to_numpy())
    held = np.concatenate([np.asarray(t, dtype=np.int64) for t in rows])
    first, last = np.searchsorted(terms, held, "left"), np.searchsorted(terms, held, "right")
    n = last - first
    entry = np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else n
    cell = owner[entry] * len(rows) + np.repeat(place, n)
    total = np.bincount(cell, weights=idfs[entry], minlength=len(mass) * len(rows)).reshape(len(mass), len(rows))
    return np.divide(total, mass[:, None], out=np.zeros(total.shape), where=mass[:, None] > 0)


def centroids(corpus: DataFrame, label: str, vector: str = "embedding", query_id: str = "query_id") -> DataFrame:
    """Mean vector per label as query rows.

    The vectors are averaged position by position; a label that holds most of the
    table still reduces to one row per position in each task.
    """
    return (
        corpus.select(label, F.posexplode_outer(vector).alias("pos", "x"))
        .where(F.col("pos").isNotNull())
        .groupBy(label, "pos")
        .agg(F.avg(F.col("x").cast("double")).alias("x"))
        .groupBy(label)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("__v"))
        .select(F.col(label).cast("long").alias(query_id), F.col("__v.x").alias(vector))
    )


def vote(
    neighbours: DataFrame,
    labels: DataFrame,
    label: str,
    weighted: bool = False,
    query_id: str = "query_id",
    vec_id: str = "vec_id",
) -> DataFrame:
    """Label most of a query's neighbours carry, by count or by summed similarity;
    ties go to the other measure, then to the smaller label.

    ``neighbours`` holds ``k`` rows per query, whatever the corpus holds.
    """
    tagged = neighbours.join(labels.select(vec_id, label), vec_id)
    votes = tagged.groupBy(query_id, label).agg(
        F.count(F.lit(1)).alias("votes"), F.round(F.sum("similarity"), 6).alias("weight")
    )
    measures = ("weight", "votes") if weighted else ("votes", "weight")
    first = Window.partitionBy(query_id).orderBy(*[F.desc(m) for m in measures], label)
    return votes.withColumn("__rank", F.row_number().over(first)).where(F.col("__rank") == 1).drop("__rank")


def query_terms(asked: DataFrame, text: str = "text", query_id: str = "query_id") -> DataFrame:
    """Distinct grams of each query text: ``(query_id, term)``."""
    grams = with_grams(asked.select(query_id, text), text)
    return exploded(grams.withColumn("grams", F.array_distinct("grams")), query_id)


def weighted_terms(
    docs: DataFrame, terms: DataFrame, key: str = "vec_id", text: str = "text", query_id: str = "query_id"
) -> DataFrame:
    """``(query_id, term, idf)``: the query terms with their idf over ``docs``.

    Documents are counted per term, combined in each task before the shuffle; a term that
    very many queries share is dealt to parts. Only terms that are asked for are counted: up
    to ``ASKED_TERMS`` of them go to every task, which drops the others where it finds them.
    """
    grams = with_grams(docs.select(key, text), text)
    once = exploded(grams.withColumn("grams", F.array_distinct("grams")), key)
    wanted = terms.select("term").distinct()
    if wanted.limit(ASKED_TERMS + 1).count() <= ASKED_TERMS:
        once = once.join(F.broadcast(wanted), "term", "left_semi")
    frequency = once.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    counted = salted_left_join(terms.select(query_id, "term"), frequency, "term", query_id)
    return counted.select(query_id, "term", idf(F.coalesce("df", F.lit(0)), n_rows(docs, key)).alias("idf"))


def hybrid_topk(
    queries: DataFrame,
    asked: DataFrame,
    corpus: DataFrame,
    docs: DataFrame,
    k: int = TOP_K,
    query_id: str = "query_id",
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block_values: int = BLOCK_VALUES,
    corpus_values: int = CORPUS_VALUES,
) -> DataFrame:
    """Exact top ``k`` per query of the weighted keyword and vector score:
    ``(query_id, vec_id, score, rank)``.

    The keyword score is the idf mass of the terms a row shares with the query over that of
    all terms of the query. A document or query without a vector scores by its keywords
    alone, one without a shared term by its vector alone. Both scores of a pair are taken
    in the task where their blocks meet. Terms travel as 64-bit hashes.
    """
    weighted = settle(weighted_terms(docs, query_terms(asked, query_id=query_id), vec_id, query_id=query_id), "terms")
    per_query = weighted.groupBy(query_id).agg(
        F.collect_list(F.xxhash64("term")).alias("terms"), F.collect_list("idf").alias("idfs")
    )
    none = F.array()
    questions = (
        queries.select(query_id, F.col(vector).cast("array<double>").alias("v"))
        .join(per_query, query_id, "full_outer")
        .select(
            F.col(query_id).cast("long").alias("query"), "v",
            F.coalesce("terms", none.cast("array<long>")).alias("terms"),
            F.coalesce("idfs", none.cast("array<double>")).alias("idfs"),
        )
    )
    grams = with_grams(docs.select(vec_id, "text"), "text")
    hashed = F.transform(F.array_distinct("grams"), lambda x: F.xxhash64(x))
    rows = (
        grams.select(vec_id, hashed.alias("terms"))
        .join(corpus.select(vec_id, F.col(vector).alias("v")), vec_id, "full_outer")
        .select(F.col(vec_id).cast("long").alias("row"), "v", F.coalesce("terms", none.cast("array<long>")).alias("terms"))
    )
    found = _best_of_blocks(
        settle(questions, "questions"), settle(rows, "rows"), k, KEYWORD_WEIGHT, VECTOR_WEIGHT, block_values, corpus_values
    )
    return found.select(F.col("query").alias(query_id), F.col("row").alias(vec_id), "score", "rank")


def hybrid_score(keyword: Column, vector: Column, keyword_weight: float = KEYWORD_WEIGHT, vector_weight: float = VECTOR_WEIGHT) -> Column:
    """Weighted sum of the two scores; an absent one counts as zero."""
    zero = F.lit(0.0)
    return F.lit(keyword_weight) * F.coalesce(keyword, zero) + F.lit(vector_weight) * F.coalesce(vector, zero)


def top_k(df: DataFrame, group: str, score: str, tie: str, k: int = TOP_K) -> DataFrame:
    """Best ``k`` rows per group. Tasks keep ``k`` rows per group before the exchange."""
    best = Window.partitionBy(group).orderBy(F.desc(score), tie)
    return df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def upsert_latest(base: DataFrame, updates: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key: the one with the highest version over both tables.

    A maximum over the whole row combines before the shuffle, so an id with very
    many updates costs one row per task. ``version`` is unique within a key.
    """
    both = base.unionByName(updates)
    rest = [c for c in both.columns if c not in (key, version)]
    newest = both.groupBy(key).agg(F.max_by(F.struct(version, *rest), F.col(version)).alias("__r"))
    return newest.select(key, "__r.*").select(*both.columns)
