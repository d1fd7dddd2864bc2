"""Similarity join of documents on word n-grams by chosen paths (operator 9).

A document is the set of its runs of five words (lower case, split at white space); one
of fewer words is a single run. Equal sets are collapsed to one first. Each set is drawn
as ``TOKENS`` min-hash tokens, and similar sets share most of them. In every repetition a
set follows one path: the bucket it is in says which of its tokens is read, and the token
says the next bucket, so sets stay together just as far as they share the sampled tokens.
A bucket is split on, down to ``DEPTH`` tokens, while it holds more than ``SMALL`` sets;
small ones are compared by brute force, in blocks if a deepest one is still large.
Repetitions are as many as the target recall asks for a pair that is just similar enough,
on average over the number of tokens it shares, as all repetitions read the same tokens.

In a bucket a pair is looked at in the first repetition that brings it together, so no
pair is counted twice and none has to be written down. Pairs whose min-hash sketches could
come from similar sets are compared on their whole sets, exactly. What leaves a bucket is,
for each set, its number of links and one root it is linked to, never its pairs; classes
are the connected components of these roots.

Null texts and texts without words have no runs and no links; each is its own class. Rows
with a null id have a null class and no links. Rows that repeat an id each give a row.
Empty tables give none. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import settle, written
from .common import map_batches, map_slices, mix, shingle_hashes, source_columns, words_by_text
from .components import connected

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.999
TOKENS = 64
DEPTH = 4
SMALL = 64
BLOCK = 512
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """The distinct hashed runs of a text's hashed words, sorted."""
    return np.unique(shingle_hashes(words, min(k, len(words)))) if len(words) else words


def set_key(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def min_hashes(sets: list[np.ndarray], tokens: int = TOKENS) -> np.ndarray:
    """``tokens`` min-hash values of each non-empty set."""
    rng = np.random.default_rng(11)
    factors = rng.integers(1, 1 << 63, tokens, dtype=np.uint64) | np.uint64(1)
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), tokens), np.uint64)
    for i, factor in enumerate(factors):
        x = flat * factor
        out[:, i] = np.minimum.reduceat(x ^ (x >> np.uint64(32)), starts)
    return out


def paths(hashed: np.ndarray, repetitions: int, depth: int = DEPTH) -> np.ndarray:
    """Per set, repetition and depth the bucket that its path has reached."""
    n, tokens = hashed.shape
    out = np.empty((n, repetitions, depth), np.int64)
    for r in range(repetitions):
        at = np.full(n, mix(np.array([r + 1], np.uint64))[0])
        for d in range(depth):
            token = hashed[np.arange(n), (at % np.uint64(tokens)).astype(np.int64)]
            at = mix(at * GOLDEN + token)
            out[:, r, d] = at.view(np.int64)
    return out


def sketch_floor(similarity: float, tokens: int = TOKENS) -> int:
    """Equal sketch bytes that a pair of this similarity falls below once in some thousands."""
    return math.floor(tokens * similarity - 3.5 * math.sqrt(tokens * similarity * (1 - similarity)))


def path_recall(similarity: float, repetitions: int, depth: int = DEPTH, tokens: int = TOKENS) -> float:
    """Chance that a pair of this similarity stays together in some repetition, over the
    binomial number of tokens it shares."""
    p = similarity
    shares = [(math.comb(tokens, m) * p**m * (1 - p) ** (tokens - m), m / tokens) for m in range(tokens + 1)]
    return sum(chance * (1 - (1 - x**depth) ** repetitions) for chance, x in shares)


def repetitions_for(similarity: float, recall: float, depth: int = DEPTH) -> int:
    n = math.ceil(math.log(1 - recall) / math.log(1 - similarity**depth))
    while path_recall(similarity, n, depth) < recall:
        n += 1
    return n


def near_copies(
    docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: its ``class_id`` (the smallest id in the class), ``copies``
    (documents with the same set of runs, itself included) and ``links`` (other sets that
    are similar enough). ``text_hash`` tells rows that repeat an id apart."""
    repetitions = repetitions_for(similarity, recall)
    texts = source_columns(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def drawn(batch, own_texts):
        sets = [shingles(w) for w in words_by_text(own_texts)]
        full = [i for i, s in enumerate(sets) if len(s)]
        key, sketch, path = [None] * len(sets), [None] * len(sets), [None] * len(sets)
        if full:
            hashed = min_hashes([sets[i] for i in full])
            small = (hashed >> np.uint64(24)).astype(np.uint8)
            walked = paths(hashed, repetitions).reshape(len(full), -1)
            for j, i in enumerate(full):
                key[i], sketch[i], path[i] = set_key(sets[i]), small[j].tobytes(), walked[j].tobytes()
        return {"id": batch.column("id"), "text_hash": batch.column("text_hash"), "key": key, "sketch": sketch, "path": path}

    told = texts.withColumn("text_hash", F.xxhash64("text"))
    rows = settle(map_slices(told, "text", f"id {kind}, text_hash long, key binary, sketch binary, path binary", drawn), "sets")
    named = rows.where("key is not null and id is not null")
    distinct = settle(
        named.groupBy("key").agg(
            F.min("id").alias("id"), F.count("*").alias("copies"), F.min("sketch").alias("sketch"), F.min("path").alias("path")
        ),
        "distinct-sets",
    )
    leaves = _leaves(distinct, repetitions)
    flagged = _candidates(distinct, leaves, repetitions, similarity)
    found = settle(_verified(texts, flagged, repetitions, similarity), "links")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = connected(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    known = distinct.select("key", "id", "copies").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    classes = known.groupBy("root").agg(F.min("id").alias("class_id"))
    per_key = known.join(classes, "root").join(links, "key", "left")
    per_key = per_key.select("key", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    one = F.when(F.col("id").isNotNull(), F.lit(1)).otherwise(0).cast("long")
    return (
        rows.select("id", "text_hash", F.when(F.col("id").isNotNull(), F.col("key")).alias("key")).join(per_key, "key", "left").select(
            F.col("id").alias(id_col),
            F.coalesce("class_id", "id").alias("class_id"),
            F.coalesce("copies", one).alias("copies"),
            F.coalesce("links", F.lit(0)).cast("long").alias("links"),
            "text_hash",
        )
    )


def _leaves(distinct: DataFrame, repetitions: int) -> DataFrame:
    """(key, r, leaf, n): the bucket each set ends in per repetition, if not alone there.

    One round per depth; each meets only the sets of buckets that were still too large.
    """

    def unfolded(batches):
        for batch in batches:
            raw = b"".join(batch.column("path").to_pylist())
            path = np.frombuffer(raw, np.int64).reshape(-1, DEPTH)
            row = np.repeat(np.arange(batch.num_rows), repetitions)
            yield {
                "key": batch.column("key").take(row), "r": np.tile(np.arange(repetitions), batch.num_rows),
                "leaf": path[:, 0], "rest": [p.tolist() for p in path[:, 1:]],
            }

    alive = map_batches(distinct.select("key", "path"), "key binary, r int, leaf long, rest array<long>", unfolded)
    done = None
    rows = distinct.count() * repetitions
    for depth in range(1, DEPTH + 1):
        sizes = alive.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1")
        met = written(alive.join(sizes, "leaf").select("key", "r", "leaf", "rest", "n"), rows, "paths")
        ends = (F.col("n") <= SMALL) | F.lit(depth == DEPTH)
        leaf = met.where(ends).select("key", "r", "leaf", "n")
        done = leaf if done is None else done.unionByName(leaf)
        if depth < DEPTH:
            rows = met.where(~ends).count()
            alive = met.where(~ends).select("key", "r", F.get("rest", F.lit(0)).alias("leaf"), F.expr("slice(rest, 2, size(rest))").alias("rest"))
    return done


def _blocks(rows: DataFrame) -> DataFrame:
    """Deal rows of (leaf, n, key) to pairs of blocks: one for a small leaf."""
    n = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    dealt = rows.withColumn("own", F.pmod(F.xxhash64("key"), n).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
    return dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("other", "n")


def _grouped(batches, columns: list[str]):
    """Rows of equal (leaf, low, high), which stand together, as lists by column."""
    held, now = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(c).to_pylist() for c in ("leaf", "low", "high")]))
        edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
        values = {c: batch.column(c).to_pylist() for c in columns}
        for a, b in zip(edges, edges[1:]):
            if keys[a] != now:
                if held is not None:
                    yield now, held
                now, held = keys[a], {c: [] for c in columns}
            for c in columns:
                held[c] += values[c][a:b]
    if held is not None:
        yield now, held


def _pairs(held: dict, now: tuple, repetitions: int, floor: int):
    """Blocks of (row numbers, row numbers, which of the pairs to look at)."""
    own = np.array(held["own"])
    _, low, high = now
    all_paths = np.frombuffer(b"".join(held["leaves"]), np.int64).reshape(-1, repetitions)
    all_sketches = np.frombuffer(b"".join(held["sketch"]), np.uint8).reshape(-1, TOKENS)
    r = held["r"][0]
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    for start in range(0, len(left), 128):
        a = left[start : start + 128]
        look = (all_sketches[a][:, None, :] == all_sketches[right][None, :, :]).sum(2) >= floor
        for earlier in range(r):
            x, y = all_paths[a, earlier], all_paths[right, earlier]
            look &= ~((x[:, None] == y[None, :]) & (x != 0)[:, None])
        if low == high:
            look &= a[:, None] < right[None, :]
        if look.any():
            yield a, right, look


def _candidates(distinct: DataFrame, leaves: DataFrame, repetitions: int, similarity: float) -> DataFrame:
    """Rows of sets that have a possible partner, per pair of blocks of a leaf."""
    floor = sketch_floor(similarity)
    entry = F.struct("r", "leaf", "n")
    walked = leaves.groupBy("key").agg(F.collect_list(entry).alias("ends"))  # one per repetition at most
    per_set = walked.join(distinct.select("key", "id", "sketch"), "key")

    def spread(batches):
        for batch in batches:
            out = {c: [] for c in ("row", "r", "leaf", "n", "leaves")}
            for i, ends in enumerate(batch.column("ends").to_pylist()):
                whole = np.zeros(repetitions, np.int64)
                for e in ends:
                    whole[e["r"]] = e["leaf"]
                for e in ends:
                    for c, v in (("row", i), ("r", e["r"]), ("leaf", e["leaf"]), ("n", e["n"]), ("leaves", whole.tobytes())):
                        out[c].append(v)
            row = np.array(out.pop("row"), np.int64)
            yield out | {c: batch.column(c).take(row) for c in ("key", "id", "sketch")}

    kind = distinct.schema["id"].dataType.simpleString()
    rows = map_batches(per_set, f"leaf long, n long, r int, key binary, id {kind}, sketch binary, leaves binary", spread)
    dealt = _blocks(rows)
    columns = ["own", "r", "key", "id", "sketch", "leaves"]
    schema = f"leaf long, low int, high int, own int, r int, key binary, id {kind}, sketch binary, leaves binary"

    def flag(batches):
        for now, held in _grouped(batches, columns):
            seen = np.zeros(len(held["own"]), bool)
            for a, b, look in _pairs(held, now, repetitions, floor):
                seen[a[look.any(1)]] = True
                seen[b[look.any(0)]] = True
            kept = np.flatnonzero(seen)
            if len(kept):
                leaf, low, high = now
                n = len(kept)
                yield {"leaf": [leaf] * n, "low": [low] * n, "high": [high] * n} | {c: [held[c][i] for i in kept] for c in columns}

    return map_batches(_placed(dealt), schema, flag)


def _placed(rows: DataFrame) -> DataFrame:
    return rows.repartition("leaf", "low", "high").sortWithinPartitions("leaf", "low", "high")


def _verified(texts: DataFrame, flagged: DataFrame, repetitions: int, similarity: float) -> DataFrame:
    """(key, links, root) from exact comparison; ``root`` is a set of the same class."""
    floor = sketch_floor(similarity)
    carried = ["leaf", "low", "high", "own", "r", "key", "sketch", "leaves"]

    def with_sets(batch, own_texts):
        sets, memo = [], {}
        for words, key in zip(words_by_text(own_texts), batch.column("key").to_pylist()):
            own = memo.get(key)
            if own is None or set_key(own) != key:
                own = memo[key] = shingles(words)
            # Rows that repeat an id may hold another text: only that of the key counts.
            sets.append(own.tobytes() if set_key(own) == key else None)
        return {c: batch.column(c) for c in carried} | {"items": sets}

    kind = "leaf long, low int, high int, own int, r int, key binary, sketch binary, leaves binary"
    filled = map_slices(flagged.join(texts, "id"), "text", f"{kind}, items binary", with_sets).where("items is not null")

    def compare(batches):
        for now, held in _grouped(batches, ["own", "r", "key", "sketch", "leaves", "items"]):
            _, first = np.unique(np.array([f"{o}/{k.hex()}" for o, k in zip(held["own"], held["key"])]), return_index=True)
            held = {c: [v[i] for i in sorted(first)] for c, v in held.items()}
            sets = [np.frombuffer(x, np.uint64) for x in held["items"]]
            sizes = np.array([len(s) for s in sets])
            links = np.zeros(len(sets), np.int64)
            parent = list(range(len(sets)))

            def find(i: int) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            for a, b, look in _pairs(held, now, repetitions, floor):
                shared = _intersections(sets, a, b, look)
                near = look & (shared * (1 + similarity) >= similarity * (sizes[a][:, None] + sizes[b][None, :]) - 1e-9)
                links[a] += near.sum(1)
                links[b] += near.sum(0)
                for i, j in zip(*np.nonzero(near)):
                    x, y = find(int(a[i])), find(int(b[j]))
                    if x != y:
                        parent[max(x, y)] = min(x, y)
            kept = np.flatnonzero(links)
            if len(kept):
                key = held["key"]
                yield {"key": [key[i] for i in kept], "links": links[kept], "root": [key[find(int(i))] for i in kept]}

    return map_batches(_placed(filled), "key binary, links long, root binary", compare)


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, look: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs to look at."""
    out = np.zeros(look.shape, np.float32)
    pairs = np.argwhere(look)
    if len(pairs) < 2_000:
        for i, j in pairs:
            x, y = sets[a[i]], sets[b[j]]
            out[i, j] = len(np.intersect1d(x, y, assume_unique=True))
        return out
    # Many pairs: products of 0/1 matrices, over the items that stand on both sides.
    items = np.intersect1d(np.concatenate([sets[i] for i in a]), np.concatenate([sets[i] for i in b]))
    for start in range(0, len(items), 4_096):
        part = items[start : start + 4_096]
        left, right = (np.array([np.isin(part, sets[i], assume_unique=True) for i in side], np.float32) for side in (a, b))
        out += left @ right.T
    return out


def one_per_class(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of each class; rows that repeat id and text
    become one. Rows with a null id belong to no class and stay."""
    gone = found.where(F.col(id_col) != F.col("class_id")).select(id_col, F.col("text_hash").alias("__text")).distinct()
    kept = docs.withColumn("__text", F.xxhash64(text_col)).join(gone, [id_col, "__text"], "left_anti").select(*docs.columns)
    known = kept.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])
    return known.unionByName(docs.where(F.col(id_col).isNull()))
