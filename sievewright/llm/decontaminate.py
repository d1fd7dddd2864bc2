"""Benchmark decontamination by latent semantic retrieval (operator 6).

One pass over all documents counts in how many each hashed word stands and draws a random
sketch of the passage-by-word matrix: every passage of ``PASSAGE`` words is added, with a
random sign, to one of ``SKETCH`` rows. Weighted by inverse document frequency, the
sketch's singular vectors are a randomised SVD of the TF-IDF passages. A second pass maps
windows of the documents and the benchmark items into that space; windows are as long as
items of their length class and overlap by three quarters. Windows whose cosine with an
item reaches ``COSINE``, and stretches that share a run of ``RUN`` words with it, however
common its words are, are compared with it word by word: a longest common subsequence of
``COPY`` of the item is a leak, and one of ``PARAPHRASE`` is, if the answer (the item's last
sentence, unless a column names it) is found there too. Items of fewer than ``SHORT`` words
must stand there word for word.

Benchmark items are met in blocks of bounded size; items longer than the longest window in
pieces. Words are lower case and split at white space. Null texts and ids, on either side,
take no part; a repeated document id counts once with its best match; equal matches keep
the earliest. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import Shared, hashed_words, map_batches, map_slices, mix, shingle_hashes, slices, source_columns, words_by_text

BITS = 15
PASSAGE = 64
SKETCH = 128
LATENT = 64
MOST_DOCS = 0.05
LEAST_DOCS = 20  # of a small corpus
FLOOR = 0.1  # weight of a word in more of them
RUN, RUN_BITS = 4, 22
COSINE = 0.5
COPY, PARAPHRASE, ANSWER = 0.8, 0.6, 0.8
SHORT = 8
CLASSES = (8, 16, 32, 64)
ITEMS_PER_BLOCK = 4_000
NEARBY = 8


def features(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) & np.uint64((1 << BITS) - 1)).astype(np.int32)


def fresh(at: np.ndarray) -> np.ndarray:
    """Words with those that stood among the ``NEARBY`` words before them blanked out."""
    out = at.copy()
    for k in range(1, NEARBY + 1):
        out[k:][at[k:] == at[:-k]] = 1 << BITS
    return out


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def fit(docs: DataFrame) -> np.ndarray:
    """Weighted projection of hashed words into the latent space, a row per word.

    Every task adds up one sketch; sketches are added by row, so the driver gets one.
    """
    width = 1 << BITS

    def sketched(batches):
        sums = np.zeros((SKETCH + 1) * width, np.int64)
        n = 0
        for _, texts in slices(batches, "text"):
            hashes, sizes = hashed_words(texts)
            n += int((sizes > 0).sum())
            if not len(hashes):
                continue
            at = features(hashes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            first = np.repeat(np.cumsum(sizes) - sizes, sizes)
            place = np.arange(len(at)) - first
            begins = np.flatnonzero(place % PASSAGE == 0)
            number = np.cumsum(place % PASSAGE == 0) - 1
            drawn = mix(np.add.reduceat(hashes, begins))
            row = (drawn % np.uint64(SKETCH)).astype(np.int64)
            sign = np.where(drawn >> np.uint64(63), 1, -1)
            # A word counts once in a passage, so that repetitive texts don't rule the space.
            own = _distinct(number * width + at)
            passage, word = own >> BITS, own & (width - 1)
            np.add.at(sums, row[passage] * width + word, sign[passage])
            once = _distinct(doc[begins][passage] * width + word) & (width - 1)
            sums[SKETCH * width :] += np.bincount(once, minlength=width)
        pack = zstandard.ZstdCompressor(level=1).compress
        rows = sums.reshape(-1, width)
        kept = [i for i in range(len(rows)) if rows[i].any()]
        yield {"row": kept, "sums": [pack(rows[i].astype("<i4" if abs(rows[i]).max() < 2**31 else "<i8").tobytes()) for i in kept], "n": [n * (i == SKETCH) for i in kept]}

    def added(batches):
        unpack = zstandard.ZstdDecompressor().decompress
        sums: dict[int, list] = {}
        for batch in batches:
            for row, blob, n in zip(*(batch.column(c).to_pylist() for c in ("row", "sums", "n"))):
                raw = unpack(blob)
                own = np.frombuffer(raw, "<i4" if len(raw) == 4 * width else "<i8").astype(np.int64)
                held = sums.setdefault(row, [np.zeros(width, np.int64), 0])
                held[0] += own
                held[1] += n
        yield {"row": list(sums), "sums": [s[0].astype("<f4").tobytes() for s in sums.values()], "n": [s[1] for s in sums.values()]}

    schema = "row int, sums binary, n long"
    parts = map_batches(source_columns(docs, text="text"), schema, sketched)
    whole = map_batches(parts.repartition("row"), schema, added).collect()  # SKETCH + 1 rows of fixed size
    sketch, seen, total = np.zeros((SKETCH, width), np.float32), np.zeros(width), 0
    for r in whole:
        if r.row == SKETCH:
            seen, total = np.frombuffer(r.sums, "<f4").astype(float), r.n
        else:
            sketch[r.row] = np.frombuffer(r.sums, "<f4")
    # Words weigh by their rarity, and a little in any case, so that no item's vector vanishes.
    weight = np.maximum(np.log(max(MOST_DOCS * total, LEAST_DOCS) / (1 + seen)), FLOOR)
    sketch *= weight.astype(np.float32)
    # The right singular vectors, from the small Gram matrix of the sketch's rows.
    power, left = np.linalg.eigh(sketch.astype(np.float64) @ sketch.T.astype(np.float64))
    kept = np.argsort(-power)[:LATENT]
    kept = kept[power[kept] > 1e-9 * max(power.max(initial=0), 1e-9)]
    right = (left[:, kept].T / np.sqrt(power[kept])[:, None]).astype(np.float32) @ sketch
    return np.ascontiguousarray((right * weight.astype(np.float32)).T)


class Items:
    """A block of benchmark items by length class, ready for retrieval and comparison."""

    def __init__(self, rows: list[tuple], projection: np.ndarray):
        self.projection = np.vstack([projection, np.zeros((1, projection.shape[1]), np.float32)])
        self.names, self.words, self.masks, self.answers = [], [], [], []
        for name, text, answer in rows:
            words, tail = words_by_text([text, answer or last_sentence(text)])
            pieces = -(-len(words) // (CLASSES[-1] * 3 // 2)) if len(words) else 0
            for piece in np.array_split(words, pieces) if pieces else []:
                self.names.append(name)
                self.words.append(piece)
                self.masks.append(masks(piece))
                self.answers.append((masks(tail), len(tail)))
        sizes = np.array([len(w) for w in self.words])
        steps = np.log2(np.maximum(sizes, 1)[:, None] / np.array(CLASSES)) if len(sizes) else np.zeros((0, len(CLASSES)))
        self.kind = np.abs(steps).argmin(1)
        vectors = np.array([self.projection[fresh(features(w))].sum(0) for w in self.words]) if len(sizes) else np.zeros((0, 1))
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
        # Runs by their length (shorter items are one run): sorted hashes, their items and places there.
        self.runs: dict[int, tuple] = {}
        for k in sorted({min(len(w), RUN) for w in self.words} - {0}):
            own = [(i, shingle_hashes(w, k)) for i, w in enumerate(self.words) if min(len(w), RUN) == k]
            keys = np.concatenate([h for _, h in own])
            item = np.repeat([i for i, _ in own], [len(h) for _, h in own])
            place = np.concatenate([np.arange(len(h)) for _, h in own])
            order = np.argsort(keys, kind="stable")
            flags = np.zeros(1 << RUN_BITS, bool)
            flags[keys & np.uint64((1 << RUN_BITS) - 1)] = True
            self.runs[k] = keys[order], item[order], place[order], flags

    def cosine(self, i: int, words: np.ndarray) -> float:
        vector = self.projection[fresh(features(words))].sum(0)
        return float(vector @ self.vectors[i] / max(np.linalg.norm(vector), 1e-9))


def last_sentence(text: str) -> str:
    found = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if len(s.split()) >= 3]
    return found[-1] if found else text


def masks(words: np.ndarray) -> tuple[dict[int, int], int]:
    out: dict[int, int] = {}
    for i, x in enumerate(words.tolist()):
        out[x] = out.get(x, 0) | (1 << i)
    return out, len(words)


def common(item: tuple[dict[int, int], int], region: list[int]) -> int:
    """Length of the longest common subsequence of an item and a stretch of words."""
    table, n = item
    full = (1 << n) - 1
    row = full
    for x in region:
        m = table.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return n - row.bit_count()


def candidates(hashes: np.ndarray, sizes: np.ndarray, items: Items):
    """(document, item, first word, last word, cosine) of windows near an item."""
    widest = CLASSES[-1]
    padded = np.maximum(-(-sizes // (widest // 4)) * (widest // 4), widest)
    starts = np.cumsum(padded) - padded
    at = np.full(int(padded.sum()), 1 << BITS, np.int32)
    own = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(hashes))
    at[own] = features(hashes)
    at = fresh(at)
    doc = np.repeat(np.arange(len(sizes)), padded // 2)  # by pairs of words
    start_of = starts // 2
    blocks = items.projection[at[0::2]] + items.projection[at[1::2]]
    step = 2
    for kind, width in enumerate(CLASSES):
        if kind:
            blocks = blocks[0::2] + blocks[1::2]
            doc, start_of, step = doc[0::2], start_of // 2, step * 2
        mine = np.flatnonzero(items.kind == kind)
        if not len(mine):
            continue
        n = len(blocks) - 3
        windows = blocks[:n] + blocks[1 : n + 1] + blocks[2 : n + 2] + blocks[3 : n + 3]
        norm = np.sqrt(np.einsum("ij,ij->i", windows, windows))
        good = (norm > 1e-6) & (doc[:n] == doc[3 : n + 3])
        places = np.flatnonzero(good)
        for start in range(0, len(places), 20_000):
            part = places[start : start + 20_000]
            score = windows[part] @ items.vectors[mine].T.astype(np.float32)
            row, col = np.nonzero(score >= COSINE * norm[part][:, None])
            for w, i, c in zip(part[row].tolist(), mine[col].tolist(), (score[row, col] / norm[part[row]]).tolist()):
                d = int(doc[w])
                first = (w - int(start_of[d])) * step
                yield d, i, first, first + width, c


def verbatim(hashes: np.ndarray, sizes: np.ndarray, items: Items):
    """(document, item, first word, last word) of stretches that share a run with an item."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    begins = np.cumsum(sizes) - sizes
    for k, (keys, item, place, flags) in items.runs.items():
        own = shingle_hashes(hashes, k)
        at = np.flatnonzero(flags[own & np.uint64((1 << RUN_BITS) - 1)])
        at = at[doc[at] == doc[at + k - 1]]
        low, high = np.searchsorted(keys, own[at], "left"), np.searchsorted(keys, own[at], "right")
        n = high - low
        entry = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        at = np.repeat(at, n)
        d, i = doc[at], item[entry]
        first = np.maximum(at - begins[d] - place[entry], 0)
        last = first + np.array([len(w) for w in items.words])[i]
        # Runs of one stretch all tell the same place.
        yield from np.unique(np.column_stack([d, i, first, last]), axis=0).tolist()


def leaks_of(words: np.ndarray, found: list[tuple], items: Items):
    """The best verified match of each item among candidate windows of one document."""
    regions: dict[int, list[list]] = {}
    for i, a, b, c in sorted(found):
        own = regions.setdefault(i, [])
        if own and a <= own[-1][1]:
            own[-1][1], own[-1][2] = max(own[-1][1], b), max(own[-1][2], c)
        else:
            own.append([a, b, c])
    best: dict = {}
    for i, own in regions.items():
        item = items.words[i]
        n = len(item)
        for a, b, c in own:
            a, b = max(a - n // 2, 0), min(b + n // 2, len(words))
            region = words[a:b].tolist()
            share = common(items.masks[i], region) / n
            if n < SHORT:
                hit = item.tobytes() in words[a:b].tobytes() if share == 1 else False
                answered = hit
            else:
                answer, size = items.answers[i]
                answered = size > 0 and share >= PARAPHRASE and common(answer, region) >= ANSWER * size
                hit = share >= COPY or answered
            name = items.names[i]
            if hit and (name not in best or share > best[name][0]):
                best[name] = (share, c if c >= COSINE else items.cosine(i, words[a:b]), answered, a, b)
    return best


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", answer_col: str | None = None,
) -> DataFrame:
    """doc_id, item_id, ``cosine``, ``overlap`` (share of the item in the longest common
    subsequence), ``answered``, and the stretch of words it was found in."""
    spark = docs.sparkSession
    texts = source_columns(docs, id=id_col, text=text_col).where("id is not null and text is not null")
    questions = source_columns(benchmark, item=item_col, text=item_text_col, **({"answer": answer_col} if answer_col else {}))
    if not answer_col:
        questions = questions.withColumn("answer", F.lit(None).cast("string"))
    questions = questions.where("item is not null and text is not null").distinct()
    kind, item_kind = texts.schema["id"].dataType.simpleString(), questions.schema["item"].dataType.simpleString()
    schema = f"id {kind}, item_id {item_kind}, cosine double, overlap double, answered boolean, first_word int, last_word int"
    projection = fit(texts)
    blocks = max(-(-questions.count() // ITEMS_PER_BLOCK), 1)
    out = None
    for block in range(blocks):
        mine = questions.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        rows = [(r.item, r.text, r.answer) for r in mine.orderBy("item", "text").collect()]  # about ITEMS_PER_BLOCK
        shared = Shared(spark, Items(rows, projection))

        def work(batch, own_texts, shared=shared):
            items = shared.value
            hashes, sizes = hashed_words(own_texts)
            columns = {n: [] for n in ("row", "item_id", "cosine", "overlap", "answered", "first_word", "last_word")}
            if len(hashes) and items.names:
                near: dict[int, list] = {}
                for d, i, a, b, c in candidates(hashes, sizes, items):
                    near.setdefault(d, []).append((i, a, b, c))
                for d, i, a, b in verbatim(hashes, sizes, items):
                    near.setdefault(d, []).append((i, a, b, 0.0))
                ends = np.cumsum(sizes)
                for d, found in near.items():
                    words = hashes[ends[d] - sizes[d] : ends[d]]
                    for name, (share, c, answered, a, b) in leaks_of(words, found, items).items():
                        for n, v in zip(columns, (d, name, c, share, answered, a, b)):
                            columns[n].append(v)
            row = np.array(columns.pop("row"), np.int64)
            return columns | {"id": batch.column("id").take(row)}

        found = map_slices(texts, "text", schema, work)
        out = found if out is None else out.unionByName(found)
    best = F.max(F.struct("overlap", "cosine", "answered", (-F.col("first_word")).alias("f"), "last_word")).alias("m")
    return out.groupBy("id", "item_id").agg(best).select(
        F.col("id").alias(id_col), "item_id", "m.cosine", "m.overlap", "m.answered", (-F.col("m.f")).alias("first_word"), "m.last_word"
    )


def without_leaks(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that no benchmark item was found in; rows with a null id stay."""
    return docs.join(source_columns(found, **{id_col: id_col}).distinct(), id_col, "left_anti").select(*docs.columns)
