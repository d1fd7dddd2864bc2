"""Repeated passages by collinear chaining (operator 4).

Documents are sampled for seeds: of every ``WINDOW`` runs of five words the one with the
smallest hash, so that any passage long enough yields the same seeds wherever it stands.
Runs of ``LONG`` words are sampled too, densely enough that any ``MIN_WORDS`` words hold
one: where the short seeds of a passage stood first in several documents, these still lead
to one that holds as much of it. Each occurrence of a seed is matched with its first one
(smallest document, then place), never with all others. Where a run recurs in a document
its occurrences are also numbered, so that repetitive texts match in order. The matches of a document with an earlier one are joined to
diagonal runs, and runs are chained in order on both sides, best score first: words
covered less a cost for every word skipped, the best predecessor coming from a Fenwick
tree over places in the earlier document. Chains are broken at long gaps, fetched as words
from both documents, extended at both ends and aligned; those similar enough are kept.
Pieces that follow one another in a document, whatever documents they repeat, make one
passage; passages of ``MIN_WORDS`` words or more are returned, if one piece alone has
``SIMILARITY`` of that. So the first document
with a passage keeps it, and every later one is named with the document it repeats.

Words are lower case and split at white space. Documents with fewer words, null texts and
null ids have no passage. Rows that repeat an id are searched as one document, but pieces are
aligned and joined in each text by itself, so ``text_hash`` (Spark's xxhash64) tells whose
passage it is; they are not compared with one another. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import ddl, free_name, hashed_words, map_batches, map_slices, mix, popcount_lcs, sieve, sieved, source_columns, words_by_text
from ..session import settle

SHINGLE = 5
WINDOW = 8
MIN_WORDS = 50
SIMILARITY = 0.8
GAP_COST = 0.5
LONGEST_GAP = 20
MARGIN = 48
MIN_SEEDS = 2
JOIN_WORDS = 5
LONG = 33
PIECES_HELD = 20_000
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACED = re.compile(r"\S+")


def _sliding(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every window of ``width`` values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[: len(x) - step], x[step:])
        have += step
    return x


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of every run of ``length`` words of one sequence, from sums of its prefixes."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    powers = np.full(n, BASE, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    back = np.full(n, INVERSE, np.uint64)
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers, dtype=np.uint64)])
    return mix((sums[length:] - sums[: n - length + 1]) * back[: n - length + 1])


def sampled_runs(hashes: np.ndarray, left: np.ndarray, length: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the smallest runs of ``length`` words in every window of runs.
    ``left`` tells how many words of its text each word begins; no window leaves a text."""
    runs = run_hashes(hashes, length)
    if len(runs) < window:
        return np.empty(0, np.int64), runs[:0]
    least = _sliding(runs, window, np.minimum)
    least[left[: len(least)] < window + length - 1] = 0
    edge = np.zeros(window - 1, np.uint64)
    at = np.flatnonzero(_sliding(np.concatenate([edge, least, edge]), window, np.maximum) == runs)
    return at, runs[at]


def seeds(hashes: np.ndarray, sizes: np.ndarray, long: int = LONG, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Texts, places, hashes and lengths of the seeds of a slice of texts, each of
    ``min_words`` words or more. The n-th occurrence of a run in a text is a seed of its
    own besides the plain one, so that repetitive texts match in order."""
    begins = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(len(sizes)), sizes)
    left = np.repeat(begins + sizes, sizes) - np.arange(len(hashes))
    at, runs = sampled_runs(hashes, left, SHINGLE, min(WINDOW, min_words - SHINGLE + 1))
    own = runs ^ mix(text[at].astype(np.uint64) + BASE)
    order = np.argsort(own, kind="stable")
    same = own[order]
    new = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]])) if len(at) else order
    nth = np.empty(len(at), np.uint64)
    nth[order] = np.arange(len(at)) - np.repeat(new, np.diff(np.append(new, len(at))))
    more = np.flatnonzero(nth)
    far, longer = sampled_runs(hashes, left, long, min_words - long + 1)
    places = np.concatenate([at, at[more], far])
    numbered = mix(runs[more] + nth[more] * BASE)
    lengths = np.repeat([SHINGLE, SHINGLE, long], [len(at), len(more), len(far)])
    return text[places], places - begins[text[places]], np.concatenate([mix(runs), numbered, mix(longer + np.uint64(long))]), lengths


class Fenwick:
    """Largest value, with its owner, over a prefix of places."""

    def __init__(self, size: int):
        self.best = [(-np.inf, -1)] * (size + 1)

    def put(self, place: int, value: tuple[float, int]) -> None:
        place += 1
        while place < len(self.best):
            if value > self.best[place]:
                self.best[place] = value
            place += place & -place

    def upto(self, place: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        while place > 0:
            if self.best[place] > found:
                found = self.best[place]
            place &= place - 1
        return found


def diagonal_runs(at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Join seeds on one diagonal to (start, end, start there, end there, words, seeds)."""
    order = np.lexsort((at, at - first))
    at, first = at[order], first[order]
    step = np.diff(at)
    cut = (np.diff(at - first) != 0) | (step > WINDOW + SHINGLE)
    begin = np.concatenate([[0], np.flatnonzero(cut) + 1])
    finish = np.concatenate([begin[1:], [len(at)]])
    words = np.minimum(np.append(step, SHINGLE), SHINGLE)
    words[finish - 1] = SHINGLE
    covered = np.add.reduceat(words, begin)
    last = finish - 1
    return np.column_stack([at[begin], at[last] + SHINGLE, first[begin], first[last] + SHINGLE, covered, finish - begin])


def chains(runs: np.ndarray) -> list[list[int]]:
    """Best chains of runs, each used once, by repeated dynamic programming."""
    left = np.lexsort((runs[:, 2], runs[:, 0])).tolist()
    out = []
    while left:
        rows = runs[left]
        ends_there = np.unique(rows[:, 3])
        tree = Fenwick(len(ends_there))
        score, before = [0.0] * len(left), [-1] * len(left)
        ends = (rows[:, 1] + rows[:, 3]).tolist()
        put_at = np.searchsorted(ends_there, rows[:, 3]).tolist()
        ask_at = np.searchsorted(ends_there, rows[:, 2], "right").tolist()
        by_end = np.argsort(rows[:, 1], kind="stable").tolist()
        finishes = rows[by_end, 1].tolist()
        entered = 0
        for i, (start, _, start_there, _, words, _) in enumerate(rows.tolist()):
            while entered < len(left) and finishes[entered] <= start:
                j = by_end[entered]
                entered += 1
                if j < i:
                    tree.put(put_at[j], (score[j] + GAP_COST * ends[j], j))
            value, j = tree.upto(ask_at[i])
            gain = value - GAP_COST * (start + start_there)
            score[i], before[i] = (words + gain, j) if gain > 0 else (words, -1)
        # The next best chains are the same without the runs taken, until one would need those.
        used: set[int] = set()
        for i in np.argsort(-np.array(score), kind="stable").tolist():
            if i in used:
                continue
            chain = []
            while i >= 0 and i not in used:
                chain.append(i)
                i = before[i]
            if i >= 0:
                break
            chain.reverse()
            out.append([left[j] for j in chain])
            used.update(chain)
        left = [x for i, x in enumerate(left) if i not in used]
    return out


def pieces(at: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Chained stretches (start, end, start there, end there) without long gaps."""
    runs = diagonal_runs(at, first)
    rows = runs.tolist()
    out = []

    def close(part):
        if sum(r[5] for r in part) >= MIN_SEEDS:
            out.append((part[0][0], part[-1][1], part[0][2], part[-1][3]))

    for chain in chains(runs) if len(runs) > 1 else [[0]]:
        part = [rows[chain[0]]]
        for i in chain[1:]:
            if max(rows[i][0] - part[-1][1], rows[i][2] - part[-1][3]) > LONGEST_GAP:
                close(part)
                part = []
            part.append(rows[i])
        close(part)
    return out


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """Words by which two sequences can be extended: +1 for equal, -2 for unequal words."""
    n = min(len(a), len(b))
    best = score = reach = 0
    for i in range(n):
        score += 1 if a[i] == b[i] else -2
        if score > best:
            best, reach = score, i + 1
        elif score < best - 6:
            break
    return reach


def align(a: np.ndarray, b: np.ndarray, piece: tuple[int, int, int, int]) -> tuple[int, int, int, int, float]:
    """Extend a piece in words ``a`` and ``b`` and measure the common part of it."""
    start, end, start_there, end_there = piece
    back = _reach(a[:start][::-1], b[:start_there][::-1])
    on = _reach(a[end:], b[end_there:])
    start, start_there, end, end_there = start - back, start_there - back, end + on, end_there + on
    x, y = a[start:end], b[start_there:end_there]
    longest = max(len(x), len(y))
    if len(x) == len(y) and np.array_equal(x, y):
        return start, end, start_there, end_there, 1.0
    n = min(len(x), len(y))
    same = x[:n] == y[:n]
    head = n if same.all() else int(same.argmin())
    tail_same = x[::-1][: n - head] == y[::-1][: n - head]
    tail = len(tail_same) if tail_same.all() else int(tail_same.argmin())
    middle = popcount_lcs(x[head : len(x) - tail], y[head : len(y) - tail])
    return start, end, start_there, end_there, (head + tail + middle) / longest


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per aligned piece of a repeated passage: its place in words in the document
    (``start``, ``end``), in the earlier one (``first_doc_id``, ``first_start``,
    ``first_end``), its similarity, and the whole passage (``passage_start``, ``passage_end``)."""
    texts = source_columns(docs, id=id_col, text=text_col).where("id is not null and text is not null")
    kind = texts.schema["id"].dataType.simpleString()

    def sampled(batch, own_texts):
        words, sizes = hashed_words(own_texts)
        enough = np.flatnonzero(sizes >= min_words)
        row, at, hashed, n = seeds(words[np.repeat(sizes >= min_words, sizes)], sizes[enough], long, min_words)
        ids = batch.column("id").take(enough[row])
        return {"hash": hashed.view(np.int64), "id": ids, "at": at.astype(np.int32), "n": n.astype(np.int32)}

    long = max(LONG * min_words // MIN_WORDS, SHINGLE)
    found = map_slices(texts, "text", f"hash long, id {kind}, at int, n int", sampled)
    # One exchange by seed finds the first occurrence and meets the others with it.
    by_seed = found.repartition("hash").sortWithinPartitions("hash", "id", "at")
    matches = map_batches(by_seed, f"id {kind}, at int, n int, first_id {kind}, first_at int", _met)
    together = matches.repartition("id").sortWithinPartitions("id", "first_id", "at", "first_at")
    spans = f"id {kind}, start int, end int, first_id {kind}, first_start int, first_end int"
    packed = ", ".join(f"{c}: {t}" for c, t in (x.rsplit(" ", 1) for x in f"side int, {spans}".split(", ")))
    wanted = settle(map_batches(together, f"doc {kind}, spans array<struct<{packed}>>", _chained), "pieces")
    # Only texts that hold a piece are shuffled.
    held, _ = sieved(texts, "id", sieve(wanted.select("doc")))
    fetched = wanted.join(held.select(F.col("id").alias("doc"), "text", F.xxhash64("text").alias("key")), "doc")

    def cut(batch, own_texts):
        # Pieces of one text come in several rows; it is hashed once for those that follow one another.
        new = [i for i, t in enumerate(own_texts) if not i or t != own_texts[i - 1]]
        hashes = words_by_text([own_texts[i] for i in new])
        lists = batch.column("spans")
        rows, each = lists.flatten(), lists.value_lengths().to_numpy()
        columns = {f.name: rows.field(f.name) for f in rows.type}
        side = columns["side"].to_numpy() == 0
        begins = np.where(side, columns["start"].to_numpy(), columns["first_start"].to_numpy())
        ends = np.where(side, columns["end"].to_numpy(), columns["first_end"].to_numpy()) + MARGIN
        owner = np.repeat(np.repeat(np.arange(len(new)), np.diff([*new, len(own_texts)])), each)
        words = [
            hashes[i][a:b].astype(np.uint32).tobytes()
            for i, a, b in zip(owner.tolist(), np.maximum(begins - MARGIN, 0).tolist(), ends.tolist())
        ]
        return columns | {"key": batch.column("key").take(np.repeat(np.arange(len(each)), each)), "words": words}

    words = map_slices(fetched, "text", f"{spans}, side int, key long, words binary", cut)
    order = ["id", "first_id", "start", "end", "first_start", "first_end", "side", "key", "words"]
    met = words.repartition("id").sortWithinPartitions(*order)
    result = f"{spans}, similarity double, passage_start int, passage_end int, text_hash long"
    out = map_batches(met, result, lambda batches: _passages(batches, similarity, min_words))
    return out.withColumnsRenamed({"id": id_col, "first_id": f"first_{id_col}"})


def _met(batches):
    """Occurrences of seeds in later documents with the first occurrence, which stands
    before them; only that one is held, however frequent a seed is."""
    last, first_id, first_at = None, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        hashes, at, ids = batch.column("hash").to_numpy(), batch.column("at").to_numpy(), batch.column("id")
        # Place 0 is the first occurrence of the seed that the last batch ended with.
        all_ids = pa.concat_arrays([ids[:1] if first_id is None else first_id, ids])
        all_at = np.concatenate([[first_at], at]).astype(np.int32)
        new = np.concatenate([[last is None or hashes[0] != last], hashes[1:] != hashes[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(1, len(at) + 1), 0))
        firsts = all_ids.take(first)
        later = pc.greater(ids, firsts)
        last, first_id, first_at = hashes[-1], all_ids.slice(first[-1], 1), all_at[first[-1]]
        yield {
            "id": ids.filter(later),
            "at": batch.column("at").filter(later),
            "n": batch.column("n").filter(later),
            "first_id": firsts.filter(later),
            "first_at": pa.array(all_at[first]).filter(later),
        }


def _runs_of(batches, keys: list[str], columns: list[str]):
    """Rows of equal keys, which stand together, as lists by column."""
    now, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = {c: batch.column(c).to_pylist() for c in {*keys, *columns}}
        marks = list(zip(*[values[k] for k in keys]))
        edges = [0, *[i for i in range(1, len(marks)) if marks[i] != marks[i - 1]], len(marks)]
        for a, b in zip(edges, edges[1:]):
            if marks[a] != now:
                if held is not None:
                    yield now, held
                now, held = marks[a], {c: [] for c in columns}
            for c in columns:
                held[c] += values[c][a:b]
    if held is not None:
        yield now, held


def _without_strays(batches):
    """The matches without the pairs of documents whose matches are all short and too far
    apart to stand in one piece: most pairs share no more than common phrases. What may go
    on in the next batch stays."""
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows - 1, bool)
        for name in ("id", "first_id"):
            column = batch.column(name)
            same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        at, n = batch.column("at").to_numpy(), batch.column("n").to_numpy()
        useful = n > SHINGLE
        useful[1:] |= same & (np.diff(at) <= SHINGLE + LONGEST_GAP)
        begins = np.concatenate([[0], np.flatnonzero(~same) + 1])
        kept = np.logical_or.reduceat(useful, begins)
        kept[[0, -1]] = True
        yield batch.filter(pa.array(np.repeat(kept, np.diff(np.append(begins, batch.num_rows)))))


def _pairs(batches):
    """(document, earlier one) with the arrays of their matches, which stand together."""
    now, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, firsts = batch.column("id"), batch.column("first_id")
        same = np.ones(batch.num_rows - 1, bool)
        for column in (ids, firsts):
            same &= pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False).astype(bool)
        edges = [0, *(np.flatnonzero(~same) + 1).tolist(), batch.num_rows]
        rows = np.column_stack([batch.column(c).to_numpy().astype(np.int64) for c in ("at", "first_at", "n")])
        for a, b in zip(edges, edges[1:]):
            pair = ids[a].as_py(), firsts[a].as_py()
            if pair != now:
                if held:
                    yield now, np.concatenate(held)
                now, held = pair, []
            held.append(rows[a:b])
    if held:
        yield now, np.concatenate(held)


def _chained(batches):
    """The pieces of every pair, each for both of its documents, packed by document."""
    pending, held = {}, 0
    for (doc, first), matches in _pairs(_without_strays(batches)):
        # A long run is a row of short ones.
        at, there, n = matches.T
        each = (n + SHINGLE - 1) // SHINGLE
        nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        shift = np.minimum(nth * SHINGLE, np.repeat(n - SHINGLE, each))
        both = np.unique((np.repeat(at, each) + shift) << 32 | (np.repeat(there, each) + shift))
        if len(both) < MIN_SEEDS:
            continue
        for a, b, c, d in pieces(both >> 32, both & 0xFFFFFFFF):
            for side, owner in enumerate((doc, first)):
                pending.setdefault(owner, []).append((side, doc, a, b, first, c, d))
            held += 1
        if held >= PIECES_HELD:
            yield _packed(pending)
            pending, held = {}, 0
    yield _packed(pending)


def _packed(pending: dict) -> dict:
    names = ("side", "id", "start", "end", "first_id", "first_start", "first_end")
    rows = [r for own in pending.values() for r in own]
    ends = np.cumsum([0, *map(len, pending.values())])
    columns = [pa.array(c) for c in (zip(*rows) if rows else [[]] * len(names))]
    inner = pa.StructArray.from_arrays(columns, names)
    return {"doc": list(pending), "spans": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), inner)}


def _passages(batches, similarity: float, min_words: int):
    """Align every piece in each text of its documents, and join pieces text by text."""
    spans = ["id", "first_id", "start", "end", "first_start", "first_end"]
    names = ("id", "start", "end", "first_id", "first_start", "first_end", "similarity", "passage_start", "passage_end", "text_hash")
    out = {n: [] for n in names}

    def close(doc, key, kept):
        kept.sort()
        groups: list[list] = []
        reach = None
        for piece in kept:
            if groups and piece[0] <= reach + JOIN_WORDS:
                groups[-1].append(piece)
                reach = max(reach, piece[1])
            else:
                groups.append([piece])
                reach = piece[1]
        for group in groups:
            begin, finish = group[0][0], max(p[1] for p in group)
            longest = max(p[1] - p[0] for p in group)
            if finish - begin >= min_words and longest >= similarity * min_words:
                for a, b, first, c, d, s in group:
                    for n, v in zip(names, (doc, a, b, first, c, d, s, begin, finish, key)):
                        out[n].append(v)

    now, kept = None, {}
    for (doc, first, a, b, c, d), held in _runs_of(batches, spans, ["side", "key", "words"]):
        if doc != now:
            for key, own in kept.items():
                close(now, key, own)
            now, kept = doc, {}
            if len(out["id"]) >= 10_000:
                yield dict(out)
                out.update({n: [] for n in names})
        here, there = {}, set()
        for side, key, words in zip(held["side"], held["key"], held["words"]):
            if side:
                there.add(words)
            else:
                here[key] = words
        off, off_there = max(a - MARGIN, 0), max(c - MARGIN, 0)
        piece = a - off, b - off, c - off_there, d - off_there
        for key, words in here.items():
            x, best = np.frombuffer(words, np.uint32), None
            for other in sorted(there):
                y = np.frombuffer(other, np.uint32)
                if min(len(x) - piece[1], len(y) - piece[3]) >= 0:  # else another row of the id is meant
                    found = align(x, y, piece)
                    if best is None or found[4] > best[4]:
                        best = found
            if best is not None and best[4] >= similarity:
                p, q, r, s, same = best
                kept.setdefault(key, []).append((p + off, q + off, first, r + off_there, s + off_there, same))
    for key, own in kept.items():
        close(now, key, own)
    yield out


def without_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns kept, with their repeated passages cut from the text.

    A document that is left without a word goes. Rows with a null id stay as they are, and
    a row that repeats an id with another text loses its own passages only.
    """
    own, doc, key = (free_name(docs, n) for n in ("spans", "id", "key"))
    spans = found.groupBy(F.col(id_col).alias(doc), F.col("text_hash").alias(key)).agg(
        F.collect_set(F.struct("passage_start", "passage_end")).alias(own)
    )
    spans = settle(spans, "passages")
    # Only documents that may hold a passage are shuffled.
    marked, clear = sieved(docs, id_col, sieve(spans.select(doc)))
    same = (F.col(f"`{id_col}`") == F.col(doc)) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col(key))
    met = marked.join(spans, same, "left").drop(doc, key)

    others = [c for c in docs.columns if c != text_col]

    def task(batches):
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            spans = batch.column(own).to_pylist()
            left = [t if not s else _cut(t or "", s) for t, s in zip(texts, spans)]
            kept = np.array([i for i, (t, s) in enumerate(zip(left, spans)) if not s or t.split()], np.int64)
            yield {c: batch.column(c).take(kept) for c in others} | {text_col: [left[i] for i in kept]}

    return map_batches(met, ddl(docs), task).unionByName(clear)


def _cut(text: str, spans: list[dict]) -> str:
    places = [m.span() for m in SPACED.finditer(text)]
    kept, at = [], 0
    for s in sorted((s["passage_start"], min(s["passage_end"], len(places))) for s in spans):
        if s[0] < s[1]:
            kept.append(text[at : places[s[0]][0]])
            at = places[s[1] - 1][1]
    return "".join(kept) + text[at:]
