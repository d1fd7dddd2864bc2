"""Byte-level BPE encoding and decoding (operator 3).

Boundaries of pre-tokens are found without a regex: every code point gets a class, the
class and its neighbours give a symbol, and a small automaton reads the symbols. Its
transitions are functions from state to state, and composing functions is associative,
so all blocks of a text are reduced at once, their effects are combined by a scan, and a
second sweep reads off the boundaries. The slices go through a bounded cache of merged
pieces; unseen pieces are merged together, one merge of every piece per round.

Null texts are empty; empty texts have no ids and decode to no bytes. Repeated rows each
give a row. Null ids are kept. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from .common import Shared, map_batches, map_slices, source_columns

# The code points of Unicode's White_Space property.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

OTHER, LETTER, NUMBER, SPACE = range(4)
# Symbols. JOIN is a blank that the next run takes in; ALONE is other white space before a
# non-space; GAP is white space before white space or the end; TAKE1 and TAKE2 are an
# apostrophe with one or two letters that may form a contraction.
S_OTHER, S_LETTER, S_NUMBER, S_GAP, S_JOIN, S_ALONE, S_TAKE1, S_TAKE2 = range(8)
# States: the run that a following symbol may extend.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_GAP, JOINING, OWES1, OWES2 = range(8)
BLOCK = 128
NONE = np.int32(2**31 - 1)
MATRIX_BYTES = 32


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and boundary flag by symbol and state; symbols from 8 on begin a text."""
    step = np.zeros((16, 8), np.uint8)
    cut = np.ones((16, 8), np.uint8)
    for state in range(8):
        for symbol, run in ((S_LETTER, IN_LETTERS), (S_NUMBER, IN_NUMBERS), (S_OTHER, IN_OTHERS)):
            step[symbol, state] = run
            cut[symbol, state] = state not in (run, JOINING)
        step[S_GAP, state], cut[S_GAP, state] = IN_GAP, state != IN_GAP
        step[S_JOIN, state], step[S_ALONE, state] = JOINING, FREE
        for symbol, owes in ((S_TAKE1, OWES1), (S_TAKE2, OWES2)):
            within = state in (IN_OTHERS, JOINING)
            step[symbol, state], cut[symbol, state] = (IN_OTHERS, 0) if within else (owes, 1)
    step[S_LETTER, OWES1], cut[S_LETTER, OWES1] = FREE, 0
    step[S_LETTER, OWES2], cut[S_LETTER, OWES2] = OWES1, 0
    for symbol in range(8):
        step[8 + symbol, :] = step[symbol, FREE]
    return step.ravel(), cut.ravel()


STEP, CUT = _automaton()


def char_classes() -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = unicodedata.category(chr(i))[0]
        if c == "L":
            kinds[i] = LETTER
        elif c == "N":
            kinds[i] = NUMBER
    kinds[list(WHITE_SPACE)] = SPACE
    return kinds


def boundaries(joined: str, text_starts: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Code-point offsets where pre-tokens begin, in texts joined end to end.

    ``text_starts`` are the offsets of the non-empty texts.
    """
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    n = len(points)
    if not n:
        return np.empty(0, np.int64)
    kind = kinds[points]
    after = np.empty(n, np.uint8)
    after[:-1], after[-1] = kind[1:], SPACE
    after[text_starts[1:] - 1] = SPACE
    symbol = kind.copy()
    white = kind == SPACE
    single = white & (after != SPACE)
    symbol[white] = S_GAP
    symbol[single] = np.where(points[single] == 32, S_JOIN, S_ALONE)
    marks = np.flatnonzero(points == 39)
    if len(marks):
        ends = np.append(text_starts[1:], n)[np.searchsorted(text_starts, marks, "right") - 1]
        far = np.append(points, [0, 0]).astype(np.uint32)
        one = np.where(marks + 1 < ends, far[marks + 1], 0)
        two = np.where(marks + 2 < ends, far[marks + 2], 0)
        symbol[marks[np.isin(one, [ord(c) for c in "stmd"])]] = S_TAKE1
        pairs = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
        symbol[marks[np.any([(one == a) & (two == b) for a, b in pairs], axis=0)]] = S_TAKE2
    symbol[text_starts] += 8
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = symbol
    columns = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T) << 3
    whole = np.tile(np.arange(8, dtype=np.uint8), (blocks, 1))
    for column in columns:
        whole = STEP[column[:, None] + whole]
    d = 1
    while d < blocks:
        whole[d:] = np.take_along_axis(whole[d:], whole[:-d].copy(), 1)
        d *= 2
    state = np.zeros(blocks, np.uint8)
    state[1:] = whole[:-1, FREE]
    cuts = np.empty((BLOCK, blocks), np.uint8)
    for j, column in enumerate(columns):
        code = column + state
        cuts[j] = CUT[code]
        state = STEP[code]
    return np.flatnonzero(cuts.T.ravel()[:n])


class Vocabulary:
    """Ranks of byte strings with all tables that coding needs.

    Its size follows the vocabulary file, which is what bounds its broadcast. Workers
    keep a bounded cache of merged pieces on it.
    """

    def __init__(self, ranks: dict[bytes, int], cache_limit: int = 1_000_000):
        self.pieces = dict(ranks)
        self.size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.decimals = [str(i) for i in range(self.size)]
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        keys, merged = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    merged.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_ranks = np.array(merged, np.int32)[order]
        self.kinds = char_classes()
        self.cache: dict[str, tuple[int, ...]] = {}
        self.cache_limit = cache_limit

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a})

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NONE)

    def _merge_matrix(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Merge many pieces of at most ``width`` bytes, one merge of each per round."""
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        sizes = np.array([len(p) for p in pieces])
        ids = np.where(np.arange(width) < sizes[:, None], self.single[raw], -1)
        rank = self.pair_rank(ids[:, :-1], ids[:, 1:])
        out: list[tuple[int, ...]] = [()] * len(pieces)
        rows = np.arange(len(pieces))
        while len(rows):
            at = rank.argmin(1) if rank.shape[1] else np.zeros(len(rows), int)
            best = rank[np.arange(len(rows)), at] if rank.shape[1] else np.full(len(rows), NONE)
            done = best == NONE
            for r, row in zip(rows[done].tolist(), ids[done].tolist()):
                out[r] = tuple(x for x in row if x >= 0)
            rows, ids, rank, at, best = rows[~done], ids[~done], rank[~done], at[~done], best[~done]
            if not len(rows):
                break
            line, width = np.arange(len(rows)), ids.shape[1] - 1
            ids[line, at] = best
            place = np.arange(width)
            ids = np.take_along_axis(ids, place + (place > at[:, None]), 1)
            place = np.arange(width - 1)
            rank = np.take_along_axis(rank, np.minimum(place + (place >= at[:, None]), width - 1), 1)
            left = at > 0
            rank[line[left], at[left] - 1] = self.pair_rank(ids[line[left], at[left] - 1], ids[line[left], at[left]])
            right = at < width - 1
            rank[line[right], at[right]] = self.pair_rank(ids[line[right], at[right]], ids[line[right], at[right] + 1])
        return out

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Merge one long piece with a heap over a linked list: lowest rank, then leftmost."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pair_rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            j = after[i]
            if j < n:
                merged = self.pieces.get(self.tokens[ids[i]] + self.tokens[ids[j]])
                if merged is not None:
                    heapq.heappush(heap, (merged, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return tuple(x for x in ids if x >= 0)

    def learn(self, pieces: set[str]) -> None:
        """Put the ids of unseen pieces into the cache."""
        if len(self.cache) + len(pieces) > self.cache_limit:
            self.cache.clear()
        by_width: dict[int, list[str]] = {}
        for p in pieces:
            raw = p.encode()
            whole = self.pieces.get(raw)
            if whole is not None:
                self.cache[p] = (whole,)
            elif len(raw) > MATRIX_BYTES:
                self.cache[p] = self._merge_long(raw)
            else:
                by_width.setdefault(-(-len(raw) // 4) * 4, []).append(p)
        for width, group in by_width.items():
            for start in range(0, len(group), 50_000):
                part = group[start : start + 50_000]
                self.cache.update(zip(part, self._merge_matrix([p.encode() for p in part], width)))

    def encode(self, texts: list[str]) -> list[tuple[list[int], np.ndarray, list[tuple[int, ...]]]]:
        """For each text its ids, the code-point offset of every pre-token, and the ids of
        every pre-token."""
        sizes = np.array([len(t) for t in texts], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        joined = "".join(texts)
        cuts = boundaries(joined, starts[:-1][sizes > 0], self.kinds)
        edges = cuts.tolist()
        pieces = [joined[a:b] for a, b in zip(edges, chain(edges[1:], (len(joined),)))]
        unseen = set(pieces).difference(self.cache)
        if unseen:
            self.learn(unseen if len(self.cache) + len(unseen) <= self.cache_limit else set(pieces))
        merged = list(map(self.cache.__getitem__, pieces))
        at = np.searchsorted(cuts, starts).tolist()
        out = []
        for i, start in enumerate(starts[:-1].tolist()):
            own = merged[at[i] : at[i + 1]]
            out.append((list(chain.from_iterable(own)), cuts[at[i] : at[i + 1]] - start, own))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def broadcast_vocabulary(spark: SparkSession, path: str) -> Shared:
    """The vocabulary file's tables; read on the driver, so executors need no such file."""
    return Shared(spark, Vocabulary.load(path))


def encode(docs: DataFrame, vocab: Shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """ids of every whole text, with the offset of each pre-token and its number of ids."""

    def work(batch, texts):
        coded = vocab.value.encode(texts)
        return {
            "id": batch.column("id"),
            "ids": [c[0] for c in coded],
            "piece_starts": [c[1] for c in coded],
            "piece_tokens": [[len(p) for p in c[2]] for c in coded],
        }

    schema = f"id {_type(docs, id_col)}, ids array<int>, piece_starts array<int>, piece_tokens array<int>"
    out = map_slices(source_columns(docs, id=id_col, text=text_col), "text", schema, work)
    return out.withColumnRenamed("id", id_col)


def decode(coded: DataFrame, vocab: Shared, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The bytes that ids stand for; null ids decode to none."""
    schema = f"id {_type(coded, id_col)}, bytes binary"

    def task(batches):
        for batch in batches:
            found = batch.column("ids").to_pylist()
            yield {"id": batch.column("id"), "bytes": [vocab.value.decode(i or []) for i in found]}

    return map_batches(source_columns(coded, id=id_col, ids=ids_col), schema, task).withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, vocab: Shared, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one task and return only digests, for tables whose ids nobody
    needs to keep: number of ids, sha256 of the ids in decimal, sha256 of the decoded bytes."""

    def work(batch, texts):
        v = vocab.value
        coded = [c[0] for c in v.encode(texts)]
        number = v.decimals.__getitem__
        return {
            "id": batch.column("id"),
            "n_tokens": [len(c) for c in coded],
            "ids_sha256": [hashlib.sha256(",".join(map(number, c)).encode()).hexdigest() for c in coded],
            "decoded_sha256": [hashlib.sha256(v.decode(c)).hexdigest() for c in coded],
        }

    schema = f"id {_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    out = map_slices(source_columns(docs, id=id_col, text=text_col), "text", schema, work)
    return out.withColumnRenamed("id", id_col)


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()
