"""Token ids in compact files (operator 5).

Documents are put in order of their id by ranges, each task tokenises its range and
writes it in blocks of whole documents. A block ranks its ids by frequency, most frequent
first, and stores the ranks in one to four bytes each: two bits of a separate control
stream say how many. The rank-to-id list is the block's header, so a block is read alone.
Ranks are counted over every document, block by block; nothing has to be held for all
blocks. Readers find the bytes of a rank through a table over control bytes.

Blocks are rows of a table under ``path`` (Spark commits them, so a lost executor leaves
nothing half-written). Null texts are empty and get the end id alone. Equal and null
document ids are kept, nulls first, equal ones in the order of their text's hash. Empty
tables write no block. Extra columns are ignored.
"""

from __future__ import annotations

import os
import string
import zlib
from array import array

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import Shared, map_batches, slices, source_columns

IDS_PER_BLOCK = 2_000_000
BLOCKS = (
    "part int, block int, start_in_part long, n_ids long, doc_ids array<long>, counts array<long>, "
    "ranked binary, control binary, data binary"
)

#: Marks that never join letters before them in one token; an apostrophe may.
MARKS = string.punctuation.replace("'", "")
#: For each control byte the sizes of its four ranks.
SIZES = 1 + ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3)


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of ranks below 2^32."""
    ranks = ranks.astype(np.uint32)
    n = len(ranks)
    extra = (ranks > 0xFF).astype(np.uint8)
    for most in (0xFFFF, 0xFFFFFF):
        if n and ranks.max() > most:
            extra += ranks > most
    codes = np.zeros(-(-n // 4) * 4, np.uint8)
    codes[:n] = extra
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    width = int(extra.max(initial=0)) + 1
    raw = ranks.astype("<u4").view(np.uint8).reshape(n, 4)[:, :width]
    return control.tobytes(), raw[np.arange(width) <= extra[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ranks that :func:`pack` stored."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(sizes) - sizes
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, int(sizes.max(initial=1))):
        more = np.flatnonzero(sizes > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


class WordTokenizer:
    """A tokenizers file that lowers case and ends every word with its own last token.

    Words stand between white space and are independent of one another. The library
    encodes every distinct word once, many words to a call, and a bounded cache keeps the
    ids. Only blanks and line ends separate words here; other white space stays inside a
    word and is left to the library.
    """

    def __init__(self, path: str, end_id: int = 2, cache_limit: int = 900_000):
        with open(path, encoding="utf-8") as f:
            self.json = f.read()
        self.end_id, self.cache_limit = end_id, cache_limit
        self._library, self._cache = None, {}

    def __getstate__(self):
        return self.__dict__ | {"_library": None, "_cache": {}}

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_str(self.json)
        self._model = self._library.model
        vocabulary = self._library.get_vocab()
        self._kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _library_ids(self, words: list[str]) -> list[bytes]:
        coded = self._library.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, self._kind).tobytes() for e in coded]

    def _together(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters alone, which the library sees as one text: each then
        is one run up to a token that ends a word. If the runs don't number the words, as
        where lowering a letter yields a mark, the words are encoded one by one."""
        ids = np.array(self._library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self._kind)
        ends = np.flatnonzero(self._ends[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return self._library_ids(words)
        raw, edges = ids.tobytes(), [0, *(self._kind.itemsize * ends).tolist()]
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def _learn(self, words: set[str]) -> None:
        cache = self._cache
        # A word of letters, perhaps before marks, is coded as its parts are.
        stems, others, derived, bases, tails = set(), [], [], [], []
        for w in words:
            stem = w.rstrip(MARKS)
            base = stem.lower()
            if not base.isalpha():
                others.append(w)
                continue
            stems.add(base)
            if base != w:
                derived.append(w)
                bases.append(base)
                tails.append(w[len(stem) :])
        fresh = stems.difference(cache)
        # Small letters of ASCII are their own bytes, so the library's model takes them as they are.
        code, split = self._kind.char, self._model.tokenize
        for w in [w for w in fresh if w.isascii()]:
            cache[w] = array(code, [x.id for x in split(w)]).tobytes()
        fresh = [w for w in fresh if not w.isascii()]
        for start in range(0, len(fresh), 1_000):
            part = fresh[start : start + 1_000]
            cache.update(zip(part, self._together(part)))
        others += set(tails).difference(cache, others)
        for start in range(0, len(others), 10_000):
            part = others[start : start + 10_000]
            cache.update(zip(part, self._library_ids(part)))
        cache.update((w, cache[b] + cache[t] if t else cache[b]) for w, b, t in zip(derived, bases, tails))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text with the end id, in as few bytes as the vocabulary needs."""
        if self._library is None:
            self._load()
        end = np.array([self.end_id], self._kind).tobytes()
        sizes, words = [0], []
        for t in texts:
            words += t.replace("\n", " ").split(" ")
            sizes.append(len(words))
        found = list(map(self._cache.get, words))
        holes = [i for i, f in enumerate(found) if f is None]
        if holes:
            missing = {words[i] for i in holes}
            if len(self._cache) + 2 * len(missing) > self.cache_limit:
                self._cache = {w: f for w, f in zip(words, found) if f is not None}
            self._learn(missing)
            for i in holes:
                found[i] = self._cache[words[i]]
        return [np.frombuffer(b"".join(found[a:b]) + end, self._kind) for a, b in zip(sizes, sizes[1:])]


def broadcast_tokenizer(spark: SparkSession, path: str, end_id: int = 2) -> Shared:
    """The tokenizer file, whose fixed size bounds the broadcast."""
    return Shared(spark, WordTokenizer(path, end_id))


def write_tokens(
    docs: DataFrame, tokenizer: Shared, path: str, id_col: str = "doc_id", text_col: str = "text",
    ids_per_block: int = IDS_PER_BLOCK,
) -> None:
    """Encode every whole text and write the blocks, in ascending order of the id."""
    own = source_columns(docs, doc_id=id_col, text=text_col)
    tie = F.xxhash64("text")
    ordered = own.repartitionByRange(F.col("doc_id"), tie).sortWithinPartitions(F.col("doc_id"), tie)

    def task(batches):
        part = TaskContext.get().partitionId()
        held, doc_ids, size, block, start = [], [], 0, 0, 0

        def finish():
            ids = np.concatenate(held)
            times = np.bincount(ids)
            ranked = np.argsort(-times, kind="stable")[: np.count_nonzero(times)].astype("<u4")
            rank = np.empty(len(times), np.uint32)
            rank[ranked] = np.arange(len(ranked), dtype=np.uint32)
            control, data = pack(rank[ids])
            return {
                "part": [part], "block": [block], "start_in_part": [start], "n_ids": [len(ids)], "doc_ids": [doc_ids],
                "counts": [[len(x) for x in held]], "ranked": [ranked.tobytes()],
                "control": [control], "data": [data],
            }

        for batch, texts in slices(batches, "text"):
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), tokenizer.value.encode(texts)):
                held.append(ids)
                doc_ids.append(doc_id)
                size += len(ids)
                if size >= ids_per_block:
                    yield finish()
                    start, block = start + size, block + 1
                    held, doc_ids, size = [], [], 0
        if held:
            yield finish()

    map_batches(ordered, BLOCKS, task).write.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document: its first position over all documents, its ids and their crc32."""
    blocks = spark.read.parquet(path)
    schema = "doc_id long, part int, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def task(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                get = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = np.frombuffer(get["ranked"], "<u4")[unpack(get["control"], get["data"], get["n_ids"])]
                ends = np.cumsum(get["counts"])
                parts = np.split(ids, ends[:-1])
                out = {
                    "doc_id": get["doc_ids"],
                    "part": [get["part"]] * len(parts),
                    "at": get["start_in_part"] + ends - get["counts"],
                    "n_tokens": get["counts"],
                    "ids_crc32": [zlib.crc32(p.astype("<u4").tobytes()) for p in parts],
                }
                yield out | ({"ids": list(parts)} if with_ids else {})

    # One row per written part, that is per task, however many documents there are.
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    found = map_batches(blocks, schema, task).join(F.broadcast(offsets), "part")
    columns = ["doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return found.select(*columns, *["ids"] * with_ids)
