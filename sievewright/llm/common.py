"""Small helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from xxhash import xxh3_64_digest

CHARS_PER_SLICE = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHARS_PER_SLICE) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into pieces of about ``limit`` characters of ``text``.

    A text is never cut: one longer than the limit makes a slice of its own. A null
    text is the empty text.
    """
    for batch in batches:
        texts = [t or "" for t in batch.column(text).to_pylist()]
        start, held = 0, 0
        for i, t in enumerate(texts):
            if held and held + len(t) > limit:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += len(t)
        if start < len(texts):
            yield batch.slice(start), texts[start:]


class Shared:
    """A broadcast object whose class need not be installed on the executors.

    Broadcast only what has a bounded size. Each worker unpacks it once and then keeps it,
    with whatever bounded caches it holds, for all its tasks.
    """

    def __init__(self, spark: SparkSession, value: Any):
        self.box = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    @property
    def value(self) -> Any:
        box = self.box.value
        if "value" not in box:
            box["value"] = cloudpickle.loads(box["pickled"])
        return box["value"]


def map_batches(df: DataFrame, schema: str, task: Callable[[Iterator[pa.RecordBatch]], Iterator[dict[str, Any]]]) -> DataFrame:
    """Run ``task`` on the Arrow batches of every partition; it yields columns by name."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        for columns in task(batches):
            yield pa.RecordBatch.from_arrays([_array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _array(values: Any, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def map_slices(
    df: DataFrame, text: str, schema: str, work: Callable[[pa.RecordBatch, list[str]], dict[str, Any]]
) -> DataFrame:
    """Run ``work`` on text slices of every partition; it returns columns by name."""
    return map_batches(df, schema, lambda batches: (work(batch, texts) for batch, texts in slices(batches, text)))


def word_hashes(words: list[str], cache: dict[str, bytes], limit: int = 1_000_000) -> np.ndarray:
    """A 64-bit hash for each word; ``cache`` holds at most about ``limit`` of them."""
    if len(cache) > limit:
        cache.clear()
    found = list(map(cache.get, words))
    if None in found:
        for i in [i for i, h in enumerate(found) if h is None]:
            w = words[i]
            found[i] = cache[w] = xxh3_64_digest(w)
    return np.frombuffer(b"".join(found), np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (murmur finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


#: Which code points separate words, as ``str.split`` sees it; none lies beyond U+3000.
SPACES = np.array([chr(i).isspace() for i in range(0x3001)] + [False])


#: Mixed (character, place) pairs of the first characters and places, which most words are made of; 0 for white space.
CHARS, PLACES = 256, 64
MIXED = mix(np.arange(CHARS, dtype=np.uint64) | (np.arange(PLACES, dtype=np.uint64)[:, None] << np.uint64(32)))
MIXED = np.where(SPACES[:CHARS], np.uint64(0), MIXED).ravel()


def _mixed(points: np.ndarray, place: np.ndarray, space: np.ndarray) -> np.ndarray:
    """``mix(points | place << 32)``, looked up where the table has it; 0 for white space."""
    out = MIXED.take(place * CHARS + points, mode="clip")
    far = place >= PLACES
    if points.dtype != np.uint8:
        far |= (points >= CHARS) | space
    rest = np.flatnonzero(far)
    out[rest] = 0
    rest = rest[~space[rest]]
    out[rest] = mix(points[rest].astype(np.uint64) | (place[rest].astype(np.uint64) << np.uint64(32)))
    return out


def hashed_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of the texts, in order, and the words of each text.

    Words are ``text.lower().split()``; a hash adds up mixed (character, place) pairs, so
    whole slices are hashed at once without a Python object for a word.
    """
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered)
    try:
        points = np.frombuffer(joined.encode("latin-1"), np.uint8)
        space = SPACES.take(points)
    except UnicodeEncodeError:
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        space = SPACES.take(np.minimum(points, 0x3001))
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
    if not len(begins):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    # The white space after a word adds 0 to its sum.
    first = begins[0]
    points, space = points[first:], space[first:]
    place = np.arange(len(points)) - np.repeat(begins - first, np.diff(begins - first, append=len(points)))
    hashes = mix(np.add.reduceat(_mixed(points, place, space), begins - first))
    starts = np.cumsum([0, *(len(t) + 1 for t in lowered[:-1])])
    owner = np.searchsorted(starts, begins, "right") - 1
    return hashes, np.bincount(owner, minlength=len(texts))


def words_by_text(texts: list[str]) -> list[np.ndarray]:
    hashes, sizes = hashed_words(texts)
    return np.split(hashes, np.cumsum(sizes)[:-1]) if len(texts) else []


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """The hash of every run of ``k`` words, in text order; shorter inputs give none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + n]
    return mix(out)


def popcount_lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over Python integers."""
    if not len(a) or not len(b):
        return 0
    masks: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        masks[x] = masks.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        m = masks.get(x)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


#: Bits of a :func:`sieve`, 16 MB.
SIEVE_BITS = 1 << 27


def sieve(ids: DataFrame, bits: int = SIEVE_BITS) -> DataFrame:
    """Bitmaps of the hashes of ``ids``' only column, at most ``bits`` bits in all."""
    at = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits))
    return ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("__bits")
    )


def sieved(df: DataFrame, id_col: str, bitmaps: DataFrame, bits: int = SIEVE_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows whose id may be in the :func:`sieve`, and those whose id surely is not, null
    ids among these. Rows are told apart where they are, without a shuffle."""
    at = F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(bits))
    place = F.bitmap_bit_position(at)
    byte = F.conv(F.hex(F.substring("__bits", (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False)) & F.col(f"`{id_col}`").isNotNull()
    met = df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(at) == F.col("__bucket"), "left")
    return met.where(hit).drop("__bucket", "__bits"), met.where(~hit).drop("__bucket", "__bits")


def source_columns(df: DataFrame, **names: str) -> DataFrame:
    """Keep only the needed columns, under fixed working names, so that nothing else in
    the caller's table can clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in names.items()])


def ddl(df: DataFrame) -> str:
    """The columns of a table as text, for an operator that passes all of them on."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def free_name(df: DataFrame, name: str) -> str:
    """A working column name that no column of the caller's table has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
