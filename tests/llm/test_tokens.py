"""Operators 3 and 5 against the tokenizer libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import pytest

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")

from sievewright.llm import bpe, token_files  # noqa: E402
from sievewright.session import new_path  # noqa: E402

TEXTS = ["", None, "It's  we'll\n\n 'tis ''re x'", "  a", "\t \n", "½ Ⅷ 漢字 ١٢ é", "!!!'s 's 'd", "z" * 300, " ".join(["lang"] * 3000)]


@pytest.fixture(scope="module")
def vocab():
    return bpe.Vocabulary.load(public.path("byte_bpe_multi_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_random_texts_are_coded_as_by_the_library(vocab, library):
    rng = random.Random(3)
    letters = "  \n\t''strevmdlaé12٣漢!?-́😀\r abc  "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for t, (ids, starts, pieces) in zip(texts, vocab.encode(texts)):
        assert ids == library.encode_ordinary(t), t
        assert vocab.decode(ids) == t.encode()
        assert len(starts) == len(pieces) and sum(map(len, pieces)) == len(ids)
        ends = [*starts[1:], len(t)]
        assert all(vocab.decode(p) == t[a:b].encode() for a, b, p in zip(starts, ends, pieces))


def test_full_cache_is_emptied_and_results_stay(library):
    small = bpe.Vocabulary.load(public.path("byte_bpe_multi_50k.tiktoken"))
    small.cache_limit = 5
    for t in ("one two three four five six seven", "eight nine one two"):
        assert small.encode([t])[0][0] == library.encode_ordinary(t)


def test_round_trip_and_encode_decode_in_spark(spark, library):
    rows = [(i if i != 3 else None, t, "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    shared = bpe.broadcast_vocabulary(spark, public.path("byte_bpe_multi_50k.tiktoken"))
    got = {r.doc_id: r for r in bpe.round_trip(docs, shared).collect()}
    assert len(got) == len(TEXTS)
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    back = {r.doc_id: bytes(r.bytes) for r in bpe.decode(bpe.encode(docs, shared), shared).collect()}
    assert back == {i: (t or "").encode() for i, t, _ in rows}
    assert bpe.round_trip(docs.limit(0), shared).count() == 0


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], list(range(0, 70000, 7))])
def test_packed_ranks_come_back(ranks):
    ranks = np.array(ranks, np.uint32)
    control, data = token_files.pack(ranks)
    assert len(control) == -(-len(ranks) // 4)
    assert token_files.unpack(control, data, len(ranks)).tolist() == ranks.tolist()


def test_token_files_hold_what_the_library_encodes(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    texts = [*TEXTS, "The, THE the. don't İstanbul Σίσυφος", "### word&&& a.b", "x\x1cy z"]
    rows = [(len(texts) - i, t, 7) for i, t in enumerate(texts)] + [(2, texts[0], 1), (None, "no id", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(3)
    path = new_path(spark, "tokens")
    tokenizer = token_files.broadcast_tokenizer(spark, public.path("word_bpe_49k.json"))
    token_files.write_tokens(docs, tokenizer, path, ids_per_block=50)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32, list(r.ids)) for r in token_files.read_tokens(spark, path).collect())
    assert [g[1] for g in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    want = {}
    for i, t, _ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        want.setdefault(i, []).append(ids)
    for start, i, n, crc, ids in got:
        assert start == at and ids in want[i] and n == len(ids)
        assert crc == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += n
    empty = new_path(spark, "tokens")
    token_files.write_tokens(docs.limit(0), tokenizer, empty)
    assert token_files.read_tokens(spark, empty).count() == 0
