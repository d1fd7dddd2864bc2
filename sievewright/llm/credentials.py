"""Secret scan with linking of credentials that come in parts (operator 12).

Strong finds stand on their own. ``assign``: a name such as ``password`` or ``api_key``, a
colon or equals sign and a value of ``LEAST_VALUE`` characters or more; ``access``: an
access identifier; ``hex``: a long run of hexadecimal digits. Matches of a kind don't
overlap and are taken from the left; one that is too short is dropped after it has
consumed its text.

Weak parts are told from ordinary text only by what stands near them: ``id`` (an account
name after its heading, or a mail address), ``key`` (a run of ``LEAST_KEY`` or more letters, digits and
signs with a capital, a small letter and a digit) and ``endpoint`` (a web address, or four numbers with
dots). They are reported by an interval join. Every secret (assign, hex, key) opens a
scope: the ``REACH`` code points on either side, cut at blank lines. A scope is complete if
it holds an identifier (access, id) as well; then the weak parts that lie wholly within it
are reported, the secret itself included. A weak part that touches a strong find, or a key that touches
an id or endpoint, is that find and not a part of its own.

Both sides of the join are sorted by place, so a scope meets only the parts that begin
within it. A row is one unit of work and needs no other, so that texts repeated in many rows
cost no more than others, nothing is shuffled and a lost task is done again alone. Places are
code points, ends exclusive. A null text is empty and has no spans; a null id stays null;
repeated rows are scanned each. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256

from pyspark.sql import DataFrame

from .common import map_slices, source_columns

LEAST_VALUE = 8
LEAST_ACCESS = 16
LEAST_HEX = 32
LEAST_KEY = 16
REACH = 300

# Kinds in their order, and the patterns of the strong ones.
STRONG = ("assign", "access", "hex")
WEAK = ("id", "key", "endpoint")
KINDS = STRONG + WEAK
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"

#: Patterns of the weak kinds.
ID = (
    r"""(?:user|username|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
    r"""|[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]"""
)
KEY = rf"[A-Za-z0-9+/_-]{{{LEAST_KEY},}}"
ENDPOINT = r"""https?://[A-Za-z0-9._~:/?#@%&=+-]+|\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b"""

_ASSIGN = re.compile(ASSIGN, re.I | re.A)
# A text without one of these has no assignment; looking for them is faster.
_MARKS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(rf"AKIA[A-Z0-9]{{{LEAST_ACCESS - 4},}}")
# A run is as long as it can be, so asking for the length finds the same runs faster.
_HEX = re.compile(rf"(?<![0-9a-f])[0-9a-f]{{{LEAST_HEX},}}")
_NAMED = re.compile(ID.split("|[A-Za-z0-9_.+-]+@")[0], re.I | re.A)
_MAIL = re.compile(r"[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z]", re.A)
_KEY = re.compile(rf"(?<![A-Za-z0-9+/_-]){KEY}")
_MIXED = (re.compile("[a-z]"), re.compile("[A-Z]"), re.compile("[0-9]"))
_ENDPOINT = re.compile(ENDPOINT, re.A)

Span = tuple[int, int, int]


def strong(text: str) -> list[Span]:
    """(start, kind, end) of the strong finds, in order of place and kind."""
    lowered, found = text.lower(), []
    if any(mark in lowered for mark in _MARKS):
        found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _free(spans: list[Span], taken: list[Span]) -> list[Span]:
    """The spans that touch none of ``taken``; both sorted."""
    if not taken:
        return spans
    starts, reach, furthest = [t[0] for t in taken], [], 0
    for t in taken:
        furthest = max(furthest, t[2])
        reach.append(furthest)
    out = []
    for s in spans:
        i = bisect_left(starts, s[2])
        if not i or reach[i - 1] <= s[0]:
            out.append(s)
    return out


def _keys(text: str) -> list[Span]:
    return [(m.start(), 4, m.end()) for m in _KEY.finditer(text) if all(p.search(m.group()) for p in _MIXED)]


def weak(text: str, taken: list[Span]) -> list[Span]:
    """(start, kind, end) of the parts that need company, in order of place and kind."""
    found = [(m.start(), 3, m.end()) for m in _NAMED.finditer(text)]
    if "@" in text:
        mails = [(m.start(), 3, m.end()) for m in _MAIL.finditer(text)]
        found = sorted(found + _free(mails, sorted(found)))
    found += [(m.start(), 5, m.end()) for m in _ENDPOINT.finditer(text)]
    found = _free(sorted(found), taken)
    return sorted(found + _free(_keys(text), sorted(taken + found)))


def scope(text: str, start: int, end: int, reach: int = REACH) -> tuple[int, int]:
    """What a secret at ``start``..``end`` is read with: ``reach`` code points, no blank line."""
    low, high = max(start - reach, 0), min(end + reach, len(text))
    cut = text.rfind("\n\n", low, start)
    low = low if cut < 0 else cut + 2
    cut = text.find("\n\n", end, high)
    return low, high if cut < 0 else cut


def linked(text: str, sure: list[Span], reach: int = REACH) -> list[Span]:
    """The weak parts that some complete scope holds, in order of place and kind."""
    if all(kind == 1 for _, kind, _ in sure) and not _keys(text):
        return []  # no secret opens a scope
    parts = weak(text, sure)
    every = sorted(sure + parts)
    starts = [s[0] for s in every]
    kept: set[Span] = set()
    for start, kind, end in every:
        if KINDS[kind] not in ("assign", "hex", "key"):
            continue
        low, high = scope(text, start, end, reach)
        held = [s for s in every[bisect_left(starts, low) : bisect_left(starts, high)] if s[2] <= high]
        if any(KINDS[s[1]] in ("access", "id") for s in held):
            kept.update(s for s in held if s[1] >= len(STRONG))
    return sorted(kept)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per document: its strong spans (``base``), and all with the linked ones
    (``spans``), as lists of (kind, start, end) by start, then kind."""
    texts = source_columns(docs, id=id_col, text=text_col)
    kind = texts.schema["id"].dataType.simpleString()

    def work(batch, own_texts):
        base, spans = [], []
        for text in own_texts:
            sure = strong(text)
            base.append([_struct(s) for s in sure])
            spans.append([_struct(s) for s in sorted(sure + linked(text, sure, reach))])
        return {"id": batch.column("id"), "base": base, "spans": spans}

    each = "array<struct<kind:string,start:int,end:int>>"
    return map_slices(texts, "text", f"id {kind}, base {each}, spans {each}", work).withColumnRenamed("id", id_col)


def _struct(span: Span) -> dict:
    return {"kind": KINDS[span[1]], "start": span[0], "end": span[2]}
