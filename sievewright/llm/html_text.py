"""Main text of web pages by removing the site's template (operator 8).

Pages are parsed into elements. Elements whose name, class, id or role says that they are
menus, page headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader
comments go. Of what is left, every element with text is hashed with all below it, the
hashes are counted per host, and an element that recurs on many pages of its host belongs
to the site's template and goes too: outside an article, if it is a block, on more than
half of the host's pages without article and on three at least; inside one, on more than
half of the host's pages and on ten at least. Only pages that differ in the rest of their
text count, so copies of an article never make it a template.

Blocks are joined by line ends, white space in a block becomes one blank, character
references are decoded. A page with articles yields their text, else that of its main
element, else its whole body. Null html gives an empty text; a null url has no host, so only
element names count there. Repeated rows each give a row. Extra columns are ignored.
"""

from __future__ import annotations

import html
import re

import numpy as np
from pyspark.sql import DataFrame, functions as F

from ..session import settle
from .common import map_slices, source_columns

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S,
)
MARKED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed template".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CHROME = frozenset(
    "nav footer aside form script style noscript iframe template head title button select input textarea menu dialog svg "
    "canvas object embed".split()
)
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo nav navbar navigation menu breadcrumb "
    "breadcrumbs sidebar side footer header masthead cookie cookies consent notice notices alert popup modal newsletter "
    "subscribe subscription signup login comment comments reply replies disqus share sharing social related widget "
    "pagination pager toolbar contentinfo complementary search".split()
)
#: Elements that a start tag closes, up to the element that bounds the search.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
KEEPS_OPEN = frozenset({"html", "body", "article", "main"})
MIN_PAGES_OUTSIDE, MIN_PAGES_INSIDE, SHARE_OUTSIDE, SHARE_INSIDE = 3, 10, 0.5, 0.5


class Element:
    __slots__ = ("tag", "below", "chrome")

    def __init__(self, tag: str, chrome: bool):
        self.tag, self.below, self.chrome = tag, [], chrome


def is_chrome(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in CHROME or (tag == "header" and not in_article):
        return True
    if tag in ("html", "body", "main") or not attributes:
        return False
    for _, a, b, c in MARKED.findall(attributes):
        if not WORDS.isdisjoint(re.split(r"[\s_-]+", (a or b or c).lower())):
            return True
    return False


def parse(page: str) -> Element:
    """The page as elements and texts; unclosed and crossing tags are mended."""
    root = Element("", False)
    stack, at, articles = [root], 0, 0
    while True:
        m = TAG.search(page, at)
        if m is None:
            stack[-1].below.append(page[at:])
            return root
        if m.start() > at:
            stack[-1].below.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    articles -= sum(e.tag in ("article", "main") for e in stack[i:])
                    del stack[i:]
                    break
            continue
        if tag in BLOCK:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    del stack[i:]
                    break
                if stack[i].tag in BLOCK:
                    break
        if tag in CLOSES:
            closed, bound = CLOSES[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in closed:
                    del stack[i:]
                    break
                if stack[i].tag in bound:
                    break
        element = Element(tag, is_chrome(tag, m[3], articles > 0))
        stack[-1].below.append(element)
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not m[3].rstrip().endswith("/"):
            stack.append(element)
            articles += tag in ("article", "main")


def _find(element: Element, tag: str, out: list[Element]) -> list[Element]:
    """The outermost elements of a name that are not chrome."""
    todo = [element]
    while todo:
        e = todo.pop()
        for x in reversed([x for x in e.below if isinstance(x, Element) and not x.chrome]):
            todo.append(x)
        if e.tag == tag:
            out.append(e)
            del todo[len(todo) - sum(isinstance(x, Element) and not x.chrome for x in e.below) :]
    return out


def content(page: str, hashed: bool = True) -> tuple[bool, list[tuple[str, list[int]]], list[int], list[bool]]:
    """Whether the text is an article's, its blocks, the elements that hold them, and which
    of these are blocks themselves.

    A block is a list of (text, elements around it) and an element is the hash of its name
    and of all text and elements below it (0 unless ``hashed``).
    """
    from xxhash import xxh3_64_intdigest

    root = parse(page)
    roots = _find(root, "article", []) or _find(root, "main", [])
    inside = bool(roots)
    hashes: list[int] = []
    solid: list[bool] = []
    blocks: list[list[tuple[str, list[int]]]] = [[]]

    # Depth is walked with a stack of its own: pages may nest deeper than calls can.
    todo: list[tuple] = [("open", r, None) for r in reversed(roots or [root])]
    around: list[int] = []
    parts: list[list[str]] = [[]]
    while todo:
        what, x, number = todo.pop()
        if what == "text":
            text = html.unescape(x)
            if text:
                blocks[-1].append((text, list(around)))
                if hashed:
                    parts[-1].append(" ".join(text.split()))
        elif what == "open":
            if x.chrome:
                continue
            if x.tag in BLOCK:
                blocks.append([])
            elif x.tag == "br":
                blocks[-1].append((" ", list(around)))
            number = len(hashes)
            hashes.append(0)
            solid.append(x.tag in BLOCK)
            around.append(number)
            parts.append([x.tag])
            todo.append(("close", x, number))
            for y in reversed(x.below):
                todo.append(("open", y, None) if isinstance(y, Element) else ("text", y, None))
        else:
            own = parts.pop()
            if hashed:
                digest = xxh3_64_intdigest("\x1f".join(own))
                hashes[number] = digest - (1 << 64) if digest >> 63 else digest
                parts[-1].append(format(digest, "x"))
            around.pop()
            if x.tag in BLOCK:
                blocks.append([])
    return inside, [b for b in blocks if b], hashes, solid


def render(blocks, hashes: list[int], gone: frozenset[int]) -> str:
    lines = []
    for block in blocks:
        kept = [t for t, around in block if gone.isdisjoint([hashes[i] for i in around])] if gone else [t for t, _ in block]
        line = " ".join("".join(kept).split())
        if line:
            lines.append(line)
    return "\n".join(lines)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text of every page.

    Pages are parsed twice: once for the elements they hold, which are written, and again,
    with the few of them that the host's template holds, for the text. A page is known by
    the hash of its row, so equal rows are the same page and null ids are no special case.
    """
    rows = source_columns(pages, page_id=page_id, url=url, html=page)
    kind = rows.schema["page_id"].dataType.simpleString()
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    rows = rows.withColumns({"host": host, "row": F.xxhash64("page_id", "url", "html")})

    def parsed(batch, texts):
        seen, insides, rests, totals = [], [], [], []
        for t in texts:
            inside, blocks, hashes, solid = content(t)
            insides.append(inside)
            # The sum of its texts' hashes tells an element's share of the page, and so the rest.
            held = np.zeros(len(hashes), np.int64)
            total = np.int64(0)
            with np.errstate(over="ignore"):
                for b in blocks:
                    for text, around in b:
                        if text.strip():
                            h = np.int64(hash_text(text))
                            total += h
                            held[around] += h
                own = {h: int(total - x) for h, x, block in zip(hashes, held, solid) if x and (inside or block)}
            seen.append(list(own))
            rests.append(list(own.values()))
            totals.append(int(total))
        return {"row": batch.column("row"), "host": batch.column("host"), "inside": insides, "seen": seen, "rests": rests, "total": totals}

    schema = "row long, host string, inside boolean, seen array<long>, rests array<long>, total long"
    named = settle(map_slices(rows.where(F.col("host") != ""), "html", schema, parsed), "page-elements")
    elements = named.select("row", "host", "inside", F.explode(F.arrays_zip("seen", "rests")).alias("e")).select(
        "row", "host", "inside", F.col("e.seen").alias("hash"), F.col("e.rests").alias("rest")
    )
    # A page is told by the rest of its text, so that copies of a page count once.
    counted = (
        elements.groupBy("host", "hash", "rest").agg(F.max("inside").alias("inside"))
        .groupBy("host", "hash").agg(F.count("*").alias("n"), F.max("inside").alias("inside"))
        .where(F.col("n") >= MIN_PAGES_OUTSIDE)
    )
    hosts = named.groupBy("host").agg(F.count("*").alias("pages"))
    plain = named.where("not inside and total != 0").select("host", "total").distinct().groupBy("host").agg(F.count("*").alias("plain"))
    many = F.when(
        F.col("inside"), (F.col("n") >= MIN_PAGES_INSIDE) & (F.col("n") > F.col("pages") * SHARE_INSIDE)
    ).otherwise(F.col("n") > F.col("plain") * SHARE_OUTSIDE)
    template = counted.join(hosts, "host").join(plain, "host", "left").where(many).select("host", "hash")
    # Written first: where no page has any, or few have, the pages needn't be exchanged.
    gone = settle(elements.join(template, ["host", "hash"]).groupBy("row").agg(F.collect_set("hash").alias("gone")), "page-templates")
    met = rows.select("page_id", "url", "html", "row").join(gone, "row", "left")

    def rendered(batch, texts):
        found = []
        for t, drop in zip(texts, batch.column("gone").to_pylist()):
            _, blocks, hashes, _ = content(t, hashed=bool(drop))
            found.append(render(blocks, hashes, frozenset(drop or ())))
        return {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": found}

    return map_slices(met, "html", f"page_id {kind}, url string, text string", rendered)


def hash_text(text: str) -> int:
    from xxhash import xxh3_64_intdigest

    digest = xxh3_64_intdigest(" ".join(text.split()))
    return digest - (1 << 64) if digest >> 63 else digest
