"""Main text of web pages by minimum cut.

A page is read into blocks of text with their place in the element tree. A linear classifier gives
each block a cost for being called content or boilerplate (terminal capacities); blocks next to
each other, and neighbours under one parent, are tied by smoothness edges that weaken with their
distance in the tree. A maximum flow finds the labelling of least total cost.

Defined results: null, empty or markup-free html is read like any other (text outside elements is a
block of the body); character references are decoded, all white space inside a block becomes one
space, a line break element is white space; comments, scripts, styles, templates, titles and the
head are never text (a script, style, template or title without an end tag: up to the next tag), anything
else is, also what stands in svg, math, noscript, iframe, textarea or xmp, and is kept or not by its costs;
end tags without a start are ignored, open elements end with their parent or the page.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from llm.common import table

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|template|title)(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\">])*>"
                    r"|<[!?][^>]*>|</?[a-zA-Z](?:\"[^\"]*\"|'[^']*'|[^'\">])*>", re.S | re.I)
#: Ends of the elements that are never text.
_RAW_END = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "template", "title")}
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_HINT = re.compile(r"\b(?:class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
_HIDDEN_FLAG = re.compile(r"\shidden(?=[\s/>])|\saria-hidden\s*=\s*[\"']?true", re.I)
_HIDDEN_STYLE = re.compile(r"\bstyle\s*=\s*[\"'][^\"']*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
                   "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section "
                   "summary table tbody td tfoot th thead tr ul option select button textarea xmp".split())
#: An element of a key ends where one of its values begins inside the same parent.
ENDS = {"p": BLOCKS - {"body", "html", "head"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"},
        "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPES = frozenset("article aside body div footer form header li main nav section table td th ul ol dl figure details".split())

# Log-odds for content; the classifier's weights.
BOILER_TAGS = {"nav": -9, "footer": -9, "aside": -9, "header": -9, "form": -9, "menu": -9, "button": -9, "select": -9, "textarea": -9,
               "dialog": -9, "head": -30, "fieldset": -9}
CONTENT_TAGS = {"article": 4, "main": 3}
BLOCK_TAGS = {"p": 1.0, "h1": 0.5, "h2": 0.5, "h3": 0.5, "h4": 0.5, "blockquote": 1.0, "pre": 1.0, "xmp": 1.0, "li": -0.5, "td": 0, "dd": 0}
BOILER_WORDS = frozenset("""ad ads adv advert advertisement advertising alert banner breadcrumb breadcrumbs byline comment comments
    comments consent cookie cookies copyright disclaimer discussion footer header legal login masthead menu modal nav navbar navigation
    newsletter notice notification pager pagination popup promo promotion recommended related reply replies respond responses
    search share sharing sidebar signup skyscraper social sponsor sponsored subscribe subscription tags toolbar topbar widget
    complementary contentinfo""".split())
CONTENT_WORDS = frozenset("article articlebody body content entry main post story text".split())
LINK, SHORT_LINK, PER_100_CHARS, STOP, COPYRIGHT, BIAS = -3.0, -2.0, 0.5, 0.5, -3.0, 0.0
ADJACENT, NEAR = 0.4, 1.2  # smoothness of neighbours in the page; of neighbours in the tree, by 1 + distance

_TAGS: dict[str, tuple[str, bool, float, bool]] = {}


def _tag(text: str) -> tuple[str, bool, float, bool]:
    """(name, is an end tag, log-odds of what stands inside, is an article)."""
    got = _TAGS.get(text)
    if got is None:
        m = _NAME.match(text)
        name = m[1].lower() if m else ""
        odds, inside = 0.0, name in CONTENT_TAGS
        if text[1] != "/":
            odds = float(BOILER_TAGS.get(name, CONTENT_TAGS.get(name, 0)))
            hints = " ".join(a or b or c for a, b, c in _HINT.findall(text))
            said = set(re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", hints).lower()))
            boiler, content = said & BOILER_WORDS, said & CONTENT_WORDS
            if content and boiler <= {"header", "tags", "byline"}:
                boiler = set()
            if name not in ("body", "html"):
                if boiler:
                    odds = min(odds, -9.0)
                elif content and odds >= 0:
                    odds = max(odds, 3.0)
                if _HIDDEN_STYLE.search(text) or _HIDDEN_FLAG.search(text) and _HIDDEN_FLAG.search(_QUOTED.sub("true", text)):
                    odds = -9.0
        got = name, text[1] == "/", odds, inside
        if len(_TAGS) < 100_000 and len(text) < 1000:  # long attributes are rarely met again
            _TAGS[text] = got
    return got


#: Where the search for an element to end stops.
_HALTS = SCOPES - ENDS.keys()
#: For a block's name, the open elements that it ends.
_ENDED_BY = {name: [key for key, names in ENDS.items() if name in names] for name in BLOCKS}


class Place:
    """An element in the tree: its parent (None above the page) and how deep it lies."""
    __slots__ = ("parent", "depth")

    def __init__(self, parent: Place | None):
        self.parent, self.depth = parent, parent.depth + 1 if parent else 0


class _Block:
    __slots__ = ("parts", "linked", "total", "tag", "place", "odds")

    def __init__(self, tag, place, odds):
        self.parts, self.linked, self.total, self.tag, self.place, self.odds = [], 0, 0, tag, place, odds


class _Open:
    """The open elements, and for each name and kind where they stand, so that the nearest is found at once."""

    def __init__(self):
        # (name, place, best content odds, boilerplate odds, inside an article)
        self.stack: list[tuple[str, Place, float, float, bool]] = [("", Place(None), 0.0, 0.0, False)]
        self.named: dict[str, list[int]] = {}
        self.blocks: list[int] = [0]
        self.halts: list[int] = [0]

    def push(self, name: str, content: float, boiler: float, article: bool) -> None:
        k = len(self.stack)
        self.stack.append((name, Place(self.stack[-1][1]), content, boiler, article))
        self.named.setdefault(name, []).append(k)
        if name in BLOCKS:
            self.blocks.append(k)
        if name in _HALTS:
            self.halts.append(k)

    def close(self, depth: int) -> int:
        """End the elements from this depth on; how many of them were links."""
        links = 0
        while len(self.stack) > depth:
            name = self.stack.pop()[0]
            self.named[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
            if name in _HALTS:
                self.halts.pop()
            links += name == "a"
        return links

    def nearest(self, name: str) -> int:
        """Where the innermost open element of a name stands; 0 if there is none."""
        at = self.named.get(name)
        return at[-1] if at else 0


def read_blocks(page: str) -> list[tuple[str, Place, float]]:
    """(text, place in the tree, log-odds for content) of the page's blocks that have text. Linear in the page."""
    blocks: list[_Block] = []
    tree = _Open()
    links, cur = 0, None

    def take(text: str):
        nonlocal cur
        if cur is None:
            if not text or text.isspace():
                return
            name, place, *_ = tree.stack[tree.blocks[-1]]
            _, _, content, boiler, _ = tree.stack[-1]
            cur = _Block(name, place, content + boiler)
            blocks.append(cur)
        cur.parts.append(text)
        n = len(text)
        cur.total += n
        if links:
            cur.linked += n

    at = 0
    endless = set()  # raw elements that no end tag follows any more
    while m := _TOKEN.search(page, at):
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        text = m[0]
        if m[1]:
            raw = m[1].lower()
            shut = None if raw in endless else _RAW_END[raw].search(page, at)
            if shut:
                at = shut.end()
            else:
                endless.add(raw)
                at = page.find("<", at)
                if at < 0:
                    at = len(page)
            continue
        if text[1] in "!?":
            continue
        name, end, odds, inside = _tag(text)
        if name == "br":
            if cur is not None:
                cur.parts.append(" ")
            continue
        block = name in BLOCKS
        if end:
            k = tree.nearest(name)
            if k and (block or tree.blocks[-1] < k):
                links -= tree.close(k)
            if block:
                cur = None
            continue
        if block:
            cur = None
            k = max(map(tree.nearest, _ENDED_BY[name]), default=0)
            if k > tree.halts[-1]:
                links -= tree.close(k)
        if name in VOID or text.endswith("/>") and not block:
            continue
        _, _, content, boiler, article = tree.stack[-1]
        if odds > 0:
            content = max(content, odds)
        elif odds < 0 and not (name == "header" and article):
            boiler = min(boiler, odds)
        tree.push(name, content, boiler, article or inside)
        if name == "a":
            links += 1
    if at < len(page):
        take(page[at:])
    out = []
    for b in blocks:
        text = " ".join(html_lib.unescape("".join(b.parts)).split())
        if text:
            share = b.linked / max(1, b.total)
            odds = BIAS + b.odds + BLOCK_TAGS.get(b.tag, 0.0) + min(2.0, PER_100_CHARS * len(text) / 100)
            odds += LINK * share + (SHORT_LINK if share > 0.8 and len(text) < 40 else 0)
            odds += STOP if text[-1] in ".!?…:\"”»" else 0
            odds += COPYRIGHT if text.startswith(("©", "(c) ", "Copyright")) else 0
            out.append((text, b.place, odds))
    return out


def _distance(a: Place, b: Place) -> int:
    """Steps from one to the other in the tree; of blocks in page order, together no more than the tree has edges."""
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def smoothness(places: list[Place]) -> list[tuple[int, int, float]]:
    """Edges between blocks next to each other, and between neighbours under one parent."""
    edges, last = [], {}
    for i, p in enumerate(places):
        if i:
            edges.append((i - 1, i, ADJACENT + NEAR / (1 + _distance(places[i - 1], p))))
        j = last.get(p.parent)
        if j is not None and j != i - 1:
            edges.append((j, i, NEAR / (1 + _distance(places[j], p))))
        last[p.parent] = i
    return edges


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes are on the source's side of a minimum cut.

    A node with positive odds is tied to the source by them, one with negative odds to the sink; an
    edge of weight w can be cut in either direction for w. Shortest augmenting paths by levels.
    """
    n = len(odds)
    to, room, out = [], [], [[] for _ in range(n)]
    for a, b, w in edges:
        out[a].append(len(to))
        to.append(b)
        room.append(w)
        out[b].append(len(to))
        to.append(a)
        room.append(w)
    give = [max(0.0, x) for x in odds]
    take = [max(0.0, -x) for x in odds]
    tiny = 1e-9
    while True:
        level = [-1] * n
        queue = deque(i for i in range(n) if give[i] > tiny)
        for i in queue:
            level[i] = 0
        reached = False
        while queue:
            i = queue.popleft()
            if take[i] > tiny:
                reached = True
                continue
            for e in out[i]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[i] + 1
                    queue.append(to[e])
        if not reached:
            return [x >= 0 for x in level]
        nxt = [0] * n
        for s in range(n):
            while give[s] > tiny and level[s] == 0:
                trail, i = [], s
                while take[i] <= tiny:
                    while nxt[i] < len(out[i]):
                        e = out[i][nxt[i]]
                        if room[e] > tiny and level[to[e]] == level[i] + 1:
                            break
                        nxt[i] += 1
                    if nxt[i] == len(out[i]):
                        if not trail:
                            break
                        level[i] = -2
                        i = to[trail.pop() ^ 1]
                        continue
                    trail.append(out[i][nxt[i]])
                    i = to[trail[-1]]
                if take[i] <= tiny:
                    break
                f = min([give[s], take[i], *(room[e] for e in trail)])
                give[s] -= f
                take[i] -= f
                for e in trail:
                    room[e] -= f
                    room[e ^ 1] += f


def main_text(page: str | None) -> str:
    blocks = read_blocks(page or "")
    content = minimum_cut([o for _, _, o in blocks], smoothness([p for _, p, _ in blocks]))
    return "\n".join(t for (t, _, _), c in zip(blocks, content) if c)


def _extract(batches):
    for b in batches:
        texts = [main_text(h) for h in b.column("html").to_pylist()]
        keep = [n for n in b.schema.names if n != "html"]
        yield pa.RecordBatch.from_arrays([*(b.column(n) for n in keep), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text and n_chars in place of the html (and of columns of these names)."""
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars", "html")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{html}`").cast("string").alias("html"))
    schema = T.StructType([f for f in rows.schema.fields if f.name != "html"]).add("text", "string").add("n_chars", "long")
    return rows.mapInArrow(_extract, schema)


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
