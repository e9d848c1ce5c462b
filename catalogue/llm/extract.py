"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A logistic classifier gives each block the cost of calling it content and the cost
of calling it boilerplate; these are its terminal capacities in a flow network. Blocks that follow each other, and
blocks that follow each other inside the same container, are tied by smoothness edges whose capacity falls with their
distance in the document tree. The minimum cut labels all blocks of the page at once.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from .workers import map_batches

# fixed values: element names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noscript".split())
#: elements whose text is no part of the page's, with ordinary elements inside; their closing tag may be missing
UNREAD = frozenset("template svg select".split())
FOREIGN = frozenset(("svg", "math"))
SELF_CLOSED = FOREIGN | {"iframe", "noscript"}
BLOCK = frozenset("address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
#: an open element of the first kind ends where one of the second begins
ENDED_BY = {"p": BLOCK - {"br", "button"}, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")),
            "tr": frozenset(("tr", "tbody", "tfoot")), "td": frozenset(("td", "th", "tr")), "th": frozenset(("td", "th", "tr")),
            "option": frozenset(("option",)), "head": frozenset(("body",))}
CONTAINERS = frozenset("article aside body div footer form header main nav ol section table ul".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>|<[!?/][^>]*>""", re.S)
#: a tag whose quotes are never closed ends at its first angle bracket
BROKEN = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: declarations of a style that take an element out of sight
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)", re.I)
#: a name with one of these words tells of the state or layout of something else
STATE = frozenset("no not non has have with without hide show is js open opened closed collapsed expanded enabled disabled active visible".split())
WORDS = re.compile(r"[_-]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")

#: words in class, id or role that speak against and for content
AGAINST = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|sidebar|side|menu|nav\w*|breadcrumbs?|footer|masthead|pagination|pager|"
                     r"cookies?|consent|notice|popup|modal|share|sharing|social|related|recommend\w*|newsletter|subscri\w+|login|signup|widget|"
                     r"toolbar|search|contentinfo|complementary)(?:$|[\s_-])", re.I)
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus\w*|replies|respond|reactions?)(?:$|[\s_-])", re.I)
FOR = re.compile(r"(?:^|[\s_-])(?:article\w*|post|entry|story|content|main|body|text)(?:$|[\s_-])", re.I)

#: weights of the classifier
BIAS = -1.0
BY_ANCESTOR = {"article": 5.0, "main": 4.0, "nav": -8.0, "footer": -8.0, "aside": -7.0, "form": -7.0, "menu": -8.0, "header": -6.0, "button": -6.0, "dialog": -6.0}
BY_BLOCK = {"p": 1.5, "h1": 1.0, "h2": 0.8, "h3": 0.8, "h4": 0.5, "pre": 1.0, "blockquote": 1.0, "td": 0.0, "li": -0.3}
HEADER_IN_ARTICLE, W_AGAINST, W_COMMENTS, W_FOR, W_HIDDEN = -1.5, -6.0, -12.0, 1.5, -12.0
PER_LOG_WORD, MOST_FOR_LENGTH, LINK_SHARE, STOPPED = 0.5, 2.5, -4.0, 0.5
#: smoothness between neighbours at tree distance 0, and between followers in one container
ADJACENT, SAME_CONTAINER = 0.8, 0.6
SCALE = 1000

OUT = "page_id long, url string, text string, n_chars long"


class Block:
    __slots__ = ("text", "path", "container", "score")

    def __init__(self, text, path, container, score):
        self.text, self.path, self.container, self.score = text, path, container, score


class _Open:
    """An open element: its name, number, and what it adds to the score of the blocks inside."""

    __slots__ = ("name", "number", "score")

    def __init__(self, name, number, score):
        self.name, self.number, self.score = name, number, score


def _weight(name: str, attributes: str, in_article: bool) -> float:
    score = BY_ANCESTOR.get(name, 0.0)
    if name == "header" and in_article:
        score = HEADER_IN_ARTICLE
    if attributes:
        named: dict[str, str] = {}
        for key, *values in ATTRIBUTE.findall(attributes):
            named.setdefault(key.lower(), html.unescape("".join(values)))
        hints = " ".join(t for k in ("class", "id", "role") for t in named.get(k, "").split() if STATE.isdisjoint(WORDS.split(t.lower())))
        if hints and name not in ("html", "body"):  # those name the page, not a part of it
            if COMMENTS.search(hints):
                score += W_COMMENTS
            elif AGAINST.search(hints):
                score += W_AGAINST
            elif FOR.search(hints):
                score += W_FOR
        if "hidden" in named and named["hidden"].strip().lower() != "until-found" or named.get("aria-hidden", "").strip().lower() == "true" \
                or UNSEEN.search(named.get("style", "")):
            score += W_HIDDEN
    return score


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order; scripts, styles and other raw elements have none."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[str] = []
    linked, number, at = 0, 0, 0
    links = 0  # open <a>
    unread = 0  # open elements of UNREAD

    def flush():
        nonlocal linked
        if parts:
            text = SPACE.sub(" ", html.unescape("".join(parts))).strip(" ")
            if text:
                container = next((e.number for e in reversed(stack) if e.name in CONTAINERS), 0)
                holder = next((e.name for e in reversed(stack) if e.name in BLOCK), "")
                words = text.count(" ") + 1
                score = BIAS + sum(e.score for e in stack) + BY_BLOCK.get(holder, 0.0) + LINK_SHARE * min(1.0, linked / len(text))
                score += min(MOST_FOR_LENGTH, PER_LOG_WORD * math.log2(words))
                score += STOPPED * (text[-1] in ".!?…。！？")
                out.append(Block(text, tuple(e.number for e in stack if e.name in BLOCK), container, score))
            parts.clear()
        linked = 0

    while True:
        lt = page.find("<", at)
        if lt < 0:
            lt = len(page)
        if lt > at:
            piece = page[at:lt]
            if not unread:
                parts.append(piece)
            if links and not unread:
                linked += len(piece)
        if lt >= len(page):
            break
        tag = TAG.match(page, lt) or BROKEN.match(page, lt)
        if tag is None:
            if page[lt + 1:lt + 2].isalpha() or page[lt + 1:lt + 2] in ("/", "!", "?"):
                break  # a tag cut short by the end of the page
            if not unread:
                parts.append("<")
            at = lt + 1
            continue
        at = tag.end()
        name = tag.group(2)
        if not name:
            continue
        name = name.lower()
        if name in BLOCK:
            flush()
        if tag.group(1):
            if any(e.name == name for e in stack):
                while True:
                    e = stack.pop()
                    links -= e.name == "a"
                    unread -= e.name in UNREAD
                    if e.name == name:
                        break
            continue
        if name in SELF_CLOSED and tag.group(3).endswith("/"):
            continue
        if name in RAW and not any(e.name in FOREIGN for e in stack):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if name in SELF_CLOSED and (not end or re.compile(rf"<{name}\b", re.I).search(page, at, end.start())):
                continue  # never closed: it ends with its parent
            at = end.end() if end else len(page)
            continue
        if unread and name in BLOCK:  # a select or svg never closed ends where a block begins
            k = next((i for i, e in enumerate(stack) if e.name in ("select", "svg")), None)
            if k is not None and all(e.name not in ("foreignobject", "template") for e in stack[k:]):
                unread -= sum(e.name in UNREAD for e in stack[k:])
                links -= sum(e.name == "a" for e in stack[k:])
                del stack[k:]
        while stack and name in ENDED_BY.get(stack[-1].name, ()):
            stack.pop()
        if name == "p" and any(e.name == "p" for e in stack):  # behind inline elements left open
            k = max(i for i, e in enumerate(stack) if e.name == "p")
            if all(e.name not in BLOCK for e in stack[k + 1:]):
                links -= sum(e.name == "a" for e in stack[k:])
                unread -= sum(e.name in UNREAD for e in stack[k:])
                del stack[k:]
        if name in VOID or tag.group(3).endswith("/") and name not in BLOCK:
            continue
        number += 1
        stack.append(_Open(name, number, _weight(name, tag.group(3), any(e.name in ("article", "main") for e in stack))))
        links += name == "a"
        unread += name in UNREAD
    flush()
    return out


def _distance(a: tuple, b: tuple) -> int:
    same = 0
    for x, y in zip(a, b):
        if x != y:
            break
        same += 1
    return len(a) + len(b) - 2 * same


def minimum_cut(surplus: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes end on the source's side of a minimum cut.

    ``surplus`` is what a node gets from the source (above zero) or gives to the sink (below); ``edges`` are
    (node, node, capacity either way). Flow is sent along shortest paths, all of one length at a time.
    """
    n = len(surplus)
    source, sink = n, n + 1
    to: list[int] = []
    room: list[int] = []
    near: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, forth: int, back: int) -> None:
        near[a].append(len(to))
        to.append(b)
        room.append(forth)
        near[b].append(len(to))
        to.append(a)
        room.append(back)

    for v, s in enumerate(surplus):
        if s > 0:
            connect(source, v, s, 0)
        elif s < 0:
            connect(v, sink, -s, 0)
    for a, b, c in edges:
        if c > 0:
            connect(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque((source,))
        while queue:
            v = queue.popleft()
            for e in near[v]:
                if room[e] and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        turn = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                sent = min(room[e] for e in path)
                for e in path:
                    room[e] -= sent
                    room[e ^ 1] += sent
                k = next(i for i, e in enumerate(path) if not room[e])
                v = to[path[k] ^ 1]
                del path[k:]
                continue
            while turn[v] < len(near[v]):
                e = near[v][turn[v]]
                if room[e] and level[to[e]] == level[v] + 1:
                    break
                turn[v] += 1
            if turn[v] < len(near[v]):
                path.append(near[v][turn[v]])
                v = to[path[-1]]
            elif path:
                v = to[path.pop() ^ 1]
                turn[v] += 1
            else:
                break


def labels(found: list[Block]) -> list[bool]:
    """Content or not, for each block of a page."""
    if not found:
        return []
    surplus = []
    for b in found:
        z = max(-30.0, min(30.0, b.score))
        as_boilerplate, as_content = math.log1p(math.exp(z)), math.log1p(math.exp(-z))
        surplus.append(round(SCALE * (as_boilerplate - as_content)))
    edges, last = [], {}
    for k, b in enumerate(found):
        if k:
            edges.append((k - 1, k, round(SCALE * ADJACENT / (1 + _distance(found[k - 1].path, b.path)))))
        if b.container in last and last[b.container] != k - 1:
            before = last[b.container]
            edges.append((before, k, round(SCALE * SAME_CONTAINER / (1 + _distance(found[before].path, b.path)))))
        last[b.container] = k
    return minimum_cut(surplus, edges)


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    return "\n".join(b.text for b, keep in zip(found, labels(found)) if keep)


def _extracted(batches):
    import pyarrow as pa

    for batch in batches:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Character references are decoded, white space inside a block becomes one space, and blocks are joined by line feeds
    in page order. A null or empty page, and one without content, has an empty text. Markup that is cut short counts as
    far as it goes; page_id and url may be null or repeat. An empty table gives no rows; further columns are ignored.
    """
    return map_batches(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html")), _extracted, OUT)
