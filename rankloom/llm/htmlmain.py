"""Main text of HTML pages by minimum cut.

A page becomes a row of text blocks.  A logistic classifier, fitted on pages that sitepages.py makes, looks at a
block's markup path, class tokens, link share and length; its log-odds are the capacities of the block's edges
to the two terminals.  Neighbours in page order, and blocks of one parent element, are tied by smoothness edges that grow
with how deep their common element lies.  The minimum cut labels all blocks of a page together.

Reading is linear in the page's size, whatever its markup: each element carries what its ancestors add up
to, and nothing looks back over the open elements.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, unused

_SPACE = re.compile(r"\s+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_PLAIN = re.compile(r"[^>\"']*")
_ATTR = re.compile(r"[\s/]*([^\s=/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_HIDDEN = re.compile(r"display\s*:\s*none", re.I)
#: Elements whose content is never text of the page.
SKIPPED = frozenset("script style noscript template svg math iframe object head select textarea button canvas audio video option datalist".split())
_RAW = {n: re.compile(rf"</{n}\s*>", re.I) for n in ("script", "style", "textarea", "title", "iframe", "noscript", "template")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr nobr".split())
#: An open p ends where one of these starts.
_ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements that end an open one of their kind, and those that such an end doesn't reach beyond.
_KIND = {"li": 0, "dt": 1, "dd": 1, "tr": 2, "td": 3, "th": 3, "p": 4}
_SCOPE = {"ul": (0,), "ol": (0,), "menu": (0,), "dl": (1,), "table": (2, 3), "tbody": (2, 3), "thead": (2, 3), "tfoot": (2, 3), "tr": (3,)}
_NONE = (-1,) * 5

#: Words of class, id, role and label tokens that name boilerplate, and words that name content.
BAD_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner promo promotion sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup share sharing social "
    "sidebar widget widgets related recommend recommended recommendations comment comments commentlist replies reply respond disqus nav navbar navigation menu breadcrumb breadcrumbs footer header masthead topbar toolbar pagination pager tags "
    "login search copyright legal disclaimer skip toc contentinfo complementary".split()
)
GOOD_WORDS = frozenset("article content post entry story body main text prose maincontent articlebody postcontent".split())
#: A token that starts so tells of a state or a subject, not of what the element is.
STATE_WORDS = frozenset("has with no is not without tag category cat type format status author lang theme js hentry single".split())
_ENDS = frozenset(".!?…。”\"'")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Marks that an element hands down to all text below it.
TAGS = ("article", "main", "nav", "footer", "aside", "header", "form", "menu", "dialog", "fieldset", "address", "table", "p", "li", "heading", "quote", "figcaption", "label", "td")
_TAG_OF = {**{t: t for t in TAGS}, **{f"h{k}": "heading" for k in range(1, 7)}, "blockquote": "quote", "pre": "quote", "dialog": "dialog", "th": "td"}
#: Those that describe a block's own nearest element, or one within the article, and not all below.
_RESET = {"article": ("header",), "main": ("header",)}
CLASS_MARKS = ("bad_token", "bad_last", "bad_first", "good_token", "good_part")
MARKS = (*TAGS, *CLASS_MARKS)
_BIT = {m: 1 << k for k, m in enumerate(MARKS)}
_STRUCTURE = _BIT["article"] | _BIT["main"]
_CLASS_BITS = sum(_BIT[m] for m in ("bad_token", "bad_last", "bad_first"))
SHAPES = ("bias", "link_share", "long", "log_length", "short", "sentence", "header_in_article")
FEATURES = (*SHAPES, *MARKS)
#: Smoothness in nats: between page neighbours, and the most that a deep common element adds.
NEXT_TIE, DOM_TIE = 0.3, 1.2
#: Capacities are whole multiples of this part of a nat, so cuts are exact.
UNIT = 1000
#: Log-odds are held within this many nats.
MOST = 20.0
#: Pages that the classifier is fitted on, and the strength of its penalty.
FIT_PAGES, PENALTY = 300, 1.0


class Element:
    """An open element: marks of its own and what it and its ancestors hand down."""

    __slots__ = ("at", "bits", "block", "depth", "far", "name", "near", "own", "parent", "size")

    def __init__(self, parent: Element | None, at: int, name: str, own: int):
        self.parent, self.at, self.name, self.own, self.size, self.far, self.bits = parent, at, name, own, 0, 0, 0
        self.depth = parent.depth + 1 if parent else 0
        self.block = at if name not in INLINE else parent.block if parent else -1
        near = list(parent.near if parent else _NONE)
        if name not in INLINE and name != "p":
            near[4] = -1
        for k in _SCOPE.get(name, ()):
            near[k] = -1
        if name in _KIND:
            near[_KIND[name]] = at
        self.near = tuple(near)


@dataclass
class Block:
    text: str
    linked: int
    element: Element
    #: Depth of the element that it has in common with the block before.
    common: int = 0
    bits: int = 0


def class_marks(tokens: str) -> int:
    """Bits for what the whole tokens of class, id, role and label say."""
    bits = 0
    for token in tokens.split():
        words = [w.lower() for w in _WORD.findall(token)]
        if not words or words[0] in STATE_WORDS:
            continue
        whole = "".join(words)
        if whole in BAD_WORDS:
            bits |= _BIT["bad_token"]
        elif words[-1] in BAD_WORDS:
            bits |= _BIT["bad_last"]
        elif words[0] in BAD_WORDS:
            bits |= _BIT["bad_first"]
        elif whole in GOOD_WORDS:
            bits |= _BIT["good_token"]
        elif words[-1] in GOOD_WORDS:
            bits |= _BIT["good_part"]
    return bits


def _attrs(tag: str) -> tuple[str, bool]:
    """The tokens that tell what an element is, and whether it is hidden."""
    found, hidden, at = [], False, 0
    while m := _ATTR.match(tag, at):
        at = m.end()
        name, value = m.group(1).lower(), (m.group(2) or "").strip("\"'")
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and _HIDDEN.search(value)):
            hidden = True
        elif name in ("class", "id", "role", "aria-label"):
            found.append(value)
    return " ".join(found), hidden


class _Scanner:
    """Finds where tags end.  A search that met the end of the page isn't made again, so all of them are linear together."""

    def __init__(self, page: str):
        self.page, self.gone = page, set()

    def find(self, what: str, at: int) -> int:
        if what in self.gone:
            return -1
        got = self.page.find(what, at)
        if got < 0:
            self.gone.add(what)
        return got

    def tag_end(self, at: int) -> int:
        """Behind the > of the tag whose name starts at `at`; quoted values may hold one.  -1: it isn't closed."""
        if self.find(">", at) < 0:
            return -1
        while True:
            at = _PLAIN.match(self.page, at).end()
            if at >= len(self.page):
                return -1
            if self.page[at] == ">":
                return at + 1
            close = self.find(self.page[at], at + 1)
            # A quote that isn't closed, or only beyond the last tag's end, is a character like others.
            at = close + 1 if close >= 0 and self.find(">", close) >= 0 else at + 1


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order, with white space made single and references decoded."""
    out: list[Block] = []
    root = Element(None, -1, "", 0)
    stack: list[Element] = []
    made: list[Element] = [root]
    opened: dict[str, list[int]] = {}
    scan = _Scanner(page)
    text: list[str] = []
    skip_at: int | None = None
    linked = at = low = 0
    holder = root

    def flush() -> None:
        nonlocal text, linked, low
        if text:
            whole = _SPACE.sub(" ", "".join(text)).strip()
            if whole:
                out.append(Block(whole, min(linked, len(whole)), holder, min(low, holder.depth)))
                low = holder.depth
        text, linked = [], 0

    def cut(n: int) -> None:
        nonlocal skip_at, low
        while len(stack) > n:
            opened[stack.pop().name].pop()
        low = min(low, n)
        if skip_at is not None and n <= skip_at:
            skip_at = None

    def put(part: str) -> None:
        nonlocal linked, holder
        if skip_at is None:
            if not text:
                holder = stack[-1] if stack else root
                holder = holder if holder.name not in INLINE else stack[holder.block] if holder.block >= 0 else root
            part = html.unescape(part)
            text.append(part)
            if opened.get("a"):
                linked += len(part.strip())

    while at < len(page):
        start = scan.find("<", at)
        if start < 0:
            put(page[at:])
            break
        if start > at:
            put(page[at:start])
        after = page[start + 1 : start + 2]
        if after in ("!", "?"):
            if page.startswith("<!--", start):
                end = scan.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(page)
            else:
                end = scan.find(">", start)
                at = end + 1 if end >= 0 else len(page)
            continue
        closing = after == "/"
        named = _NAME.match(page, start + 1 + closing) if scan.find(">", start) >= 0 else None
        end = scan.tag_end(named.end()) if named else -1
        if end < 0:
            put("<")
            at = start + 1
            continue
        name, inside, at = named.group().lower(), page[named.end() : end - 1], end
        if closing:
            if opened.get(name):
                i = opened[name][-1]
                if stack[-1].block >= i:
                    flush()
                cut(i)
            elif name == "p":
                flush()
            continue
        if name in VOID:
            if name == "br":
                if skip_at is None and text:
                    text.append(" ")
            elif name == "hr":
                flush()
            continue
        if name not in INLINE:
            flush()
            near = stack[-1].near if stack else _NONE
            if name in _KIND and name != "p" and near[_KIND[name]] >= 0:
                cut(near[_KIND[name]])
            elif name in _ENDS_P and near[4] >= 0:
                cut(near[4])
        if name in _RAW and not inside.endswith("/"):
            end = _RAW[name].search(page, at) if name not in scan.gone else None
            if not end:
                scan.gone.add(name)
            at = end.end() if end else len(page)
            continue
        if inside.endswith("/"):
            continue
        marks, hidden = _attrs(inside) if inside.strip() else ("", False)
        own = _BIT.get(_TAG_OF.get(name, ""), 0) | (class_marks(marks) if marks and name not in ("html", "body") else 0)
        stack.append(Element(stack[-1] if stack else root, len(stack), name, own))
        made.append(stack[-1])
        opened.setdefault(name, []).append(len(stack) - 1)
        if skip_at is None and (name in SKIPPED or hidden):
            skip_at = len(stack) - 1
        if name == "body" and skip_at is not None:  # an unclosed head ends here
            skip_at = None
    flush()
    _hand_down(out, made)
    return out


def _hand_down(found: list[Block], made: list[Element]) -> None:
    """Each block's marks: those of its element and its ancestors.

    Class tokens of an element that holds nearly all of the page's text, or most of it with its article or first heading, name
    the page and not a part of it, and count for nothing.
    """
    for b in found:
        b.element.size += len(b.text)
    first = made[0]
    for e in reversed(made):  # parents come before their children
        if e.parent:
            e.parent.size += e.size
            e.parent.far |= e.far | (e.own & _STRUCTURE) | (1 << 62 if e.name == "h1" else 0)
    total = max(1, first.size)
    for e in made:
        own = e.own
        if own & _CLASS_BITS and (10 * e.size > 9 * total or (2 * e.size > total and (e.far or e.own & _STRUCTURE))):
            own &= ~_CLASS_BITS
        up = e.parent.bits if e.parent else 0
        if e.name in _RESET:
            up &= ~sum(_BIT[m] for m in _RESET[e.name])
        e.bits = up | own
    for b in found:
        b.bits = b.element.bits


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block."""
    bits = np.array([b.bits for b in found], np.int64)
    n = np.array([len(b.text) for b in found])
    linked = np.array([b.linked for b in found])
    ended = np.array([b.text[-1] in _ENDS for b in found])
    header = len(SHAPES) + MARKS.index("header")
    inner = ((bits & _BIT["header"]) > 0) & ((bits & _STRUCTURE) > 0)
    shapes = (np.ones(len(n)), linked / n, np.minimum(1.0, n / 200), np.log1p(n) / 7, n < 25, ended & (n > 25), inner)
    out = np.concatenate([np.stack(shapes, axis=1), bits[:, None] >> np.arange(len(MARKS)) & 1], axis=1).astype(float)
    out[inner, header] = 0  # the header of an article isn't that of the page
    return out


@lru_cache(maxsize=4)
def fitted(n_pages: int = FIT_PAGES, seed: int = 1) -> np.ndarray:
    """Weights of FEATURES: logistic regression by Newton's method on n_pages labelled pages that sitepages.py makes."""
    from .sitepages import labelled_pages

    rows, truth = [], []
    for page, content in labelled_pages(n_pages, seed):
        found = blocks(page)
        rows.append(features(found))
        truth += [b.text in content for b in found]
    x, y = np.concatenate(rows), np.array(truth, float)
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -MOST, MOST)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + PENALTY * np.eye(len(w)), x.T @ (y - p) - PENALTY * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def ties(found: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges (i, j, capacity): page neighbours, and blocks of one parent element.

    The deeper the common element lies, as a part of the deeper block's own depth, the stronger the tie.
    """
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for j, b in enumerate(found):
        if j:
            deep = max(1, b.element.depth, found[j - 1].element.depth)
            edges[j - 1, j] = NEXT_TIE + DOM_TIE * (b.common / deep) ** 2
        parent = b.element.parent or b.element
        i = last.get(id(parent), j - 1)
        if i < j - 1:
            edges[i, j] = DOM_TIE / 2 * (parent.depth / max(1, b.element.depth)) ** 2
        last[id(parent)] = j
    return [(i, j, round(c * UNIT)) for (i, j), c in edges.items()]


def _settled(costs: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> tuple[list[bool], list[tuple[int, int]], list[tuple[int, int, int]], list[int]]:
    """Labels of nodes that every minimum cut agrees on, and the graph of the others: costs, edges, and which they are.

    A node whose costs differ by more than all its edges together has the cheaper label whatever its neighbours have; its edges
    become costs of theirs.
    """
    n = len(costs)
    lean, open_ties = [a - b for a, b in costs], [0] * n
    near: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for i, j, c in edges:
        near[i].append((j, c))
        near[j].append((i, c))
        open_ties[i] += c
        open_ties[j] += c
    done = [False] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if done[i] or abs(lean[i]) <= open_ties[i]:
            continue
        done[i] = True
        for j, c in near[i]:
            if not done[j]:
                open_ties[j] -= c
                lean[j] += c if lean[i] > 0 else -c
                queue.append(j)
    rest = [i for i in range(n) if not done[i]]
    place = {i: k for k, i in enumerate(rest)}
    left = [(place[i], place[j], c) for i, j, c in edges if i in place and j in place] if rest else []
    return [d and x > 0 for d, x in zip(done, lean, strict=True)], [(max(0, lean[i]), max(0, -lean[i])) for i in rest], left, rest


def min_cut(costs: list[tuple[int, int]], edges: list[tuple[int, int, int]]) -> list[bool]:
    """costs: (capacity from the source, capacity to the sink) per node; True for nodes on the source's side.

    Dinic's algorithm on integer capacities; of several minimum cuts it gives the one nearest the source.
    """
    chosen, costs, edges, rest = _settled(costs, edges)
    if not rest:
        return chosen
    n = len(costs)
    s, t = n, n + 1
    to: list[int] = []
    cap: list[int] = []
    adj: list[list[int]] = [[] for _ in range(n + 2)]

    def link(a: int, b: int, c: int, back: int) -> None:
        adj[a].append(len(to))
        to.append(b)
        cap.append(c)
        adj[b].append(len(to))
        to.append(a)
        cap.append(back)

    for i, (a, b) in enumerate(costs):
        direct = min(a, b)
        if a > direct:
            link(s, i, a - direct, 0)
        if b > direct:
            link(i, t, b - direct, 0)
    for i, j, c in edges:
        link(i, j, c, c)
    while True:
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for e in adj[u]:
                if cap[e] and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[t] < 0:
            for i, lv in zip(rest, level[:n], strict=True):
                chosen[i] = lv >= 0
            return chosen
        nxt = [0] * (n + 2)
        path: list[int] = []
        u = s
        while True:
            if u == t:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                keep = next(k for k, e in enumerate(path) if not cap[e])
                u = to[path[keep] ^ 1]
                del path[keep:]
                continue
            while nxt[u] < len(adj[u]):
                e = adj[u][nxt[u]]
                if cap[e] and level[to[e]] == level[u] + 1:
                    break
                nxt[u] += 1
            if nxt[u] < len(adj[u]):
                e = adj[u][nxt[u]]
                path.append(e)
                u = to[e]
            elif not path:
                break
            else:
                level[u] = -1
                u = to[path.pop() ^ 1]


def main_text(page: str | None, weights: np.ndarray | None = None) -> str:
    """Content blocks of a page, one a line; empty if it has none."""
    found = blocks(page or "")
    if not found:
        return ""
    odds = np.clip(features(found) @ (fitted() if weights is None else weights), -MOST, MOST)
    costs = np.rint(odds * UNIT).astype(int).tolist()
    labels = min_cut([(max(0, c), max(0, -c)) for c in costs], ties(found))
    return "\n".join(b.text for b, keep in zip(found, labels, strict=True) if keep)


def extracted(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """pages without html_col, with the main text of each in out.

    A null or empty page has an empty text.  Pages of any size are read whole; unclosed and stray
    tags, and anything else, are read without failing; repeated rows stay; an empty table gives no rows.
    A column that is already called out is replaced; other columns may have any names.
    """
    ship(pages.sparkSession)
    names = [c for c in pages.columns if c not in (html_col, out)]
    (own,) = unused([*names, out], "own_html")
    given = pages.select(*names, F.col(html_col).alias(own))
    schema = given.drop(own).withColumn(out, F.lit("")).schema
    weights = fitted()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py(), weights) for h in batch.column(len(names))], pa.string())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(names))], texts], [*names, out])

    return given.mapInArrow(run, schema)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page; nulls and odd markup: see extracted()."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extracted(pages).withColumn("n_chars", F.length("text").cast("long"))
