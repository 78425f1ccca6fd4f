"""Operator 10: HTML main text by minimum-cut labelling.

A tolerant reader turns a page into text blocks with their place in the DOM. A linear classifier gives each block a
cost for being content and one for being boilerplate; these are the terminal capacities. Blocks that follow each other,
that share a parent, or that are the next block of the same parent are joined by smoothness edges. The minimum cut
(max-flow) is the labelling of least total cost. Blocks whose terminal difference exceeds all their edges are settled
first (that never changes the cut), the rest is solved by Dinic's algorithm.

What markup says of a block (an article around it, a navigation element, a boilerplate name) outweighs its edges, so such
blocks are settled by their terminals. Blocks of which markup says nothing have what their text says, log odds
of a linear discriminant fitted to the marked blocks of about FIT_PAGES pages (pages by hash; the only sample
here), and edges of the same order: whether a short paragraph or a list belongs to the article is decided by the flow. Where
the sample lacks marked blocks of either kind, fixed weights stand in.

The sample's sums are the only thing that reaches the driver. No shuffle; a page is a row of bounded batches.

Defined results: NULL or empty html, or a page without content, gives empty text; an unfinished tag at the end is
dropped, unfinished elements end with the page; '<' before anything but an ASCII letter, '/', '!' or '?' is text, and
'</' before anything but an ASCII letter is a comment up to the next '>'; repeated rows are extracted row by row; an empty table gives no
rows; columns other than id, url and html are ignored.
"""

from __future__ import annotations

import functools
import html as entities
import math
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element kinds of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog",
         "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5",
         "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre",
         "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
ENDS_P = BLOCK - {"button", "option", "caption", "legend", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "head",
                  "html"}
SIBLING_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"},
                "td": {"td", "th"}, "th": {"td", "th"}}
SCOPE = {"ul", "ol", "table", "div", "article", "section", "body", "main", "aside", "nav", "dl", "select", "td", "th"}
# Elements and name parts that mark boilerplate or content.
BOILERPLATE_TAGS = {"nav", "aside", "footer", "form", "button", "select", "menu", "dialog", "head", "search", "option",
                    "svg", "canvas", "object", "audio", "video", "fieldset"}
BOILERPLATE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "menu", "menubar", "dialog",
                     "alert", "alertdialog", "form", "toolbar", "tablist"}
BOILERPLATE_NAMES = {"ad", "adbox", "ads", "adsense", "adslot", "adunit", "adv", "advert", "advertisement", "advertising",
                     "adverts", "alert", "alerts", "aside", "banner", "banners", "breadcrumb", "breadcrumbs", "comment",
                     "comments", "consent", "cookie", "cookies", "copyright", "disclaimer", "discussion", "disqus",
                     "footer", "form", "gdpr", "login", "masthead", "menu", "menus", "modal", "nav", "navbar",
                     "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo",
                     "promotion", "rail", "recommended", "related", "replies", "reply", "respond", "responses", "share",
                     "sharing", "sidebar", "sidebars", "signup", "skip", "social", "sponsor", "sponsored", "subscribe",
                     "tags", "toolbar", "widget", "widgets"}
TALK_NAMES = {"comment", "comments", "discussion", "disqus", "replies", "reply", "respond", "responses"}
OUTSIDE_NAMES = {"header", "topbar"}                    # boilerplate only outside the article
CONTENT_TAGS = {"article", "main"}
CONTENT_NAMES = {"article", "body", "content", "entry", "main", "post", "story", "text"}
# Weights of markup (positive speaks for content), of text where nothing can be fitted, and of edges.
W_BOILERPLATE, W_CONTENT, W_NAMED, W_MARKED = -40.0, 14.0, 4.0, -24.0
W_PLAIN, W_ELSEWHERE = 2.0, -3.0                        # no markup speaks: on a page without, and with article text
W_TEXT = (0.5, -4.0, 0.75, 1.0, 1.75)                    # as FEATURES
E_NEXT, E_PARENT, E_SIBLING = 1.2, 1.6, 0.8
MOST_TEXT = 4.0                                         # what the text can say at most, below what markup says
FIT_PAGES, FIT_BLOCKS = 2000, 50
FEATURES = 5                                            # constant, share of linked text, log length, full stop, heading

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
ATTR = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class _Node:
    __slots__ = ("tag", "parent", "weight", "bad", "link", "good", "mark", "outer", "words", "talk")

    def __init__(self, tag: str, attrs: str, parent: "_Node | None"):
        self.tag, self.parent = tag, parent
        self.bad = parent.bad if parent else False
        self.good = parent.good if parent else False
        self.link = (parent.link if parent else False) or tag == "a"
        self.weight = parent.weight if parent else 0.0
        # the nearest node from here up that bears a boilerplate name, and the nearest above the outermost article
        self.mark = parent.mark if parent else None
        self.outer = parent.outer if parent else None
        self.words, self.talk = frozenset(), False
        if tag in CONTENT_TAGS:
            self.good = True
        # a header inside the article holds its title; elsewhere it is the page's
        if tag in BOILERPLATE_TAGS or (tag == "header" and not self.good):
            self.bad = True
        if attrs and "=" in attrs:
            for m in ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name == "role":
                    self.bad |= value.lower() in BOILERPLATE_ROLES
                    self.good |= value.lower() in ("main", "article")
                elif name in ("class", "id") and tag not in ("html", "body", "article", "main"):
                    words = {p.lower() for p in PARTS.findall(value)}
                    self.words |= words & (BOILERPLATE_NAMES if self.good else BOILERPLATE_NAMES | OUTSIDE_NAMES)
                    self.talk |= not TALK_NAMES.isdisjoint(value.lower().split())
                    if words & CONTENT_NAMES:
                        self.weight += W_NAMED
                elif name == "aria-hidden":
                    self.bad |= value.lower() == "true"
            self.bad |= bool(re.search(r"\bhidden\b(?!\s*=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs)))
            self.bad |= bool(re.search(r"display\s*:\s*none", attrs))
        if self.good and not (parent and parent.good):
            self.outer = self.mark
        if self.words:
            self.mark = self


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node: _Node, text: str, linked: int):
        self.node, self.text, self.linked = node, text, linked


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order: runs of text between block-level tags, white space folded."""
    root = _Node("#", "", None)
    stack, out = [root], []
    run: list[str] = []
    linked, holder, at, size = 0, root, 0, len(page)

    def flush():
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                out.append(Block(holder, text, linked))
        run, linked = [], 0

    def say(raw: str):
        nonlocal linked, holder
        text = entities.unescape(raw) if "&" in raw else raw
        node = stack[-1]
        if not run or not any(x.strip() for x in run):
            holder = node
            while holder.parent is not None and holder.tag not in BLOCK:
                holder = holder.parent
        run.append(text)
        if node.link:
            linked += len("".join(text.split()))

    def close(tags, scope=frozenset()):
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                flush()
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        if lt > at:
            say(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = size if end < 0 else end + 3
            continue
        nxt = page[lt + 1:lt + 2]
        if nxt in ("!", "?"):
            end = page.find(">", lt)
            at = size if end < 0 else end + 1
            continue
        m = TAG.match(page, lt) or LOOSE.match(page, lt)
        if not m:
            first = page[lt + 2:lt + 3] if nxt == "/" else nxt
            if first.isascii() and first.isalpha():
                break                                   # an unfinished tag (no '>' is left) ends the page
            if nxt == "/" and first:                    # as in HTML: a comment up to the next '>'
                end = page.find(">", lt + 2)
                at = size if end < 0 else end + 1
                continue
            say("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not any(n.tag == "p" for n in stack):
                flush()
            elif tag in BLOCK:
                close({tag})
            else:
                for i in range(len(stack) - 1, 0, -1):  # inline: close it, but not across a block
                    if stack[i].tag == tag:
                        del stack[i]
                        break
                    if stack[i].tag in BLOCK:
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
            if end is None:
                break
            gt = page.find(">", end.start())
            at = size if gt < 0 else gt + 1
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in ENDS_P:
            close({"p"}, SCOPE)
        if tag in SIBLING_ENDS:
            close(SIBLING_ENDS[tag], SCOPE - SIBLING_ENDS[tag])
        if tag in BLOCK:
            flush()
            while stack[-1].tag not in BLOCK and len(stack) > 1:
                stack.pop()                             # an open inline element does not hold blocks
        if m[3].rstrip().endswith("/") and tag in ("svg", "path", "use", "g"):
            continue
        stack.append(_Node(tag, m[3], stack[-1]))
    flush()
    return out


def marked(blocks: list[Block]) -> list[bool]:
    """Per block: whether a boilerplate name stands against it.

    A name says nothing where it holds more than half of the page's unlinked text, in one element or in all that bear
    it (wrappers such as has-sidebar, builders that call every block a widget). The names around an article or main
    element count for its blocks only if the page has other article text without names, as comments that are articles
    of their own. A discussion (a class or id that is just such a name) stays one beside article text, however long."""
    size = [0 if b.node.bad else max(0, len(b.text.replace(" ", "")) - b.linked) for b in blocks]
    half = sum(size) / 2
    held: dict[_Node, int] = {}                         # the named nodes, outer ones first
    for b in blocks:
        chain, node = [], b.node.mark
        while node is not None and node not in held:
            chain.append(node)
            node = node.parent.mark
        held.update(dict.fromkeys(reversed(chain), 0))
    if not held:
        return [False] * len(blocks)
    named = list(held)
    for b, n in zip(blocks, size):
        if b.node.mark:
            held[b.node.mark] += n
    own = dict(held)
    for node in reversed(named):
        if node.parent.mark:
            held[node.parent.mark] += held[node]
    void = {node for node in named if held[node] > half}
    spread: dict[str, int] = {}
    words: dict[_Node | None, frozenset] = {None: frozenset()}
    for node in named:
        words[node] = words[node.parent.mark] | (frozenset() if node in void else node.words)
        for word in words[node]:
            spread[word] = spread.get(word, 0) + own[node]
    void |= {node for node in named if all(spread.get(word, 0) > half for word in node.words)}

    def stands() -> tuple[dict, dict]:
        """Whether a name stands from each node up: inside the outermost article, and on the whole page."""
        inside, whole = {None: False}, {None: False}
        for node in named:
            up = node.parent.mark
            inside[node] = node not in void or up is not node.outer and inside[up]
            whole[node] = node not in void or whole[up]
        return inside, whole

    talk = {None: False}
    for node in named:
        talk[node] = node.talk or talk[node.parent.mark]
    _, whole = stands()
    if any(n and b.node.good and not whole[b.node.mark] and not talk[b.node.mark] for b, n in zip(blocks, size)):
        void = {node for node in void if not node.talk}
    inside, whole = stands()
    beside = any(n and b.node.good and not whole[b.node.mark] for b, n in zip(blocks, size))
    return [b.node.mark is not b.node.outer and inside[b.node.mark] or beside and whole[b.node.outer] for b in blocks]


def features(b: Block) -> list[float]:
    """What the text of a block says, apart from markup around it."""
    return [1.0, b.linked / max(1, len(b.text.replace(" ", ""))), math.log2(1 + len(b.text)) - 5,
            float(b.text[-1] in ".!?…。:\"'»”"), float(b.node.tag in ("h1", "h2", "h3", "h4", "h5", "h6"))]


def costs(blocks: list[Block], weights: tuple[float, ...] = W_TEXT) -> list[float]:
    """Per block: the cost of calling it boilerplate minus the cost of calling it content."""
    named = marked(blocks)
    article = any(b.node.good and not b.node.bad and not m for b, m in zip(blocks, named))
    out = []
    for b, m in zip(blocks, named):
        score = b.node.weight + (W_CONTENT if b.node.good else 0.0)
        if b.node.bad:
            score += W_BOILERPLATE
        if m:
            score += W_MARKED
        if not (b.node.good or b.node.bad or m or b.node.weight):
            score += W_ELSEWHERE if article else W_PLAIN
        text = sum(w * x for w, x in zip(weights, features(b)))
        out.append(score + max(-MOST_TEXT, min(MOST_TEXT, text)))
    return out


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, sums and products of the features of the marked blocks, for boilerplate (0) and content (1)."""
    n, total, product = np.zeros(2), np.zeros((2, FEATURES)), np.zeros((2, FEATURES, FEATURES))
    for b in batches:
        for page in b.column("html").to_pylist():
            blocks = blocks_of(page or "")
            for block, m in zip(blocks, marked(blocks)):
                bad = block.node.bad or m
                if bad or block.node.good:
                    k, x = int(not bad), np.array(features(block))
                    n[k] += 1
                    total[k] += x
                    product[k] += np.outer(x, x)
    for k in (0, 1):
        yield pa.RecordBatch.from_arrays(
            [pa.array([k]), pa.array([n[k]]), pa.array([total[k].tolist()]), pa.array([product[k].reshape(-1).tolist()])],
            ["k", "n", "total", "product"])


def discriminant(n: np.ndarray, total: np.ndarray, product: np.ndarray) -> tuple[float, ...]:
    """Weights whose product with the features is the log odds of content, for two normal classes of one covariance and
    equal shares; the fixed ones if a class has too few blocks."""
    if min(n) < FIT_BLOCKS:
        return W_TEXT
    mean = total[:, 1:] / n[:, None]
    spread = sum(product[k][1:, 1:] - n[k] * np.outer(mean[k], mean[k]) for k in (0, 1)) / n.sum()
    w = np.linalg.solve(spread + 0.05 * np.eye(FEATURES - 1), mean[1] - mean[0])
    return (float(-w @ (mean[0] + mean[1]) / 2), *map(float, w))


def fit(pages: DataFrame, html: str = "html", most: int = FIT_PAGES) -> tuple[float, ...]:
    """Text weights from the marked blocks of about ``most`` pages, chosen by a hash of their html."""
    count = pages.count()
    if not count:
        return W_TEXT
    part = min(1.0, most / count)
    some = pages.filter(F.pmod(F.xxhash64(F.col(html)), F.lit(1 << 20)) < int(part * (1 << 20))).select(
        F.col(html).cast("string").alias("html"))
    sums = some.mapInArrow(_sums, "k long, n double, total array<double>, product array<double>")
    n, total, product = np.zeros(2), np.zeros((2, FEATURES)), np.zeros((2, FEATURES, FEATURES))
    each = [F.sum(F.element_at("total", i + 1)).alias(f"t{i}") for i in range(FEATURES)]
    each += [F.sum(F.element_at("product", i + 1)).alias(f"p{i}") for i in range(FEATURES ** 2)]
    for r in sums.groupBy("k").agg(F.sum("n").alias("n"), *each).collect():
        n[r["k"]] = r["n"]
        total[r["k"]] = [r[f"t{i}"] for i in range(FEATURES)]
        product[r["k"]] = np.array([r[f"p{i}"] for i in range(FEATURES ** 2)]).reshape(FEATURES, FEATURES)
    return discriminant(n, total, product)


def edges(blocks: list[Block]) -> dict[tuple[int, int], float]:
    """Smoothness edges: neighbours in the page, more if they share a parent, and next blocks of one parent."""
    out: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        parent = id(b.node.parent)
        if i:
            out[i - 1, i] = E_NEXT + (E_PARENT if id(blocks[i - 1].node.parent) == parent else 0.0)
        j = last.get(parent)
        if j is not None and j != i - 1:
            out[j, i] = E_SIBLING
        last[parent] = i
    return out


def min_cut(gain: list[float], edge: dict[tuple[int, int], float]) -> list[bool]:
    """True for content: the labelling of least cost sum(gain lost) + sum(edges cut). Ties go to boilerplate."""
    n = len(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for (a, b), w in edge.items():
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    gain = list(gain)
    label: list[bool | None] = [None] * n
    todo = deque(range(n))
    while todo:                                         # settle blocks that no neighbour can turn
        i = todo.popleft()
        if label[i] is None and abs(gain[i]) > sum(near[i].values()):
            label[i] = gain[i] > 0
            for j, w in near[i].items():
                gain[j] += w if label[i] else -w
                del near[j][i]
                todo.append(j)
            near[i] = {}
    left = [i for i in range(n) if label[i] is None]
    if left:
        content = _dinic(left, gain, near)
        for i in left:
            label[i] = i in content
    return [bool(x) for x in label]


def _dinic(nodes: list[int], gain: list[float], near: list[dict[int, float]]) -> set[int]:
    """Nodes on the source side after a maximum flow from source (content) to sink (boilerplate)."""
    index = {v: k + 2 for k, v in enumerate(nodes)}
    to, room, out = [], [], [[] for _ in range(len(nodes) + 2)]

    def arc(a, b, c, back):
        out[a].append(len(to))
        to.append(b)
        room.append(c)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for v in nodes:
        if gain[v] > 0:
            arc(0, index[v], gain[v], 0.0)
        elif gain[v] < 0:
            arc(index[v], 1, -gain[v], 0.0)
        for u, w in near[v].items():
            if u > v and u in index:
                arc(index[v], index[u], w, w)
    while True:
        level = [-1] * len(out)
        level[0] = 0
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for e in out[u]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[u] + 1
                    queue.append(to[e])
        if level[1] < 0:
            return {v for v in nodes if level[index[v]] >= 0}
        turn = [0] * len(out)
        path: list[int] = []
        u = 0
        while True:                                     # augment along the level graph, depth first
            if u == 1:
                push = min(room[e] for e in path)
                for e in path:
                    room[e] -= push
                    room[e ^ 1] += push
                path, u = [], 0
                continue
            while turn[u] < len(out[u]):
                e = out[u][turn[u]]
                if room[e] > 1e-9 and level[to[e]] == level[u] + 1:
                    break
                turn[u] += 1
            if turn[u] < len(out[u]):
                path.append(out[u][turn[u]])
                u = to[path[-1]]
            elif u == 0:
                break
            else:
                e = path.pop()
                u = to[e ^ 1]
                turn[u] += 1


def main_text(page: str | None, weights: tuple[float, ...] = W_TEXT) -> str:
    """The main text of a page: content blocks in page order, joined by blank lines."""
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    keep = min_cut(costs(blocks, weights), edges(blocks))
    return "\n\n".join(b.text for b, k in zip(blocks, keep) if k)


def _extract(weights: tuple[float, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(h, weights) for h in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
            fit_pages: int = FIT_PAGES) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points). ``fit_pages`` bounds the sample the text weights are
    fitted to."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    weights = fit(rows, "html", fit_pages)
    return rows.mapInArrow(functools.partial(_extract, weights), "page_id long, url string, text string, n_chars long")
