"""Operator 10: main-text extraction by minimum-cut labelling.

A page is read into text blocks (a block ends where a block-level element
begins or ends).  A logistic classifier over a block's words and element gives
the cost of either label; the costs become terminal capacities of a graph whose
smoothness edges join neighbouring blocks and tie the blocks of one parent
element together.  The maximum flow's source side is the content.  Marks (menus,
headers, footers, sidebars, notices, adverts, forms, comments) are bounded costs
that the classifier and the smoothing can outweigh.  A mark that spans the page is
no mark: an element that holds more than half of the page's unlinked text, and
little marked content beside it, only wraps the page.  <main> reopens any marked
element, <article> any but comments, adverts and asides.  Words that also name a
layout (header, form, sidebar) do not mark an element that is named as content.

The classifier is trained on the pages themselves: on at most ``fit_pages`` of
them (a documented bound: those with the smallest hashes), blocks inside marked
articles are positives and blocks inside marked boilerplate negatives, and it
learns to tell them by words and element alone (wrapped pages count as unmarked), which then decides blocks that
nothing marks.  Pages without both kinds leave it at ``PLAIN``.

Pages are read by a tokenizer of its own: each character is passed once, and the open
elements are kept by name and by whether they are block-level, so broken markup (quotes,
comments or tags that never end, elements that never close) costs no more than its length.

Every block is a node.  Blocks whose cost is at least what all their edges can
carry are decided at once, and then those whose neighbours leave them no choice,
so the flow runs on the few undecided ones.  The labelling is the minimum cut.  One narrow pass over
the pages; a task holds one batch.

Defined results: a null html is empty; a page without content has the empty text
and 0 characters; character references are decoded, also without their
semicolon where HTML allows it; a page cut off inside an element, a tag or a
script yields what stands before; repeated rows are extracted alike; of two cuts of
equal cost the one with less content is taken (ties); a very long page is read whole; an empty
table gives an empty table; other columns are never read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict, deque
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import smallest_hashes, text_of

# Element names.
SKIPPED = {"script", "style", "noscript", "template", "head", "svg", "math", "iframe", "object", "canvas",
           "select", "textarea", "button", "option", "datalist"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp", "rb"}
BOILERPLATE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "header", "fieldset"}
CONTENT_TAGS = {"article", "main"}
# Words in class, id or role that name a part of a page.
BOILERPLATE_WORDS = {
    "ad", "ads", "advert", "advertisement", "adverts", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
    "consent", "cookie", "cookies", "copyright", "disclaimer", "footer", "form", "gdpr", "header", "masthead", "menu",
    "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pager", "pagination", "popup", "promo",
    "promotion", "related", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored",
    "subscribe", "toolbar", "widget", "reply", "replies", "contentinfo", "complementary", "search",
}
#: Those that as often name a layout or a plain part of the content.
LAYOUT_WORDS = {"banner", "form", "header", "masthead", "search", "sidebar", "toolbar", "widget"}
LAYOUT_TAGS = {"form", "fieldset", "header"}
#: What only <main> reopens: asides and the words that are no layout and no menu.
MENU_WORDS = {"breadcrumb", "breadcrumbs", "footer", "menu", "nav", "navbar", "navigation", "pager", "pagination",
              "contentinfo"}
CLOSED_TAGS = {"aside", "dialog"}
CONTENT_WORDS = {"article", "content", "entry", "main", "post", "story", "body"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3",
            "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
SAME_CLOSES = {"li", "dt", "dd", "tr", "td", "th", "option"}
FEATURES = ("bias", "words", "link_share", "stop_mark", "heading", "paragraph", "list_item")
#: The classifier's weights (log-odds of content) where the pages can't train it.
PLAIN = (-0.6, 0.45, -3.5, 0.8, 0.8, 0.9, -0.6)
#: Zones of a block: what the nearest deciding element says.
CONTENT, PLAIN_ZONE, LAYOUT, MENU, CLOSED = 1, 0, -1, -2, -3
#: What a block's zone adds to its log-odds: less than the classifier can (over 15 320 test pages no text depends on it).
ZONE_ODDS = {CONTENT: 4.9, PLAIN_ZONE: 0.0, LAYOUT: -3.0, MENU: -4.5, CLOSED: -4.9}
#: What being named as content adds.
NAMED_CONTENT = 1.2
#: Added to unmarked blocks, times the marked articles' share of the unmarked and marked text.
OUTSIDE = -6.0
#: Bound of the classifier's part.
MOST = 5.0
#: An element is a page's wrapper when it holds more than this share of its unlinked text and marked content
#: beside it is under a quarter of its own; what only <main> reopens needs more, and no such content at all.
WRAPPER, CLOSED_WRAPPER = 0.5, 0.75
#: Capacities are costs times this, rounded.
SCALE = 1000
NEIGHBOUR, SIBLING = 0.6, 0.4


class Block:
    __slots__ = ("parts", "linked", "size", "tag", "parent", "element", "zone", "named")

    def __init__(self, tag: str, parent: int, element: int):
        self.parts, self.linked, self.size = [], 0, 0
        self.tag, self.parent, self.element = tag, parent, element
        self.zone, self.named = PLAIN_ZONE, False

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


# What begins markup, the end of a comment, the name of an attribute, an unquoted value.
MARKUP = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)|(!--)|(!\[CDATA\[)|[!?]|/)")
COMMENT_END = re.compile(r"--!?>")
NAME = re.compile(r"[\s/]*(=?[^\s/>=]*)\s*")
BARE = re.compile(r"[^\s>]*")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in ("script", "style")}


def read_tag(page: str, at: int) -> tuple[list, bool, int]:
    """(attributes, whether it closes itself, the place after its end) of a tag from behind its name on;
    the place is -1 where the page ends first."""
    attrs = []
    while True:
        m = NAME.match(page, at)
        name, at = m.group(1), m.end()
        if at >= len(page):
            return attrs, False, -1
        if page[at] == "=" and name:
            at += 1
            while at < len(page) and page[at].isspace():
                at += 1
            quote = page[at:at + 1]
            if quote in ('"', "'") and quote:
                end = page.find(quote, at + 1)
                if end < 0:
                    return attrs, False, -1
                value, at = page[at + 1:end], end + 1
            else:
                m = BARE.match(page, at)
                value, at = m.group(), m.end()
            attrs.append((name.lower(), unescape(value)))
        elif name:
            attrs.append((name.lower(), None))
        elif page[at] == ">":
            return attrs, page[at - 1] == "/", at + 1


class Reader:
    """Blocks of a page in page order."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int]] = []  # name, element number
        self.solid: list[int] = []             # depths of the open elements that are not inline
        self.depths = defaultdict(list)        # depths of the open elements of a name
        # of each element, 0 is the page: the one around it, its mark (None: none), its tag, named as content
        self.around, self.marks, self.tags, self.named = [0], [None], [""], [False]
        self.skipping = self.links = 0
        self.block: Block | None = None

    def read(self, page: str):
        """Pass over the page once."""
        at, text_from, n = 0, 0, len(page)
        while at < n:
            at = page.find("<", at)
            m = MARKUP.match(page, at) if at >= 0 else None
            if at < 0:
                break
            if m is None:
                at += 1
                continue
            if text_from < at:
                self.handle_data(unescape(page[text_from:at]))
            closing, tag, comment, cdata = m.groups()
            if tag:
                attrs, alone, end = read_tag(page, m.end())
                if end < 0:
                    return
                tag = tag.lower()
                if closing:
                    self.handle_endtag(tag)
                else:
                    self.handle_starttag(tag, attrs)
                    if alone and tag not in VOID:
                        self.handle_endtag(tag)
                    elif tag in RAW_END:
                        m = RAW_END[tag].search(page, end)
                        if m is None:
                            return
                        end = m.start()
            elif comment:
                # <!--> and <!---> end at once
                m = COMMENT_END.search(page, at + 2)
                end = m.end() if m else -1
            else:
                end = page.find("]]>", at) + 3 if cdata else page.find(">", at) + 1
                end = end if end > (2 if cdata else 0) else -1
            if end < 0:
                return
            at = text_from = end
        if text_from < n:
            self.handle_data(unescape(page[text_from:]))

    def mark_of(self, tag: str, attrs) -> tuple[int | None, bool]:
        """What an element says of its text, and whether its words name content."""
        words = set()
        for k, v in attrs:
            if k in ("class", "id", "role") and v:
                words.update(v.lower().replace("-", " ").replace("_", " ").split())
        if tag in ("html", "body"):
            return None, False
        if tag in CONTENT_TAGS:
            return CONTENT, bool(words & CONTENT_WORDS)
        named, bad = bool(words & CONTENT_WORDS), words & BOILERPLATE_WORDS
        if tag in CLOSED_TAGS or bad - LAYOUT_WORDS - MENU_WORDS:
            return CLOSED, False
        if tag in BOILERPLATE_TAGS - LAYOUT_TAGS or bad & MENU_WORDS:
            return MENU, False
        if tag in LAYOUT_TAGS and not (named and tag != "header") or bad and not named:
            return LAYOUT, False
        return None, named

    def resolve(self):
        """The zone of every block, once the whole page is known.  Elements are numbered in page order, so
        that one pass each way adds up their texts and hands down their zones."""
        n = len(self.around)
        size, content = [0] * n, [0] * n
        for b in self.blocks:
            size[b.element] += b.size - b.linked
        for e in range(n - 1, 0, -1):
            marked = self.marks[e] == CONTENT or self.marks[e] is None and self.named[e]
            content[e] = size[e] if marked else content[e]
            size[self.around[e]] += size[e]
            content[self.around[e]] += content[e]
        zones, named = [PLAIN_ZONE] * n, [False] * n
        for e in range(1, n):
            zone, mark = zones[self.around[e]], self.marks[e]
            named[e] = named[self.around[e]] or self.named[e]
            if mark == CONTENT:
                zone = zone if zone == CLOSED and self.tags[e] != "main" else CONTENT
            elif mark is not None:
                beside = content[0] - content[e]
                wraps = (size[e] > CLOSED_WRAPPER * size[0] and not beside if mark == CLOSED
                         else size[e] > WRAPPER * size[0] and 4 * beside < size[e])
                # an article's own header is the article's
                if not wraps and not (self.tags[e] == "header" and mark == LAYOUT and zone == CONTENT):
                    zone, named[e] = min(zone, mark), False
            zones[e] = zone
        for b in self.blocks:
            b.zone, b.named = zones[b.element], named[b.element]

    def end_block(self):
        self.block = None

    def close_to(self, depth: int):
        while len(self.open) > depth:
            name = self.open.pop()[0]
            self.depths[name].pop()
            if name not in INLINE:
                self.solid.pop()
            self.skipping -= name in SKIPPED
            self.links -= name == "a"
            if name not in INLINE:
                self.end_block()

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag not in INLINE:
                self.end_block()
            return
        if tag in CLOSES_P or tag in SAME_CLOSES or tag == "body":
            for depth in reversed(self.solid):
                name = self.open[depth][0]
                if name == "p" and tag in CLOSES_P or name == tag and tag in SAME_CLOSES or name == "head":
                    self.close_to(depth)
                    break
                if name != "p":
                    break
        mark, named = self.mark_of(tag, attrs)
        self.around.append(self.open[-1][1] if self.open else 0)
        self.marks.append(mark)
        self.tags.append(tag)
        self.named.append(named)
        self.depths[tag].append(len(self.open))
        if tag not in INLINE:
            self.solid.append(len(self.open))
        self.open.append((tag, len(self.around) - 1))
        self.skipping += tag in SKIPPED
        self.links += tag == "a"
        if tag not in INLINE:
            self.end_block()

    def handle_endtag(self, tag):
        depth = self.depths[tag][-1] if self.depths[tag] else -1
        if tag in INLINE:
            if depth > (self.solid[-1] if self.solid else -1):  # a stray inline end tag doesn't close a block
                self.close_to(depth)
        elif depth >= 0:
            self.close_to(depth)
        else:
            self.end_block()

    def handle_data(self, data):
        if self.skipping:
            return
        if self.block is None:
            if not data.strip():
                return
            depth = self.solid[-1] if self.solid else 0
            parent = self.open[depth - 1][1] if depth > 0 else -1
            self.block = Block(self.open[depth][0] if self.solid else "", parent, self.open[-1][1] if self.open else 0)
            self.blocks.append(self.block)
        self.block.parts.append(data)
        self.block.size += len(data)
        if self.links:
            self.block.linked += len(data)


def block_features(b: Block, text: str) -> tuple:
    """FEATURES of a block: its words and element, not its place."""
    return (1.0, math.log1p(text.count(" ") + 1), b.linked / max(1, b.size), float(text[-1:] in ".!?"),
            float(b.tag in ("h1", "h2", "h3", "h4", "h5", "h6")), float(b.tag in ("p", "blockquote", "pre")),
            float(b.tag == "li"))


def log_odds(b: Block, text: str, weights=PLAIN) -> float:
    """The classifier's log-odds that a block is content, with what its place adds."""
    z = sum(w * x for w, x in zip(weights, block_features(b, text)))
    return max(-MOST, min(MOST, z)) + ZONE_ODDS[b.zone] + NAMED_CONTENT * b.named


def read_blocks(html: str) -> list[tuple[Block, str]]:
    """The blocks with text of a page, in page order."""
    reader = Reader()
    reader.read(html)
    reader.resolve()
    return [(b, t) for b, t in ((b, b.text()) for b in reader.blocks) if t]


def fit_weights(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 60, ridge: float = 1.0) -> tuple:
    """Logistic regression of rows that count n times, by Newton steps, drawn towards PLAIN so that
    unseen features keep its weights."""
    plain, penalty = np.array(PLAIN), ridge * np.eye(x.shape[1])
    w = plain.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (n * (p - y)) + ridge * (w - plain))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _marked_blocks(batches):
    for df in batches:
        rows = [(*block_features(b, t), float(b.zone == CONTENT)) for x in df["html"] for b, t in read_blocks(x) if b.zone]
        # equal blocks repeat on every page of a site: counts instead of copies
        out = pd.DataFrame(rows, columns=[*FEATURES, "y"]).round(3)
        yield out.groupby([*FEATURES, "y"], as_index=False).size().rename(columns={"size": "n"})


def train_classifier(pages: DataFrame, html_col: str = "html", fit_pages: int = 2000) -> tuple:
    """Weights learnt from the marked blocks of at most ``fit_pages`` pages."""
    p = pages.select(text_of(html_col).alias("html"))
    pick = smallest_hashes(p, ["html"], fit_pages)
    kinds = ", ".join(f"{f} double" for f in (*FEATURES, "y")) + ", n long"
    rows = (pick.mapInPandas(_marked_blocks, kinds).groupBy(*FEATURES, "y").agg(F.sum("n").alias("n"))
            .orderBy(*FEATURES, "y").collect())
    data = np.array([tuple(r) for r in rows], dtype=float).reshape(len(rows), len(FEATURES) + 2)
    x, y, n = data[:, :-2], data[:, -2], data[:, -1]
    if len({*y.tolist()}) < 2:
        return PLAIN
    return fit_weights(x, y, n)


def source_side(n: int, edges: list[tuple[int, int, int, int]], s: int, t: int) -> set[int]:
    """Nodes on the source side of a minimum cut: Dinic's maximum flow, then what s still reaches."""
    to, cap, out = [], [], [[] for _ in range(n)]
    for a, b, ab, ba in edges:
        for x, y, c in ((a, b, ab), (b, a, ba)):
            out[x].append(len(to))
            to.append(y)
            cap.append(c)
    while True:
        level, queue = [-1] * n, deque([s])
        level[s] = 0
        while queue:
            x = queue.popleft()
            for e in out[x]:
                if cap[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[x] + 1
                    queue.append(to[e])
        if level[t] < 0:
            return {x for x in range(n) if level[x] >= 0}
        at = [0] * n
        path: list[int] = []
        x = s
        while True:
            if x == t:
                push = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= push
                    cap[e ^ 1] += push
                k = next(i for i, e in enumerate(path) if cap[e] == 0)
                x = to[path[k] ^ 1]
                del path[k:]
            while at[x] < len(out[x]):
                e = out[x][at[x]]
                if cap[e] > 0 and level[to[e]] == level[x] + 1:
                    break
                at[x] += 1
            if at[x] < len(out[x]):
                path.append(out[x][at[x]])
                x = to[path[-1]]
            elif path:
                e = path.pop()
                x = to[e ^ 1]
                at[x] += 1
            else:
                break


def label_blocks(costs: list[float], parents: list[int]) -> list[bool]:
    """Content or not, from log-odds and parent elements, by a minimum cut."""
    n = len(costs)
    hubs = {p: n + i for i, p in enumerate(dict.fromkeys(parents))}
    gain = [round(z * SCALE) for z in costs] + [0] * len(hubs)
    near, near_by = round(NEIGHBOUR * SCALE), round(SIBLING * SCALE)
    edges = [(i - 1, i, near) for i in range(1, n)] + [(i, hubs[p], near_by) for i, p in enumerate(parents)]
    out: list[list[tuple[int, int]]] = [[] for _ in gain]
    left = [0] * len(gain)
    for a, b, c in edges:
        for x, y in ((a, b), (b, a)):
            out[x].append((y, c))
            left[x] += c
    # a node whose gain outweighs its edges to undecided nodes is decided and adds to its neighbours' gains;
    # a tie is not content, as on the source side of the smallest minimum cut
    side: list[bool | None] = [None] * len(gain)
    queue = deque(range(len(gain)))
    while queue:
        x = queue.popleft()
        if side[x] is not None or -left[x] < gain[x] <= left[x]:
            continue
        side[x] = gain[x] > left[x]
        for y, c in out[x]:
            if side[y] is None:
                gain[y] += c if side[x] else -c
                left[y] -= c
                queue.append(y)
    place = {x: i for i, x in enumerate(x for x, on in enumerate(side) if on is None)}
    if place:
        s = len(place)
        flow = [(s, i, gain[x], 0) if gain[x] >= 0 else (i, s + 1, -gain[x], 0) for x, i in place.items()]
        flow += [(place[a], place[b], c, c) for a, b, c in edges if a in place and b in place]
        content = source_side(s + 2, flow, s, s + 1)
        for x, i in place.items():
            side[x] = i in content
    return [bool(on) for on in side[:n]]


def main_text(html: str, weights=PLAIN) -> str:
    """The page's content blocks, joined by one space."""
    kept = read_blocks(html)
    if not kept:
        return ""
    # the more of the text marked articles hold, the less what stands outside them is main text
    inside, plain = (sum(b.size - b.linked for b, _ in kept if b.zone == z) for z in (CONTENT, PLAIN_ZONE))
    outside = OUTSIDE * inside / max(1, inside + plain)
    costs = [log_odds(b, t, weights) + (outside if b.zone == PLAIN_ZONE else 0.0) for b, t in kept]
    return " ".join(t for (_, t), keep in zip(kept, label_blocks(costs, [b.parent for b, _ in kept])) if keep)


def _extract(id_col: str, url_col: str, weights: tuple):
    def run(batches):
        for df in batches:
            texts = [main_text(x, weights) for x in df["html"]]
            yield pd.DataFrame({id_col: df[id_col], url_col: df[url_col], "text": pd.Series(texts, dtype=object),
                                "n_chars": pd.Series([len(x) for x in texts], dtype="int64")})
    return run


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 fit_pages: int = 2000) -> DataFrame:
    """One row per page: id, url, text, n_chars."""
    weights = train_classifier(pages, html_col, fit_pages)
    rows = pages.select(F.col(id_col), F.col(url_col), text_of(html_col).alias("html"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInPandas(_extract(id_col, url_col, weights),
                            f"{id_col} {kind}, {url_col} string, text string, n_chars long")
