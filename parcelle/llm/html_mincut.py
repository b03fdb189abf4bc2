"""HTML extraction by minimum-cut labelling.

A page becomes a row of text blocks. A fixed linear classifier gives each block a cost for either label from
its tags, classes, link density, length and punctuation; the costs are its terminal capacities. Neighbouring
blocks and blocks close in the DOM are tied by smoothness edges. A maximum flow separates the two terminals;
blocks on the source side of the minimum cut are the article.

Pages are independent: one pass, no shuffle, memory bounded by a page.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML elements by their role
HIDDEN = frozenset("script style noscript template head title svg math iframe object select datalist textarea button canvas audio video map option dialog".split())
BLOCK = frozenset("html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption blockquote pre figure figcaption header footer nav aside form fieldset address hr br center details summary hgroup menu".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {  # an opening tag ends an open element of these kinds
    **dict.fromkeys("p div ul ol dl table h1 h2 h3 h4 h5 h6 blockquote pre section article aside header footer nav form figure address main hr fieldset".split(), ("p",)),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
}
FENCE = frozenset("ul ol dl table article section div body html main aside nav header footer form blockquote td th li".split())
# evidence for boilerplate (positive) or content (negative) by element
BY_TAG = {"nav": 6.0, "footer": 6.0, "aside": 5.0, "form": 5.0, "menu": 5.0, "header": 2.5, "address": 2.0, "article": -3.0, "main": -2.0, "figcaption": -0.5, "blockquote": -0.5}
BAD = re.compile(r"(?:^|[-_ ])(?:ads?|adverts?|advertisement|advertising|banner|sponsor(?:ed)?|promo(?:tion)?|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|sidebar|side|widget|menu|nav|navbar|navigation|breadcrumbs?|footer|foot|masthead|topbar|toolbar|header|share|sharing|social|related|recommended|comments?|respond|replies|reply|disqus|pagination|pager|tags|byline-links|copyright|legal|skip|hidden|search|form)(?:$|[-_ 0-9])", re.I)
COMMENTS = re.compile(r"(?:^|[-_ ])(?:comments?|respond|replies|reply|disqus|discussion)(?:$|[-_ 0-9])", re.I)
GOOD = re.compile(r"(?:^|[-_ ])(?:article|content|post|entry|story|main|body|text|page)(?:$|[-_ 0-9])", re.I)
ROLES = {"navigation": 6.0, "banner": 5.0, "contentinfo": 6.0, "complementary": 5.0, "search": 6.0, "form": 5.0, "alert": 5.0, "dialog": 6.0, "main": -2.0, "article": -3.0}
LEGAL = re.compile(r"^(?:©|\(c\)|copyright\b|all rights reserved)", re.I)

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>?", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_ENDS = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "noscript", "template", "title", "textarea", "svg", "iframe", "select")}


class Node:
    """An open element: parent, depth, summed evidence of its chain, hidden or link."""

    __slots__ = ("tag", "up", "depth", "bad", "article", "hidden", "link")

    def __init__(self, tag, up, bad=0.0, hidden=False):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        self.article = bool(up and up.article) or tag in ("article", "main")
        if up and bad == 0.0:
            bad = up.bad
        elif up and bad < 0:
            bad = up.bad if up.bad > 0 else min(up.bad, bad)  # a good name inside a bad part does not redeem it
        elif up and up.bad < 0:
            bad = bad + up.bad / 2
        elif up:
            bad = max(up.bad, bad)
        self.bad = bad
        self.hidden = hidden or bool(up and up.hidden)
        self.link = tag == "a" or bool(up and up.link and tag not in BLOCK)


def _evidence(tag: str, attrs: str, inside: bool) -> tuple[float, bool]:
    bad, hidden = BY_TAG.get(tag, 0.0), tag in HIDDEN
    if tag == "header" and inside:  # an article's own header holds its headline
        bad = 0.0
    if attrs:
        for m in _ATTR.finditer(attrs):
            name, value = m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or ""
            if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
                hidden = True
            elif name == "role":
                bad = ROLES.get(value.strip().lower(), bad)
            elif name in ("class", "id") and tag not in ("html", "body"):
                if COMMENTS.search(value):
                    bad = max(bad, 8.0)
                elif BAD.search(value):
                    bad = max(bad, 5.0)
                elif bad == 0.0 and GOOD.search(value):
                    bad = -1.0
    return bad, hidden


class Block:
    __slots__ = ("parts", "node", "linked")

    def __init__(self, node):
        self.parts, self.node, self.linked = [], node, 0

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.parts)).split())


def blocks(page: str) -> list[tuple[str, Node, int]]:
    """(text, element, linked characters) of the visible text blocks in page order; whole page."""
    out: list[tuple[str, Node, int]] = []
    node = Node("#root", None)
    block = Block(node)
    at = 0

    def end():
        nonlocal block
        if block.parts:
            text = block.text()
            if text:
                out.append((text, block.node, block.linked))
        block = Block(node)

    def put(raw):
        if not node.hidden and raw:
            if not block.parts:
                block.node = _box(node)
            block.parts.append(raw)
            if node.link:
                block.linked += len(raw.strip())

    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if m.group("close"):
            if tag in BLOCK:
                end()
            up = node
            while up.up is not None and up.tag != tag:
                if up.tag in FENCE and tag not in FENCE:
                    up = None
                    break
                up = up.up
            if up is not None and up.up is not None:
                node = up.up
            if tag in BLOCK:
                block.node = node
            continue
        if tag in BLOCK:
            end()
            for kind in CLOSES.get(tag, ()):
                up = node
                while up.up is not None and up.tag != kind and not (up.tag in FENCE and up.tag != kind):
                    up = up.up
                if up.tag == kind and up.up is not None:
                    node = up.up
        attrs = m.group("attrs")
        if tag in VOID:
            continue
        if attrs and attrs.endswith("/") and tag not in BLOCK:
            continue
        bad, hidden = _evidence(tag, attrs, node.article)
        finish = _ENDS.get(tag)
        if finish:  # raw content: skip to its end
            stop = finish.search(page, at)
            at = stop.end() if stop else n
            continue
        if tag in ("html", "body"):  # leave an unclosed head
            while node.up is not None and node.hidden:
                node = node.up
        node = Node(tag, node, bad, hidden)
        block.node = _box(node) if not block.parts else block.node
    end()
    return out


def _box(node: Node) -> Node:
    """The nearest block element."""
    while node.up is not None and node.tag not in BLOCK:
        node = node.up
    return node


def cost(text: str, node: Node, linked: int) -> float:
    """Evidence that a block is boilerplate: positive, or content: negative."""
    n = len(text)
    x = node.bad
    density = min(1.0, linked / n)
    x += 3.0 * density
    if density < 0.5:
        x -= 0.5 * min(3.0, math.log2(1 + n / 40))
        if text[-1] in ".!?…\"”»" and n > 30:
            x -= 0.5
    if node.tag in ("h1", "h2", "h3", "p", "pre", "blockquote"):
        x -= 1.0
    if LEGAL.match(text) and n < 300:
        x += 2.0
    return x if x else -0.01


def tie(a: Node, b: Node) -> float:
    """Smoothness of two blocks: large for one parent, smaller the further they are in the DOM, none across a
    change from marked boilerplate to unmarked text."""
    if (a.bad > 2) != (b.bad > 2):
        return 0.05
    steps, x, y = 0, a, b
    while x is not y:
        if x.depth >= y.depth:
            x = x.up
        else:
            y = y.up
        steps += 1
        if x is None or y is None:
            break
    return 1.2 / (1 + steps)


class Flow:
    """Maximum flow by shortest augmenting paths in levels (both terminals, ``n`` blocks)."""

    def __init__(self, n: int):
        self.n, self.s, self.t = n, n, n + 1
        self.to: list[int] = []
        self.cap: list[float] = []
        self.out: list[list[int]] = [[] for _ in range(n + 2)]

    def edge(self, a: int, b: int, there: float, back: float = 0.0):
        self.out[a].append(len(self.to))
        self.to.append(b)
        self.cap.append(there)
        self.out[b].append(len(self.to))
        self.to.append(a)
        self.cap.append(back)

    def source_side(self) -> list[bool]:
        to, cap, out, s, t = self.to, self.cap, self.out, self.s, self.t
        while True:
            level = [-1] * (self.n + 2)
            level[s] = 0
            queue = [s]
            for v in queue:
                for e in out[v]:
                    if cap[e] > 1e-9 and level[to[e]] < 0:
                        level[to[e]] = level[v] + 1
                        queue.append(to[e])
            if level[t] < 0:
                return [x >= 0 for x in level]
            turn = [0] * (self.n + 2)
            path: list[int] = []
            v = s
            while True:
                if v == t:
                    push = min(cap[e] for e in path)
                    for e in path:
                        cap[e] -= push
                        cap[e ^ 1] += push
                    k = next(i for i, e in enumerate(path) if cap[e] <= 1e-9)
                    v = to[path[k] ^ 1]
                    del path[k:]
                    continue
                while turn[v] < len(out[v]):
                    e = out[v][turn[v]]
                    if cap[e] > 1e-9 and level[to[e]] == level[v] + 1:
                        path.append(e)
                        v = to[e]
                        break
                    turn[v] += 1
                else:
                    if not path:
                        break
                    e = path.pop()
                    v = to[e ^ 1]
                    turn[v] += 1


def labels(found: list[tuple[str, Node, int]]) -> list[bool]:
    """True for the blocks of the article, by minimum cut."""
    n = len(found)
    costs = [cost(*b) for b in found]
    flow = Flow(n)
    for i, c in enumerate(costs):
        if c < 0:
            flow.edge(flow.s, i, -c)
        else:
            flow.edge(i, flow.t, c)
    last: dict[int, int] = {}
    for i, (_, node, _) in enumerate(found):
        if i:
            w = tie(found[i - 1][1], node)
            flow.edge(i - 1, i, w, w)
        up = id(node.up) if node.up is not None else 0
        j = last.get(up)
        if j is not None and j != i - 1:  # the last block under the same parent
            w = 0.5 * tie(found[j][1], node)
            flow.edge(j, i, w, w)
        last[up] = i
    return flow.source_side()[:n]


def extract(page: str | None) -> str:
    """The main text of a page: its blocks joined by one newline. Null or empty page: empty."""
    if not page:
        return ""
    found = blocks(page)
    if not found:
        return ""
    return "\n".join(text for (text, _, _), keep in zip(found, labels(found), strict=True) if keep)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars (code points) of every page.

    Null or empty html: empty text. Null ids and urls are kept, repeated rows repeat. Broken markup is read as
    far as it makes sense; other columns are not read. Empty table: no rows.
    """
    def run(batches):
        for batch in batches:
            texts = [extract(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
