"""Main text of web pages by minimum-cut labelling of blocks.

A page is cut into blocks of text at block-level tags.  A linear classifier on a block's
position in the document tree and its text (link share, length, sentence marks) gives each block the
cost of calling it boilerplate or content: these are the capacities to source and sink.  Blocks that
follow one another, and blocks that share a parent or an ancestor below the body, are tied by
smoothness edges.  A maximum flow gives the labelling of least total cost: what stays connected to
the source is content.  Blocks whose own cost outweighs all their edges are on their side of every
least cut, so they are settled first and only the undecided rest takes part in the flow.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import map_text

# fixed values: element names of the HTML standard
INVISIBLE = frozenset("script style noscript template svg math iframe object canvas audio video select datalist textarea title head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul button label".split()
)
#: Elements a later sibling or block ends without an end tag.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}

#: Costs by element, in units of one clear sign: above zero speaks for content.
ELEMENT_COST = {
    "article": 3.0, "main": 3.0, "p": 0.8, "h1": 0.6, "h2": 0.4, "h3": 0.4, "blockquote": 0.6, "pre": 0.6, "figcaption": 0.3, "td": 0.1,
    "nav": -6.0, "footer": -6.0, "aside": -6.0, "form": -5.0, "menu": -6.0, "button": -5.0, "label": -3.0, "dialog": -5.0,
    "fieldset": -4.0, "header": -3.0, "option": -5.0, "address": -1.0,
}
#: Words in class, id, role and aria-label that speak for one side.
GOOD_NAMES = re.compile(r"(?:^|[\W_])(?:article|content|post|entry|story|main|body|text|prose)(?:[\W_]|$)", re.I)
BAD_NAMES = re.compile(
    r"(?:^|[\W_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|side-?bar|foot\w*|head(?:er|line-bar)?|mast-?head|top-?bar"
    r"|cookies?|consent|notice|alert|popup|modal|overlay|newsletter|subscri\w*|sign-?up|login|search|share|sharing|social|related|recommend\w*"
    r"|comments?|repl(?:y|ies)|discussion|disqus|respond|widgets?|pagination|pager|copyright|legal|skip|tool-?bar|tags?)(?:[\W_]|$)",
    re.I,
)
BAD_ROLES = re.compile(r"(?:^|\s)(?:navigation|banner|contentinfo|complementary|search|alert|dialog|menu\w*|toolbar|form)(?:\s|$)", re.I)
BAD_NAME_COST, GOOD_NAME_COST = -5.0, 1.0
#: Smoothness: blocks next to one another, with one parent, and less for each step up to their common ancestor.
NEXT_TO, SAME_PARENT = 0.25, 1.0

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|aria-label|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s\"'>]+))?", re.I)
_SPACE = re.compile(r"\s+")
#: A stray end tag of the first kind does not close what is around an element of the second.
STRAY, AROUND = frozenset("p b i a span em strong".split()), ("article", "body", "table")
TINY = 1e-9


class _Node:
    __slots__ = ("tag", "up", "depth", "cost", "hidden", "link", "block", "in_article")

    def __init__(self, tag: str, up: _Node | None, attributes: str = ""):
        self.tag, self.up = tag, up
        self.depth = up.depth + 1 if up else 0
        own, self.hidden = ELEMENT_COST.get(tag, 0.0), bool(up and up.hidden) or tag in INVISIBLE
        self.link = tag == "a" or bool(up and up.link)
        self.block = self if up is None or tag in BLOCKS else up.block  # the nearest block element
        self.in_article = tag in ("article", "main") or bool(up and up.in_article)
        if tag == "header" and up and up.in_article:
            own = 0.0  # a heading group of the article itself
        if attributes:
            names = ""
            for key, value in _ATTRIBUTE.findall(attributes):
                key, value = key.lower(), value.strip("\"'")
                if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none", value)):
                    self.hidden = True
                elif key == "role":
                    own += BAD_NAME_COST if BAD_ROLES.search(value) else 2.0 if value in ("main", "article") else 0.0
                elif key != "style":
                    names += " " + value
            if names and tag not in ("html", "body"):
                if BAD_NAMES.search(names):
                    own += BAD_NAME_COST
                elif GOOD_NAMES.search(names):
                    own += GOOD_NAME_COST
        self.cost = own + (up.cost if up else 0.0)


class Block:
    """Text of one place in the tree: ``parts`` are raw pieces, ``linked`` how many characters of them are in links."""

    __slots__ = ("node", "parts", "linked", "text")

    def __init__(self, node: _Node):
        self.node, self.parts, self.linked, self.text = node, [], 0, ""


def blocks(page: str) -> list[Block]:
    """The visible blocks of a page in order, with their decoded and trimmed texts."""
    node = _Node("", None)
    out: list[Block] = []
    current: Block | None = None
    at = 0
    open_at: dict[str, list[_Node]] = defaultdict(list)  # open elements by name, innermost last

    def leave(place: _Node) -> None:
        """Closes ``place`` and all that is open in it: every element is left once."""
        nonlocal node
        while node.depth >= place.depth:
            open_at[node.tag].pop()
            node = node.up

    def add(raw: str) -> None:
        nonlocal current
        if node.hidden or not raw:
            return
        if current is None:
            if raw.isspace():
                return
            current = Block(node.block)
            out.append(current)
        current.parts.append(raw)
        if node.link:
            current.linked += len(raw.strip())

    while at < len(page):
        if node.tag in ("script", "style", "textarea", "title"):  # raw text up to the end tag
            end = re.compile(rf"</{node.tag}(?=[\s/>]|$)", re.I).search(page, at)
            if not end:
                break
            leave(node)
            at = end.start()
            close = page.find(">", at)
            at = len(page) if close < 0 else close + 1
            continue
        found = _TOKEN.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS:
            current = None
        if found[1]:
            if open_at[tag]:
                place = open_at[tag][-1]
                if tag not in STRAY or all(o.depth < place.depth for name in AROUND for o in open_at[name][-1:]):
                    leave(place)
        elif tag == "br":
            add(" ")
        elif tag not in VOID:
            if tag in BLOCKS:  # a block ends an open paragraph and the inline elements in it
                place = node.block
                if place.tag == "p":
                    leave(place)
            shut = CLOSED_BY.get(node.tag)
            if shut and tag in shut:
                leave(node)
            attributes = found[3] or ""
            if not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
                node = _Node(tag, node, attributes)
                open_at[tag].append(node)
    kept = []
    for b in out:
        b.text = _SPACE.sub(" ", html.unescape("".join(b.parts))).strip()
        if b.text:
            kept.append(b)
    return kept


def lean(block: Block) -> float:
    """The classifier: above zero for content, its size is the cost of the other label."""
    text = block.text
    link_share = min(1.0, block.linked / max(1, len(text)))
    words = text.count(" ") + 1
    ends = text.count(". ") + text.count(", ") + (text[-1] in ".!?:…")
    value = block.node.cost + 0.3 + min(1.0, words / 40) + min(0.6, 0.2 * ends)
    if link_share > 0.5:
        value -= 4.0 * link_share if words < 30 else 1.0
    if text.startswith("©") or re.match(r"(?:copyright|all rights reserved)\b", text, re.I):
        value -= 3.0
    return value


def smoothness(found: list[Block]) -> list[tuple[int, int, float]]:
    """Edges (i, j, capacity): neighbours in page order, and the last block before with the same parent."""
    edges, last = [], {}
    for j, b in enumerate(found):
        if j:
            a, x, y, apart = found[j - 1], found[j - 1].node, b.node, 0
            while x is not y and apart < 6:
                if x.depth >= y.depth:
                    x = x.up
                else:
                    y = y.up
                apart += 1
            if a.node.depth and b.node.depth and x is y and x.depth > 2:
                edges.append((j - 1, j, NEXT_TO + SAME_PARENT / (1 + apart)))
            else:
                edges.append((j - 1, j, NEXT_TO))
        parent = id(b.node.up)
        if parent in last and last[parent] != j - 1 and b.node.depth > 3:
            edges.append((last[parent], j, SAME_PARENT / 2))
        last[parent] = j
    return edges


def source_side(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The least-cost labelling.  Node i is tied to the source with max(cost, 0) and to the sink with
    max(-cost, 0); True for nodes the source still reaches after a maximum flow.

    A node whose cost exceeds the sum of its edges is settled, and its edges become costs of its
    neighbours, which may settle them in turn; the flow runs over what is left."""
    near: list[list[tuple[int, float]]] = [[] for _ in costs]
    cost, tied = list(costs), [0.0] * len(costs)
    for i, j, c in edges:
        near[i].append((j, c))
        near[j].append((i, c))
        tied[i] += c
        tied[j] += c
    side: list[bool | None] = [None] * len(costs)
    todo = list(range(len(costs)))
    while todo:
        i = todo.pop()
        if side[i] is not None or TINY - tied[i] < cost[i] <= TINY + tied[i]:
            continue
        side[i] = cost[i] > 0
        for j, c in near[i]:
            if side[j] is None:
                tied[j] -= c
                cost[j] += c if side[i] else -c
                todo.append(j)
    place = {i: k for k, i in enumerate(i for i, s in enumerate(side) if s is None)}
    rest = [(place[i], place[j], c) for i, j, c in edges if i in place and j in place]
    for i, reached in zip(place, _flow_side([cost[i] for i in place], rest), strict=True):
        side[i] = reached
    return side


def _flow_side(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Maximum flow in phases: distances from all sources with supply left, then flow along steps that
    lead one further, each step given up once per phase.  Phases are as many as distances that
    still carry flow, which edges of bounded capacity keep few."""
    supply, drain = [max(c, 0.0) for c in costs], [max(-c, 0.0) for c in costs]
    near: list[list[int]] = [[] for _ in costs]
    ends, room = [], []
    for i, j, c in edges:
        near[i].append(len(ends))
        near[j].append(len(ends) + 1)
        ends += [j, i]
        room += [c, c]
    while True:
        sources = [i for i, s in enumerate(supply) if s > TINY]
        far = [-1] * len(costs)
        for i in sources:
            far[i] = 0
        queue, wanted = list(sources), False
        for i in queue:
            wanted = wanted or drain[i] > TINY
            for e in near[i]:
                if far[ends[e]] < 0 and room[e] > TINY:
                    far[ends[e]] = far[i] + 1
                    queue.append(ends[e])
        if not wanted:
            return [f >= 0 for f in far]
        tried = [0] * len(costs)
        for s in sources:
            path, at = [], s
            while supply[s] > TINY:
                if drain[at] > TINY:
                    flow = min(supply[s], drain[at], *(room[e] for e in path))
                    supply[s] -= flow
                    drain[at] -= flow
                    for e in path:
                        room[e] -= flow
                        room[e ^ 1] += flow
                    path, at = [], s
                elif tried[at] < len(near[at]):
                    e = near[at][tried[at]]
                    if room[e] > TINY and far[ends[e]] == far[at] + 1:
                        path.append(e)
                        at = ends[e]
                    else:
                        tried[at] += 1
                elif path:
                    at = ends[path.pop() ^ 1]
                    tried[at] += 1
                else:
                    break


def main_text(page: str) -> str:
    found = blocks(page)
    content = source_side([lean(b) for b in found], smoothness(found))
    return "\n".join(b.text for b, keep in zip(found, content, strict=True) if keep)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text (empty if none), n_chars
    (code points of the text).

    Character references are decoded, white space inside a block becomes one space, blocks
    are trimmed and joined in page order by one newline.  Null html counts as empty; a text
    without tags is one block; repeated rows give repeated rows; other columns are ignored; pages of
    any length are read whole, in time about linear in them; an empty table gives no rows."""

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column("html").to_pylist()]
        columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    return map_text(rows, "page_id long, url string, text string, n_chars long", extract, "html")
