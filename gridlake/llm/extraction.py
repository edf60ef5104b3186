"""Main text of web pages by minimum-cut labelling of their blocks.

A page is read into blocks: runs of text without a block-level tag in between. Each block
gets evidence for or against being content from its containers, words, links and
punctuation. Positive evidence is the capacity from the source to the block, negative
evidence the capacity from the block to the sink. Neighbouring blocks are joined by edges
whose capacity falls with their distance in the document tree. The minimum cut
is the labelling with the least total cost: evidence overruled plus neighbours separated.

Blocks whose evidence outweighs all their open edges are settled first, since a minimum cut has
them on that side; max-flow runs on what is left.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from dataclasses import dataclass
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.llm.batches import map_batches

#: Tags and class words by what they hold.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details",
    "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "header", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "option",
    "p", "pre", "section", "select", "summary", "svg", "table", "tbody", "td", "tfoot", "th", "thead", "tr",
    "ul",
}
NEVER = {"head", "nav", "footer", "aside", "button", "select", "option", "menu", "svg", "dialog"}
NEVER_ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "menu",
}
AGAINST = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
    "promotion", "cookie", "cookies", "consent", "gdpr", "popup", "modal", "overlay", "comment", "comments",
    "disqus", "reply", "replies", "respond", "subscribe", "newsletter", "signup", "login", "share", "sharing",
    "social", "related", "recommended", "breadcrumb", "breadcrumbs", "pagination", "pager", "copyright",
    "sidebar", "widget", "footer", "navbar", "nav", "navigation", "menu", "toolbar", "notice", "alert",
    "disclaimer", "skip", "toc", "masthead",
}
WEAK_AGAINST = {"header", "banner", "top", "bottom", "meta", "byline", "tags", "aside", "legal"}
#: Words against that stay so however much text an element holds.
DISCUSSION = {"comment", "comments", "disqus", "reply", "replies", "respond"}
#: What follows these words in a class name tells of the layout around an element.
MODIFIERS = {"has", "with", "without", "no"}
FOR = {"content", "article", "post", "entry", "story", "body", "text", "main", "articlebody", "page"}

#: Evidence and capacities.
SETTLED = 1000.0
CONTAINER_FOR, CONTAINER_AGAINST, WEAK = 4.0, -12.0, -3.0
BIAS, PER_LOG_WORD, SENTENCE, PARAGRAPH, HEADING, LINKS, MARK = -1.6, 1.0, 0.8, 0.8, 0.6, -5.0, -2.5
#: What an article takes off its containers' evidence against, and each unlinked word of a block.
ARTICLE, PER_WORD = 8.0, 0.06
#: So many words that are most of the page's make an element's words against it void.
LONG = 200
SMOOTH = 1.5
REACH = 2

_TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE) for tag in RAW}
_STOP = (".", "!", "?", "…", ":", "。", "”", '"')


def attribute_values(attributes: str) -> dict[str, str]:
    """The value of each attribute by its name in lower case; of equal names the first counts."""
    values: dict[str, str] = {}
    for name, *forms in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), next((form for form in forms if form), ""))
    return values


@dataclass
class Block:
    text: str
    evidence: float
    inside: int


@dataclass
class Container:
    """A block-level element; ``settled`` if nothing in it is content."""

    parent: int
    tag: str
    settled: bool
    depth: int = 0
    own: float = 0.0
    against: bool = False
    discussion: bool = False
    main: bool = False
    article: bool = False


def read_container(parent: int, tag: str, attributes: str, in_article: bool) -> Container:
    """An element by its tag and attributes.

    A class or id with a word against the element counts against it, another one with a word for
    it counts for it; an element that has both is neutral.
    """
    found = Container(parent, tag, tag in NEVER or (tag == "header" and not in_article))
    found.main, found.article = tag == "main", tag == "article"
    names: list[set[str]] = []
    for name, value in attribute_values(attributes).items() if attributes else ():
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.settled = True
        elif name == "style":
            found.settled |= bool(_INVISIBLE.search(value))
        elif name == "role":
            found.settled |= value.lower() in NEVER_ROLES
            found.main |= value.lower() == "main"
            found.article |= value.lower() == "article"
        elif name in ("class", "id", "itemprop"):
            for one in value.split():
                words = _NAME.findall(_CAMEL.sub(" ", one).lower())
                names.append(set(takewhile(lambda word: word not in MODIFIERS, words)))
    found.own = CONTAINER_FOR if found.main or found.article else 0.0
    against = any(words & AGAINST for words in names)
    favour = any(words & FOR and not words & AGAINST for words in names)
    found.against = against and not favour
    found.discussion = found.against and any(words & DISCUSSION for words in names)
    if tag not in ("html", "body", "article", "main"):
        if found.against:
            found.own = CONTAINER_AGAINST
        elif favour and not against:
            found.own = CONTAINER_FOR
        elif not against and any(words & WEAK_AGAINST for words in names):
            found.own += WEAK
    return found


def container_evidence(container: Container, outer: float, neutral: bool) -> float:
    """The evidence that an element passes on to all within it.

    What is settled stays settled. Evidence against outlasts evidence for, but ends at the page's
    main element, and an article takes a part off it. A form is settled, unless neutral.
    """
    if outer <= -SETTLED or container.settled or (container.tag == "form" and not neutral):
        return -SETTLED
    own = max(container.own, 0.0) if neutral and container.tag != "form" else container.own
    if container.main and own > 0:
        return own
    if container.article and own > 0 and outer < 0 and not container.against:
        return min(own, outer + ARTICLE)
    if outer < WEAK or own <= CONTAINER_AGAINST:
        return min(outer, own)
    return own if own < 0 else max(outer, own)


def page_evidence(containers: list[Container], words: list[float]) -> list[float]:
    """The evidence each element of a page passes on; ``words`` has their own unlinked words.

    A form is neutral if it holds an article or most of the words that aren't settled, and another
    element if those are many, too; a discussion may be longer than the text it is about.
    """

    def passed(neutral: list[bool]) -> list[float]:
        evidence = [0.0]
        for i, container in enumerate(containers[1:], 1):
            evidence.append(container_evidence(container, evidence[container.parent], neutral[i]))
        return evidence

    evidence = passed([container.tag == "form" for container in containers])
    if not any(c.tag == "form" or c.own <= CONTAINER_AGAINST for c in containers):
        return evidence
    held = [n if e > -SETTLED else 0.0 for n, e in zip(words, evidence, strict=True)]
    article = [(c.main or c.article) and e > -SETTLED for c, e in zip(containers, evidence, strict=True)]
    for i in range(len(containers) - 1, 0, -1):
        parent = containers[i].parent
        held[parent] += held[i]
        article[parent] |= article[i]
    neutral = []
    for i, container in enumerate(containers):
        most = 2 * held[i] > held[0]
        if container.tag == "form":
            neutral.append(most or article[i])
        else:
            neutral.append(most and held[i] >= LONG and not container.discussion)
    return passed(neutral)


def text_evidence(text: str, linked: int, tag: str) -> float:
    """Evidence of a block's own words: long runs of sentences without links are content."""
    words = len(text.split())
    value = BIAS + PER_LOG_WORD * math.log1p(words) + LINKS * linked / len(text)
    if text.endswith(_STOP):
        value += SENTENCE
    if tag == "p":
        value += PARAGRAPH
    elif tag in ("h1", "h2", "h3"):
        value += HEADING
    if "©" in text or "all rights reserved" in text.lower():
        value += MARK
    return value


def unlinked_words(text: str, linked: int) -> float:
    return len(text.split()) * (1 - linked / len(text))


def block_evidence(text: str, linked: int, tag: str, outer: float) -> float:
    """Evidence of a block; its unlinked words outweigh its containers' evidence against it."""
    if outer <= -SETTLED:
        return outer
    if outer < 0:
        outer = min(0.0, outer + PER_WORD * unlinked_words(text, linked))
    return outer + text_evidence(text, linked, tag)


def read_blocks(page: str) -> tuple[list[Block], list[Container]]:
    """The blocks of a page in order, white space collapsed and references decoded.

    Also its containers; a block names the innermost one it is in. A hidden inline element
    hides everything up to its own end tag, or to the end of the block it is in.
    """
    read: list[tuple[str, int, str, int]] = []
    containers, unlinked = [Container(0, "", False)], [0.0]
    # open elements: tag, number in page order, inside of an article
    opened: list[tuple[str, int, bool]] = [("", 0, False)]
    parts: list[str] = []
    linked, link_depth, at = 0, 0, 0
    # the hidden inline element: its tag, how often that is open, open elements around it
    hidden, nested, around = "", 0, 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tag, number, _ = opened[-1]
                linked = min(linked, len(text))
                unlinked[number] += unlinked_words(text, linked)
                read.append((text, linked, tag, number))
            parts.clear()
        linked = 0

    def add(piece: str) -> None:
        nonlocal linked
        if piece and not hidden:
            parts.append(piece)
            if link_depth:
                linked += len(piece)

    while at < len(page):
        found = _TAG.search(page, at)
        if not found:
            add(page[at:])
            break
        add(page[at : found.start()])
        at = found.end()
        tag = (found[2] or found[5] or "").lower()
        if not tag:  # a comment or a declaration
            continue
        ends = bool(found[1] or found[4])
        attributes = found[3] or found[6] or ""
        if tag in RAW and not ends:
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
        elif tag == "a":
            link_depth = 0 if ends else 1
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCK:
            close()
            link_depth = 0
            if ends:
                depth = next((i for i in range(len(opened) - 1, 0, -1) if opened[i][0] == tag), 0)
                if depth:
                    del opened[depth:]
                    hidden = hidden if len(opened) >= around else ""
            elif tag not in VOID:
                if opened[-1][0] in _ENDED_BY and tag in _ENDED_BY[opened[-1][0]]:
                    opened.pop()
                    hidden = hidden if len(opened) >= around else ""
                _, parent, in_article = opened[-1]
                opened.append((tag, len(containers), in_article or tag in ("article", "main")))
                containers.append(read_container(parent, tag, attributes, in_article))
                containers[-1].depth = containers[parent].depth + 1
                unlinked.append(0.0)
        elif hidden:
            if tag == hidden:
                nested += -1 if ends else 1
                hidden = hidden if nested else ""
        elif attributes and not ends and tag not in VOID:
            if read_container(0, "", attributes, True).settled:
                hidden, nested, around = tag, 1, len(opened)
    close()
    evidence = page_evidence(containers, unlinked)
    blocks = [
        Block(text, block_evidence(text, linked, tag, evidence[inside]), inside)
        for text, linked, tag, inside in read
    ]
    return blocks, containers


#: Open elements that another start tag ends.
_ENDED_BY = {
    "p": BLOCK - {"html", "body", "head"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "td": {"td", "th", "tr"},
    "th": {"td", "th", "tr"},
    "tr": {"tr"},
    "option": {"option"},
    "head": {"body"},
}


# --- the cut ------------------------------------------------------------------


def steps_between(containers: list[Container], a: int, b: int) -> int:
    """Steps from one container to another in the page's tree.

    They are walked, so no block keeps the list of all containers around it; between
    neighbouring blocks there are no more steps than tags.
    """
    steps = 0
    while a != b:
        if containers[a].depth < containers[b].depth:
            a, b = b, a
        a = containers[a].parent
        steps += 1
    return steps


def smoothness(blocks: list[Block], containers: list[Container]) -> list[tuple[int, int, float]]:
    """Edges to the next blocks, weaker with each step in order and in the tree."""
    edges = []
    for i, first in enumerate(blocks):
        for j in range(i + 1, min(i + 1 + REACH, len(blocks))):
            apart = steps_between(containers, first.inside, blocks[j].inside)
            edges.append((i, j, SMOOTH / (j - i) / (1 + max(0, apart - 2))))
    return edges


def max_flow_sources(n: int, evidence: list[float], edges: list[tuple[int, int, float]]) -> set[int]:
    """The source side of a minimum cut, by augmenting along shortest paths."""
    source, sink = n, n + 1
    to: list[int] = []
    room: list[float] = []
    out: list[list[int]] = [[] for _ in range(n + 2)]

    def connect(a: int, b: int, there: float, back: float) -> None:
        out[a].append(len(to))
        to.append(b)
        room.append(there)
        out[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, value in enumerate(evidence):
        if value > 0:
            connect(source, i, value, 0.0)
        elif value < 0:
            connect(i, sink, -value, 0.0)
    for a, b, weight in edges:
        connect(a, b, weight, weight)
    tiny = 1e-9
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            node = queue.popleft()
            for e in out[node]:
                if room[e] > tiny and level[to[e]] < 0:
                    level[to[e]] = level[node] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return {i for i in range(n) if level[i] >= 0}
        tried = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                amount = min(room[e] for e in path)
                for e in path:
                    room[e] -= amount
                    room[e ^ 1] += amount
                path, node = [], source
            while tried[node] < len(out[node]):
                e = out[node][tried[node]]
                if room[e] > tiny and level[to[e]] == level[node] + 1:
                    break
                tried[node] += 1
            if tried[node] < len(out[node]):
                path.append(out[node][tried[node]])
                node = to[path[-1]]
            elif path:
                e = path.pop()
                node = to[e ^ 1]
                tried[node] += 1
            else:
                break


def minimum_cut(evidence: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for content. Of equal cuts, one with few content blocks."""
    n = len(evidence)
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, weight in edges:
        near[a].append((b, weight))
        near[b].append((a, weight))
    label: list[bool | None] = [None] * n
    net, open_weight = list(evidence), [sum(w for _, w in own) for own in near]
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if label[i] is not None or abs(net[i]) <= open_weight[i]:
            continue
        label[i] = net[i] > 0
        for j, weight in near[i]:
            if label[j] is None:
                net[j] += weight if label[i] else -weight
                open_weight[j] -= weight
                queue.append(j)
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = [(place[a], place[b], w) for a, b, w in edges if a in place and b in place]
        chosen = max_flow_sources(len(rest), [net[i] for i in rest], inner)
        for k, i in enumerate(rest):
            label[i] = k in chosen
    return [bool(x) for x in label]


def main_text(page: str | None) -> str:
    """The content blocks of a page, joined by line ends. Empty for an empty page."""
    blocks, containers = read_blocks(page or "")
    labels = minimum_cut([block.evidence for block in blocks], smoothness(blocks, containers))
    return "\n".join(block.text for block, content in zip(blocks, labels, strict=True) if content)


def _extracted(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = [main_text(page) for page in batch.column("html").to_pylist()]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("page_id"),
            batch.column("url"),
            pa.array(texts, pa.string()),
            pa.array([len(text) for text in texts], pa.int64()),
        ],
        ["page_id", "url", "text", "n_chars"],
    )


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars.

    Null or empty html, and pages without content, give an empty text. Repeated rows give
    equal results; ids and urls may be null; other columns are not looked at.
    """
    narrow = pages.select("page_id", F.col("url").cast("string").alias("url"), "html")
    kind = dict(narrow.dtypes)["page_id"]
    return map_batches(
        narrow, _extracted, f"page_id {kind}, url string, text string, n_chars long", rows=200
    )
