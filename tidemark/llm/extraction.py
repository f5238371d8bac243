"""Main text of web pages by minimum-cut labelling.

A page is read into blocks of text and the containers around them.  A classifier of block statistics, learned from
blocks whose markup tells what they are, gives each block the costs of calling it content or boilerplate; these are
the capacities to the two terminals of a graph.  Edges between neighbouring blocks, and between blocks, containers and
the containers around those, cost something when they are cut.  A minimum cut is the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import blobs, small
from tidemark.llm.mincut import CutGraph

TRAINING_PAGES = 2_000  # pages the classifier learns from, about, at most

# Elements of HTML by what they do to the text in them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary"
    " table tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())  # their text is no markup
WITHOUT_TEXT = frozenset("audio button canvas datalist noscript object option select svg template video".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
PLAIN = HEADINGS | frozenset("p li dt dd td th tr tbody thead tfoot caption legend summary pre html".split())
CLOSED_BY_LIKE = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())

# What tells boilerplate and content: elements, roles, and words of class and id.
BOILERPLATE_TAGS = frozenset("aside dialog footer form menu nav search".split())
BOILERPLATE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split()
)
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising alert aside banner breadcrumb breadcrumbs comment"
    " commentlist comments consent cookie cookies copyright dialog discussion disclaimer disqus foot footer footers form gdpr login"
    " masthead menu menus modal nav navbar navigation navi newsletter notice notices notification overlay pager pagination"
    " popup promo promoted promotion recommendations recommended related replies reply respond responses search share sharebar"
    " sharing sidebar sidebars signup skip skyscraper social sponsor sponsored sponsors subscribe subscription teaser toolbar"
    " topbar trending widget widgets".split()
)
HEADER_WORDS = frozenset(("header", "headers", "head"))
CONTENT_WORDS = frozenset("article body content entry hentry main maincontent post story text".split())

CONTENT, BOILERPLATE = 1, 0
# Costs in thousandths of a natural logarithm, so that flows are whole numbers and end exactly.
UNIT = 1_000
CERTAIN = 1_000_000 * UNIT  # what markup says of a container
HINTED = 12 * UNIT  # what a class or id says for content
CLIP = 6.0  # a block's own statistics count so much at most
INSIDE = 5.0  # more for a block that its containers say is content, or outside of a page's article
TO_CONTAINER, TO_OUTER, TO_NEXT, TO_NEXT_INSIDE = 8 * UNIT, 4 * UNIT, UNIT // 2, 2 * UNIT

_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s=/>][^\s=/>]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>][^\s>]*|(?=[\"'])))?")
_LETTER = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")


@dataclass
class Block:
    """A piece of text without block markup in it; ``linked`` of its characters are in links."""

    text: str
    linked: int
    tag: str
    container: int


@dataclass
class Page:
    """Blocks in order; of each container the one around it, and what its markup says: content, boilerplate or nothing."""

    blocks: list[Block] = field(default_factory=list)
    outer: list[int] = field(default_factory=lambda: [-1])
    says: list[int | None] = field(default_factory=lambda: [None])
    hinted: list[bool] = field(default_factory=lambda: [False])
    tags: list[str] = field(default_factory=lambda: [""])


def _opinion(tag: str, attributes: dict[str, str], inside_content: bool) -> tuple[int | None, bool]:
    """What a container's markup says of its text, and whether its class or id hints at content."""
    role = attributes.get("role", "").strip().lower()
    if tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES:
        return BOILERPLATE, False
    words = {w.lower() for name in ("class", "id") for w in _WORDS.findall(attributes.get(name, ""))}
    content = bool(words & CONTENT_WORDS)
    if words & BOILERPLATE_WORDS and tag not in ("body", "html"):
        return BOILERPLATE, False
    if (tag == "header" or words & HEADER_WORDS and not content) and not inside_content and tag not in HEADINGS:
        return BOILERPLATE, False
    if tag in CONTENT_TAGS or role in CONTENT_TAGS:
        return CONTENT, False
    return None, content


def _attributes(source: str, at: int) -> tuple[dict[str, str], int]:
    """The attributes of a tag from ``at`` on, and the place after its end; beyond the text if it has none."""
    found: dict[str, str] = {}
    while True:
        match = _ATTRIBUTE.match(source, at)
        if match is None:
            end = source.find(">", at)
            # Only signs that begin no attribute are left before the end of the tag.
            stop = re.compile(r"[\s/]*(>|=)").match(source, at)
            if stop is not None and stop.group(1) == "=":
                at = stop.end()
                continue
            return found, len(source) + 1 if end < 0 else end + 1
        name, value = match.group(1).lower(), match.group(2)
        at = match.end()
        if value == "":  # a quote that is never closed
            return found, len(source) + 1
        if value is not None and name not in found:
            found[name] = html.unescape(value[1:-1] if value[0] in "\"'" else value)


def read_page(source: str) -> Page:
    """Blocks and containers of a page, in one pass over it."""
    page = Page()
    stack: list[tuple[str, int]] = []  # open block elements and the container their text is in
    open_tags: Counter[str] = Counter()
    pieces: list[tuple[str, bool]] = []
    at, length, in_link, muted = 0, len(source), False, []
    lowered: str | None = None
    closing_sign: dict[str, bool] = {}

    def flush() -> None:
        if not pieces:
            return
        text = " ".join("".join(piece for piece, _ in pieces).split())
        if text:
            linked = sum(len("".join(piece.split())) for piece, link in pieces if link)
            tag, container = stack[-1] if stack else ("", 0)
            page.blocks.append(Block(text, linked, tag, container))
        pieces.clear()

    def close_top() -> None:
        open_tags[stack.pop()[0]] -= 1

    def add(text: str) -> None:
        if text and not muted and not open_tags["head"]:
            pieces.append((html.unescape(text) if "&" in text else text, in_link))

    while at < length:
        sign = source.find("<", at)
        if sign < 0:
            add(source[at:])
            break
        add(source[at:sign])
        after = source[sign + 1 : sign + 2]
        if after == "!" or after == "?":
            if source.startswith("<!--", sign):
                if source.startswith((">", "->"), sign + 4):
                    end = source.find(">", sign + 4) + 1
                else:
                    end = source.find("-->", sign + 4)
                    end = end + 3 if end >= 0 else length
            else:
                end = source.find(">", sign) + 1 or length
            at = end
            continue
        closing = after == "/"
        start = sign + 2 if closing else sign + 1
        if source[start : start + 1] not in _LETTER:
            if closing:  # "</" and no name is a comment
                at = source.find(">", sign) + 1 or length
            else:
                add("<")
                at = sign + 1
            continue
        name = _NAME.match(source, start)
        tag, end = name.group().lower(), name.end()
        if source[end : end + 1] == ">":
            attributes, at = {}, end + 1
        else:
            attributes, at = _attributes(source, end)
            if at > length:  # a tag without an end is none, nor is what follows text
                break
        if closing:
            if muted:
                if tag == muted[-1]:
                    muted.pop()
            elif tag == "a":
                in_link = False
            elif tag in BLOCKS:
                flush()
                if open_tags[tag]:
                    while stack[-1][0] != tag:
                        close_top()
                    close_top()
            continue
        if tag in RAW:
            if lowered is None:
                lowered = source.lower()
                if len(lowered) != length:  # some capitals are longer in lower case
                    lowered = "".join(c.lower() if c.isascii() else c for c in source)
            end = lowered.find(f"</{tag}", at) if closing_sign.get(tag, True) else -1
            closing_sign[tag] = end >= 0
            at = length if end < 0 else end
            continue
        if tag in WITHOUT_TEXT:
            muted.append(tag)
            continue
        if muted:
            continue
        if tag == "br":
            add(" ")
        elif tag == "a":
            in_link = True
        if tag not in BLOCKS:
            if open_tags["head"] and tag not in HEAD_ONLY and tag not in VOID:
                while open_tags["head"]:
                    close_top()
            continue
        flush()
        if tag in VOID:
            continue
        if open_tags["head"] and tag not in HEAD_ONLY:
            while open_tags["head"]:
                close_top()
        if stack and stack[-1][0] == "p":
            close_top()
        for like in CLOSED_BY_LIKE.get(tag, ()):
            if stack and stack[-1][0] == like:
                close_top()
        container = stack[-1][1] if stack else 0
        inside = _nearest(page, container) == CONTENT
        says, hinted = _opinion(tag, attributes, inside) if attributes or tag not in PLAIN else (None, False)
        if says is not None or hinted or tag not in PLAIN:
            page.outer.append(container)
            page.tags.append(tag)
            # An article inside boilerplate is a teaser or a comment.
            page.says.append(None if says == CONTENT and _nearest(page, container) == BOILERPLATE else says)
            page.hinted.append(hinted)
            container = len(page.outer) - 1
        stack.append((tag, container))
        open_tags[tag] += 1
    flush()
    return page


def _nearest(page: Page, container: int) -> int | None:
    """What the nearest container that says anything says; remembered for those on the way."""
    passed = []
    told = page.__dict__.setdefault("told", {})
    while container >= 0 and page.says[container] is None and container not in told:
        passed.append(container)
        container = page.outer[container]
    found = None if container < 0 else told.get(container, page.says[container])
    for place in passed:
        told[place] = found
    return found


def features(block: Block) -> tuple[str, ...]:
    """What is counted of a block: its length, how much of it is linked, how it ends, and its element."""
    words = min(7, len(block.text.split()).bit_length())
    share = block.linked / max(1, len(block.text) - block.text.count(" "))
    linked = 0 if share == 0 else 1 if share <= 0.33 else 2 if share <= 0.8 else 3
    ends = block.text.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…", "。", "！", "？")
    tag = "h" if block.tag in HEADINGS else block.tag if block.tag in ("p", "li") else "cell" if block.tag in ("td", "th") else "other"
    return f"words{words}", f"linked{linked}", f"ends{int(ends)}", f"tag_{tag}"


# Blocks counted for each feature before any page is seen: (boilerplate, content).
PRIOR = {
    "words0": (9, 1), "words1": (9, 1), "words2": (8, 2), "words3": (7, 3), "words4": (5, 5), "words5": (3, 7), "words6": (2, 8), "words7": (1, 9),
    "linked0": (3, 7), "linked1": (4, 6), "linked2": (8, 2), "linked3": (9, 1), "ends0": (7, 3), "ends1": (2, 8),
    "tag_h": (4, 6), "tag_p": (2, 8), "tag_li": (7, 3), "tag_cell": (6, 4), "tag_other": (6, 4),
}


def log_odds(counts: dict[tuple[str, int], int]) -> dict[str, float]:
    """Of each feature the logarithm of how much likelier it is in content than in boilerplate.

    The counts are scaled to weigh as much as the prior at most twice over, so no corpus of one make can unlearn it.
    """
    found = {}
    for name, prior in PRIOR.items():
        seen = [counts.get((name, label), 0) for label in (BOILERPLATE, CONTENT)]
        totals = [max(1, sum(n for (other, of), n in counts.items() if of == label)) / 4 for label in (BOILERPLATE, CONTENT)]
        rates = [n / total for n, total in zip(seen, totals)]
        weight = 20 / max(1e-9, sum(rates)) if sum(rates) else 0.0
        boilerplate, content = (p + weight * rate for p, rate in zip(prior, rates))
        found[name] = log(content / boilerplate)
    return found


def count_features(page: Page) -> Counter[tuple[str, int]]:
    """How often each feature is seen in blocks of which the markup tells the label."""
    counts: Counter[tuple[str, int]] = Counter()
    for block in page.blocks:
        label = _nearest(page, block.container)
        if label is not None:
            counts.update((name, label) for name in features(block))
    return counts


def content_blocks(page: Page, odds: dict[str, float]) -> list[bool]:
    """Per block whether a minimum cut of the page's graph calls it content."""
    if not page.blocks:
        return []
    has_article = any(s == CONTENT and t == "article" for s, t in zip(page.says, page.tags))
    marked = any(s == CONTENT for s in page.says)
    graph_node: dict[int, int] = {}
    order: list[int] = []
    for block in page.blocks:
        container = block.container
        while container >= 0 and container not in graph_node:
            graph_node[container] = len(page.blocks) + len(order)
            order.append(container)
            container = page.outer[container]
    graph = CutGraph(len(page.blocks) + len(order))
    for container in order:
        node, says = graph_node[container], page.says[container]
        if says == BOILERPLATE:
            graph.cost(node, CERTAIN, 0)
        elif says == CONTENT:
            # Where there is an article, the main part around it only hints.
            graph.cost(node, 0, HINTED if has_article and page.tags[container] == "main" else CERTAIN)
        elif page.hinted[container]:
            graph.cost(node, 0, HINTED)
        if page.outer[container] >= 0:
            graph.edge(node, graph_node[page.outer[container]], TO_OUTER)
        elif marked:  # outside of what is marked as content
            graph.cost(node, CERTAIN, 0)
    previous = None
    for place, block in enumerate(page.blocks):
        says = _nearest(page, block.container)
        own = max(-CLIP, min(CLIP, sum(odds[name] for name in features(block))))
        own += INSIDE if says == CONTENT else -INSIDE if says == BOILERPLATE or marked else 0.0
        capacity = int(abs(own) * UNIT)
        graph.cost(place, *((0, capacity) if own > 0 else (capacity, 0)))
        graph.edge(place, graph_node[block.container], TO_CONTAINER)
        if previous is not None:
            graph.edge(place - 1, place, TO_NEXT_INSIDE if previous.container == block.container else TO_NEXT)
        previous = block
    return graph.source_side()[: len(page.blocks)]


def main_text(source: str, odds: dict[str, float]) -> str:
    page = read_page(source)
    return "\n".join(block.text for block, chosen in zip(page.blocks, content_blocks(page, odds)) if chosen)


def learned_odds(pages: DataFrame, html_col: str = "html", training_pages: int = TRAINING_PAGES) -> dict[str, float]:
    """The classifier, learned from about ``training_pages`` of the pages; two numbers a feature come to the driver."""
    rows = pages.count()
    share = min(1.0, training_pages / max(1, rows))
    source = pages.select(F.col(f"`{html_col}`").cast("string").alias("html"))
    drawn = source.where(F.pmod(F.xxhash64("html", F.monotonically_increasing_id()), F.lit(1 << 31)) < int(share * (1 << 31)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, int]] = Counter()
        for batch in small(batches):
            for text in blobs(batch.column(0)):
                counts.update(count_features(read_page((text or b"").decode("utf-8", "replace"))))
        if counts:
            names, labels = zip(*counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array(labels, pa.int32()), pa.array(list(counts.values()), pa.int64())], ["name", "label", "n"]
            )

    found = drawn.mapInArrow(count, "name string, label int, n long").groupBy("name", "label").agg(F.sum("n").alias("n"))
    return log_odds({(row["name"], row["label"]): row["n"] for row in found.collect()})


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page: its article, without menus, headers, footers, sidebars, notices, adverts, forms and comments.

    Returns ``id_col``, ``url_col``, ``text`` (blocks joined by newlines, white space inside a block made one space)
    and ``n_chars``.  NULL or empty pages, and those without content, give an empty text; NULL ids and urls stay NULL;
    repeated rows give repeated results; an empty table gives an empty one; other columns are not looked at.  Each
    page is worked on by itself, and its graph has as many nodes as it has blocks and containers.
    """
    odds = learned_odds(pages, html_col)
    source = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.col(f"`{html_col}`").cast("string").alias("html")
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [main_text((text or b"").decode("utf-8", "replace"), odds) for text in blobs(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["id", "url", "text", "n_chars"],
            )

    found = source.mapInArrow(extract, "id long, url string, text string, n_chars long")
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
