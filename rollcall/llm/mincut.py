"""HTML extraction by minimum-cut labelling of the text blocks of a page.

A page becomes blocks of text (runs between block-level tags) with what the tags around them say.
A small linear classifier gives each block a cost of being called content and one of being called
boilerplate; these are its capacities to the two terminals.  Blocks that follow each other, and
blocks of one container, are joined by edges that cost less the farther apart they are in the DOM
tree.  The minimum cut, found by maximum flow, is the labelling of least cost.

The weights are set by hand (``HINTS``, ``score``): no page comes with its text, so nothing is
learned.  Memory of a task is bounded by one page; pages do not depend on each other.

Defined results: a null or empty page, or one without content, gives an empty text; character
references are decoded, white space inside a block is one space, blocks are joined by one space in
page order; unclosed and misplaced tags are read the way browsers mostly do.  Repeated rows are
rows like others, and all other columns are kept as they are.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.llm.common import free_name, with_fields

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label map mark meter "
    "nobr output picture progress q ruby rb rp rt s samp small span strike strong sub sup time tt u "
    "var wbr".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp".split())
UNSEEN = frozenset("head template svg math object audio video canvas select datalist button "
                   "dialog".split())
DEEPEST = 512                # tags nested deeper are read as siblings
CLOSES = {                   # an opening tag ends these, up to a tag of the second list
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, {"html"}),
}
INSIDE_P = INLINE | {"p"}    # other tags end an open paragraph

# What a container says about its text: negative for boilerplate.
BAD = -6.0                   # outweighs the most that words can say for a block
HINTS = {"article": 3.0, "main": 3.0, "nav": BAD, "aside": BAD, "footer": BAD, "header": BAD,
         "menu": BAD, "form": BAD}
ROLES = {"main": 3.0, "article": 3.0, "navigation": BAD, "banner": BAD, "contentinfo": BAD,
         "complementary": BAD, "search": BAD, "alert": BAD, "alertdialog": BAD, "dialog": BAD,
         "form": BAD, "menu": BAD, "menubar": BAD}
BAD_WORDS = frozenset(
    "ad ads adsense adslot adunit adv advert adverts advertisement advertising banner breadcrumb "
    "breadcrumbs bottombar captcha comment comments commentlist consent cookie cookies copyright disclaimer disqus "
    "footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "notices notification overlay pager pagination paywall popup promo promoted promotion rail "
    "recommended related replies reply respond search share sharing shoutbox sidebar signup skip "
    "social sponsor sponsored subscribe subscription teaser toolbar topbar widget".split())
GOOD_WORDS = frozenset(
    "article articlebody body content entry entrytext main maintext post posttext story storytext "
    "text".split())
SHORT_CUES = re.compile(
    r"©|\(c\) ?\d{4}|all rights reserved|cookie|subscribe|sign (?:up|in)|log ?in|newsletter|"
    r"advertis|sponsored|privacy policy|terms of (?:use|service)|share (?:this|on)|"
    r"read more|related (?:posts|articles)|leave a (?:comment|reply)|posted by", re.I)

BLOCK_EDGE, CONTAINER_EDGE, UNIT = 1.2, 0.8, 1000
FARTHEST = 8
TAG = re.compile(
    r"""</?([a-zA-Z][^\s/>]*)([^>"']*(?:(?:"[^"]*"|'[^']*')[^>"']*)*)>""")
TAG_START = re.compile("</?[a-zA-Z]")
PLAIN_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([a-zA-Z][\w-]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
LAYOUT = re.compile(r"(?:^|\s)(?:has|with|without|no|is)[-_][\w-]*", re.I)
WORD = re.compile(r"[a-z]+|[A-Z](?:[a-z]+|[A-Z]*(?![a-z]))")
SENTENCE = re.compile(r"[.!?…。](?:\s|$)")


# --- page to blocks ---------------------------------------------------------------------------

@dataclass(slots=True)
class Node:
    tag: str
    up: Node | None
    depth: int
    hint: float = 0.0          # sum over the tags around
    inside: bool = False       # within an article
    unseen: bool = False
    heading: bool = False
    link: bool = False
    item: bool = False
    form: bool = False         # only a form speaks against it


@dataclass(slots=True)
class Block:
    node: Node
    text: str
    linked: int                # characters in links


def attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        out.setdefault(m[1].lower(), (m[2] or "").strip("\"'"))
    return out


def hint_of(tag: str, source: str, up: Node) -> tuple[float, bool]:
    """(what a tag says about the text in it, whether that text is seen)."""
    hint, seen = HINTS.get(tag, 0.0), tag not in UNSEEN
    if tag == "header" and up.inside:
        hint = 0.0                                   # the head of an article is its title
    if not source or source.isspace() or tag in ("html", "body"):
        return hint, seen
    found = attributes(source)
    style = found.get("style", "").replace(" ", "").lower()
    seen &= not ("hidden" in found or "display:none" in style or "visibility:hidden" in style
                 or found.get("aria-hidden") == "true")
    hint = ROLES.get(found.get("role", "").lower(), hint)
    named = LAYOUT.sub(" ", f"{found.get('class', '')} {found.get('id', '')}")
    words = {w.lower() for w in WORD.findall(named)}
    bad, good = words & BAD_WORDS, words & GOOD_WORDS
    if good or up.inside:
        bad = bad - {"header"}
    if bad and not (tag in ("article", "main") and good):
        hint = BAD
    elif good and hint == 0 and tag not in INLINE:
        hint = 2.0
    return hint, seen


def opened(tag: str, source: str, up: Node) -> Node:
    hint, seen = hint_of(tag, source, up)
    node = Node(tag, up, up.depth + 1, up.hint, up.inside, up.unseen or not seen, up.heading,
                up.link or tag == "a", up.item or tag == "li", up.form)
    if len(tag) == 2 and tag[0] == "h" and tag[1] in "123456":
        node.heading = True
    if hint > 0 and up.form:
        node.hint, node.form, node.inside = hint, False, True    # a form around the whole page
    elif hint > 0 and up.hint >= 0:
        node.hint, node.inside = max(up.hint, hint), True
    elif hint < 0:
        node.hint, node.inside = min(up.hint, 0.0) + hint, False
        node.form = tag == "form" and up.hint >= 0
    return node


def blocks_of(source: str) -> list[Block]:
    """The seen text blocks of a page, in order; linear in the page."""
    root = Node("", None, 0)
    now, blocks = root, []
    pieces: list[str] = []
    linked = 0
    at, size, plain = 0, len(source), False
    low = None

    def take(text: str) -> None:
        nonlocal linked
        if not now.unseen:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if now.link:
                linked += len(text)

    def end() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                holder = now
                while holder.up is not None and holder.tag in INLINE:
                    holder = holder.up
                blocks.append(Block(holder, text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    while at < size:
        start = source.find("<", at)
        if start < 0:
            take(source[at:])
            break
        if start > at:
            take(source[at:start])
        if source.startswith("<!--", start):
            if source.startswith(("<!-->", "<!--->"), start):
                at = source.index(">", start) + 1
                continue
            stop = source.find("-->", start + 4)
            at = size if stop < 0 else stop + 3
            continue
        if source.startswith(("<!", "<?"), start):
            stop = source.find(">", start)
            at = size if stop < 0 else stop + 1
            continue
        if not TAG_START.match(source, start):
            take("<")
            at = start + 1
            continue
        m = (PLAIN_TAG if plain else TAG).match(source, start)
        if m is None and not plain:                  # a quote is never closed: read on without
            m, plain = PLAIN_TAG.match(source, start), True
        if m is None:                                # the page ends within a tag
            break
        at, tag = m.end(), m[1].lower()
        if source[start + 1] == "/":
            if tag == "br":
                end()
                continue
            found = now
            while found.up is not None and found.tag != tag:
                found = found.up
            if found.up is None:
                if tag == "p":
                    end()
                continue
            if tag not in INLINE:
                end()
            now = found.up
            continue
        if tag in VOID:
            if tag not in INLINE:
                end()
            continue
        if tag in RAW:
            low = source.lower() if low is None else low
            if len(low) != size:                     # lower case of another length
                low = "".join(c.lower() if c.isascii() else c for c in source)
            stop = low.find(f"</{tag}", at)
            at = size if stop < 0 else stop
            if tag not in INLINE:
                end()
            if stop >= 0:
                shut = source.find(">", stop)
                at = size if shut < 0 else shut + 1
            continue
        if tag not in INLINE:
            end()
            if tag not in INSIDE_P or tag == "p":
                now = ended(now, {"p"}, {"table", "td", "th", "button", "object", "article",
                                         "section", "div", "li", "ul", "ol"})
            if tag in CLOSES:
                now = ended(now, *CLOSES[tag])
        if now.depth >= DEEPEST:
            now = now.up
        now = opened(tag, m[2], now)
    end()
    return blocks


def ended(now: Node, tags: set[str], limit: set[str]) -> Node:
    """Where the tree stands after open ``tags`` below the nearest of ``limit`` are closed."""
    found, node = None, now
    while node.up is not None and node.tag not in limit:
        if node.tag in tags:
            found = node
        node = node.up
    return now if found is None else found.up


# --- costs and edges --------------------------------------------------------------------------

def score(block: Block) -> float:
    """Log-odds of content, from the block's words and the tags around it."""
    node, text = block.node, block.text
    words = text.count(" ") + 1
    z = -0.6 + min(3.0, 0.45 * math.log2(1 + words)) + node.hint
    z -= 4.0 * block.linked / len(text)
    z += 0.5 * sum(1 for _ in islice(SENTENCE.finditer(text), 3))
    if node.tag in ("p", "pre", "blockquote"):
        z += 0.8
    if node.heading:
        z += 0.8 if node.inside else 0.2
    if node.item and not node.inside:
        z -= 0.8
    if len(text) < 160 and SHORT_CUES.search(text):
        z -= 2.5
    return max(-9.0, min(9.0, z))


def distance(a: Node, b: Node) -> int:
    """Edges of the DOM tree between two nodes, ``FARTHEST`` at most."""
    steps = 0
    while a is not b and steps < FARTHEST:
        if a.depth >= b.depth and a.up is not None:
            a = a.up
        elif b.up is not None:
            b = b.up
        else:
            break
        steps += 1
    return steps


def edges_of(blocks: list[Block]) -> Iterator[tuple[int, int, float]]:
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        if i:
            yield i - 1, i, BLOCK_EDGE / (1 + distance(blocks[i - 1].node, block.node))
        holder = block.node.up or block.node
        before = last.get(id(holder))
        if before is not None:
            yield before, i, CONTAINER_EDGE / (1 + distance(blocks[before].node, block.node))
        last[id(holder)] = i


# --- minimum cut ------------------------------------------------------------------------------

def minimum_cut(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """Which nodes lie on the source's side of a minimum cut.

    ``gains`` are capacities from the source (positive) or to the sink (negative), ``edges`` have
    one capacity either way.  Blocking flows in levels (Dinic), without recursion.
    """
    n = len(gains)
    near: list[list[int]] = [[] for _ in range(n)]     # edge numbers; edge ^ 1 is the way back
    to: list[int] = []
    room: list[int] = []
    for a, b, capacity in edges:
        near[a].append(len(to))
        near[b].append(len(to) + 1)
        to += [b, a]
        room += [capacity, capacity]
    left = gains[:]
    while True:
        level = [0 if g > 0 else -1 for g in left]
        queue = deque(i for i in range(n) if left[i] > 0)
        reached = False
        while queue:
            a = queue.popleft()
            if left[a] < 0:
                reached = True
                continue
            for e in near[a]:
                b = to[e]
                if room[e] and level[b] < 0:
                    level[b] = level[a] + 1
                    queue.append(b)
        if not reached:
            return [v >= 0 for v in level]
        turn = [0] * n
        for start in range(n):
            while left[start] > 0:
                path, a = [], start
                while left[a] >= 0:
                    while turn[a] < len(near[a]):
                        e = near[a][turn[a]]
                        if room[e] and level[to[e]] == level[a] + 1:
                            break
                        turn[a] += 1
                    else:
                        if not path:
                            break
                        a = to[path.pop() ^ 1]
                        turn[a] += 1
                        continue
                    path.append(e)
                    a = to[e]
                if left[a] >= 0:
                    break
                flow = min([left[start], -left[a], *[room[e] for e in path]])
                left[start] -= flow
                left[a] += flow
                for e in path:
                    room[e] -= flow
                    room[e ^ 1] += flow


def main_text(source: str | None) -> str:
    blocks = blocks_of(source or "")
    if not blocks:
        return ""
    gains = [round(UNIT * score(b)) for b in blocks]
    kept = minimum_cut(gains, [(a, b, round(UNIT * w)) for a, b, w in edges_of(blocks)])
    return " ".join(b.text for b, keep in zip(blocks, kept) if keep)


def extract(pages: DataFrame, html_column: str = "html", out: str = "main_text") -> DataFrame:
    """``pages`` with the main text of each as last column, ``out`` or, where that name is taken,
    ``out`` with underscores."""
    out, source = free_name(pages, out), free_name(pages, "_source")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([main_text(s.as_py()) for s in batch.columns[-1]], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], made], names=[*batch.schema.names[:-1], out])

    return pages.withColumn(source, F.col(html_column)).mapInArrow(
        run, with_fields(pages, f"`{out}` string"))
