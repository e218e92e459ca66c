"""Main text of web pages by minimum-cut labelling of their blocks.

A page is cut into blocks: text between tags that start a new block. A classifier gives each
block a cost of being called content and a cost of being called boilerplate, from what encloses
it (the nearest telling element wins) and from its words and links. Costs are the capacities to
the two terminals of a flow network; blocks that follow each other, and blocks with the same
parent, are joined by smoothness edges that weaken with their distance in the document tree. A
maximum flow gives the minimum cut, that is the cheapest labelling; blocks on the content side
are the text.

Scripts, styles, forms, comments and other elements without running text have no blocks. Line
breaks and all white space inside a block become one space. Broken markup is read as browsers
do: unclosed elements end with their parent, text after a cut-off tag counts. Null or empty
html gives an empty text; pages are independent, so repeated rows give equal results. Whole
pages are read, whatever their length.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from colsight.llm.common import batch_of, map_arrow

TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(>|$)", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe plaintext".split())
SILENT = frozenset("script style template noscript textarea title head select option button svg math object canvas audio video iframe noembed noframes xmp plaintext datalist map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {  # a start tag -> the open elements that it ends, up to a limit
    **{t: frozenset(["p"]) for t in "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()},
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
LIMITS = frozenset("article aside section div ul ol dl table nav header footer main form body td th li blockquote figure".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar status".split())
CONTENT_TAGS = frozenset(["article", "main"])
CONTENT_ROLES = frozenset(["main", "article"])
BOILERPLATE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner banners breadcrumb breadcrumbs byline comment comments commentlist consent cookie cookies copyright "
    "disclaimer disqus dropdown footer gdpr header hidden legal login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination paywall popup popular promo promoted promotion recommended related replies reply respond search share sharing sidebar signin signup skip social "
    "sponsor sponsored sponsors subscribe subscription tags taboola teaser toolbar topbar tracking widget widgets".split()
)
CONTENT_NAMES = frozenset("article content entry main post story text body".split())
# names that begin so tell what an element has, lacks or is filed under, not what it is
MODIFIERS = frozenset("no not without with has tag format status".split())
# these can as well name a subject; they tell something alone or beside a word for a listing or a tool
SUBJECTS = frozenset("popular related recommended legal social promoted".split())
LISTINGS = frozenset("article articles bar block box button buttons content icons item items link links list media news note notice page pages post posts reads section stories story text widget".split())

STRONG, ENCLOSED, SMOOTH = 40.0, 6.0, 1.0


def telling(parts: list[str]) -> list[str]:
    """The parts of a class or id that tell what its element is."""
    if len(parts) < 2:
        return parts
    if parts[0] in MODIFIERS:
        return []
    if "header" in parts and not CONTENT_NAMES.isdisjoint(parts):  # an article's header holds its title
        parts = [x for x in parts if x != "header"]
    return parts if len(parts) == 1 or not LISTINGS.isdisjoint(parts) else [x for x in parts if x not in SUBJECTS]


class Element:
    __slots__ = ("tag", "parent", "depth", "evidence", "silent", "link")

    def __init__(self, tag: str, parent, attributes: str):
        self.tag, self.parent = tag, parent
        self.depth = parent.depth + 1 if parent else 0
        self.silent = tag in SILENT or bool(parent and parent.silent)
        self.link = tag == "a" or bool(parent and parent.link)
        own = self.look(attributes)
        self.evidence = own if own else parent.evidence if parent else 0

    def look(self, attributes: str) -> int:
        """1 content, -1 boilerplate, 0 the element says nothing. Inner elements overrule outer ones."""
        names: set[str] = set()
        role = ""
        if attributes and not attributes.isspace():
            for key, a, b, c, bare in ATTRIBUTE.findall(attributes):
                key, value = key.lower(), a or b or c
                if key in ("class", "id"):
                    for word in value.split():
                        names.update(telling([x.lower() for x in NAME_PART.findall(word)]))
                elif key == "role":
                    role = value.strip().lower()
                elif bare or key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                    self.silent = self.silent or self.tag not in ("html", "body")
        if self.tag in ("html", "body"):
            return 0
        if self.tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or names & BOILERPLATE_NAMES:
            return -1
        if self.tag in CONTENT_TAGS or role in CONTENT_ROLES:
            return 1
        if self.tag == "header":  # a page's header; inside an article it is the article's title
            return 0 if self.parent and self.parent.evidence > 0 else -1
        return 2 if names & CONTENT_NAMES else 0


class Block:
    __slots__ = ("parent", "text", "chars", "linked")

    def __init__(self, parent: Element, text: str, chars: int, linked: int):
        self.parent, self.text, self.chars, self.linked = parent, text, chars, linked


def blocks_of(page: str) -> list[Block]:
    root = Element("#root", None, "")
    at, found = root, []
    parts: list[tuple[str, bool]] = []
    opened: Counter[str] = Counter()  # tags of the open elements

    def leave(to: Element) -> None:
        nonlocal at
        while at is not to:
            opened[at.tag] -= 1
            at = at.parent

    def end() -> None:
        if parts:
            text = " ".join("".join(t for t, _ in parts).split())
            if text:
                holder = at
                while holder.tag in INLINE and holder.parent:
                    holder = holder.parent
                chars = sum(not c.isspace() for t, _ in parts for c in t) if any(l for _, l in parts) else len(text)
                linked = sum(not c.isspace() for t, l in parts if l for c in t)
                found.append(Block(holder, text, max(chars, 1), linked))
            parts.clear()

    def say(text: str) -> None:
        if text and not at.silent:
            parts.append((entities.unescape(text) if "&" in text else text, at.link))

    place = 0
    while True:
        token = TOKEN.search(page, place)
        if not token:
            say(page[place:])
            break
        say(page[place : token.start()])
        place = token.end()
        tag = token[2]
        if tag is None:
            if token[0] == "<!":
                say(token[0])
            continue
        tag = tag.lower()
        if tag == "br":
            if not at.silent:
                parts.append((" ", False))
            continue
        if tag not in INLINE:
            end()
        if token[1]:  # end tag: ends the nearest open element of its name, if there is one
            open_ = at if opened[tag] else None
            while open_ and open_.tag != tag:
                if open_.tag in LIMITS and tag in INLINE:  # an inline end tag never ends a block
                    open_ = None
                    break
                open_ = open_.parent
            if open_ is not None and open_ is not root:
                leave(open_.parent)
            continue
        ends = CLOSES.get(tag)
        if ends:
            open_ = at
            while open_ is not root and (open_.tag in ends or open_.tag in INLINE or open_.tag not in LIMITS):
                if open_.tag in ends:
                    leave(open_.parent)
                open_ = open_.parent
            if open_ is not root and open_.tag in ends:
                leave(open_.parent)
        if tag == "body":  # whatever the head left open
            leave(root)
        if tag in VOID or token[3].rstrip().endswith("/") and tag not in INLINE | LIMITS:
            continue
        element = Element(tag, at, token[3])
        if tag in RAW:  # no markup inside
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, place)
            place = close.end() if close else len(page)
            continue
        at = element
        opened[tag] += 1
    end()
    return found


def costs(block: Block) -> tuple[float, float]:
    """Cost of calling the block content, and of calling it boilerplate."""
    evidence = block.parent.evidence
    if evidence < 0:
        return STRONG, 0.0
    words = block.text.count(" ") + 1
    links = block.linked / block.chars
    as_content = 0.5 + 5.0 * links
    as_boilerplate = min(words, 40) / 10 * (1 - links) + (1.0 if block.text[-1] in ".!?…\"”»" and words > 3 else 0.0)
    if block.parent.tag in ("h1", "h2", "h3", "h4", "h5", "h6", "p", "pre", "blockquote", "td", "dd"):
        as_boilerplate += 0.6
    if evidence == 1:
        as_boilerplate += ENCLOSED
    elif evidence == 2:
        as_boilerplate += 1.5
    return as_content, as_boilerplate


def nearness(a: Element, b: Element) -> float:
    """1 / steps between two elements over their common ancestor."""
    steps = 1
    while a is not b and steps < 9:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return 1 / steps


class Network:
    """Maximum flow by shortest augmenting levels; arcs come in pairs, each the other's reverse."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[float] = []

    def add(self, a: int, b: int, there: float, back: float) -> None:
        self.arcs[a].append(len(self.to))
        self.arcs[b].append(len(self.to) + 1)
        self.to += (b, a)
        self.room += (there, back)

    def levels(self, s: int) -> list[int]:
        level = [-1] * len(self.arcs)
        level[s] = 0
        queue = deque([s])
        while queue:
            a = queue.popleft()
            for e in self.arcs[a]:
                if self.room[e] > 1e-9 and level[self.to[e]] < 0:
                    level[self.to[e]] = level[a] + 1
                    queue.append(self.to[e])
        return level

    def push_all(self, s: int, t: int) -> list[int]:
        """Runs the flow to its maximum; the levels tell the source's side."""
        while True:
            level = self.levels(s)
            if level[t] < 0:
                return level
            turn = [0] * len(self.arcs)
            path: list[int] = []
            a = s
            while True:
                if a == t:
                    least = min(self.room[e] for e in path)
                    for e in path:
                        self.room[e] -= least
                        self.room[e ^ 1] += least
                    first = next(i for i, e in enumerate(path) if self.room[e] <= 1e-9)
                    a = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                arcs = self.arcs[a]
                while turn[a] < len(arcs):
                    e = arcs[turn[a]]
                    if self.room[e] > 1e-9 and level[self.to[e]] == level[a] + 1:
                        break
                    turn[a] += 1
                else:
                    if a == s:
                        break
                    e = path.pop()
                    a = self.to[e ^ 1]
                    turn[a] += 1
                    continue
                path.append(e)
                a = self.to[e]


def label(found: list[Block]) -> list[bool]:
    """Whether each block is content: the minimum cut."""
    n = len(found)
    source, sink = n, n + 1
    network = Network(n + 2)
    before: dict[int, int] = {}
    for i, block in enumerate(found):
        as_content, as_boilerplate = costs(block)
        both = min(as_content, as_boilerplate)  # flows straight through
        if as_boilerplate > both:
            network.add(source, i, as_boilerplate - both, 0.0)
        if as_content > both:
            network.add(i, sink, as_content - both, 0.0)
        if i:
            weight = SMOOTH * nearness(found[i - 1].parent, block.parent)
            network.add(i - 1, i, weight, weight)
        parent = id(block.parent.parent)
        if before.get(parent, i - 1) < i - 1:
            network.add(before[parent], i, SMOOTH / 2, SMOOTH / 2)
        before[parent] = i
    level = network.push_all(source, sink)
    return [level[i] >= 0 for i in range(n)]


def main_text(page: str | None) -> str:
    found = blocks_of(page) if page else []
    return "\n".join(b.text for b, keep in zip(found, label(found)) if keep) if found else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def make():
        def run(batch):
            if batch is None:
                return []
            text = [main_text(h) for h in batch.column("html").to_pylist()]
            return [batch_of(page_id=batch.column("page_id"), url=batch.column("url"), text=pa.array(text, pa.string()), n_chars=pa.array([len(t) for t in text], pa.int64()))]

        return run

    return map_arrow(pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string")), make, "page_id bigint, url string, text string, n_chars bigint")
