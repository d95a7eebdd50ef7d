"""Main text of web pages by minimum-cut labelling.

A page is cut into blocks of text. A classifier gives each block the cost of calling it content and
that of calling it boilerplate; these are the capacities of its edges from the source and to the
sink. Edges between neighbouring blocks, and between blocks of the same parent, make it dear to
label what belongs together differently. The maximum flow then separates content from boilerplate
at the least total cost.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter, deque
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import functions as F

# Names of HTML elements by what they do to text, and words in class, id and role.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q "
    "rp rt ruby s samp small span strike strong sub sup td th time tt u var wbr".split()
)
#: Their text never counts.
SILENT = frozenset(
    "button canvas datalist head iframe map math nav noscript object option script select "
    "style svg template textarea title".split()
)
#: In a form theirs doesn't either.
LABELS = frozenset("label legend".split())
#: Of these, one that is never closed ends where a block begins.
CONTROLS = frozenset("button datalist label legend option select".split())
GOOD_TAGS = frozenset("article main".split())
BAD_TAGS = frozenset("aside dialog footer menu nav".split())
#: A new one closes an open one of the same group.
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
GOOD_WORDS = re.compile(
    r"\b(article|articlebody|content|entry|main|maincontent|post|story|text)\b"
)
#: Badness of a form, and of names: of any other thing, of what stands beside the text, and of what
#: readers or other pages say.
FORM, NAMED, SIDE, FIRM = 1, 2, 3, 4
BAD_WORDS = {
    word: level
    for level, words in (
        (NAMED, "ad ads advert advertisement adverts alert banner byline consent cookie cookies gdpr "
         "login masthead modal newsletter notice notices overlay popup promo search share sharing "
         "signup social sponsor sponsored subscribe tag tags toolbar widget"),
        (SIDE, "breadcrumb breadcrumbs footer menu nav navbar navigation pagination sidebar"),
        (FIRM, "comment comments disqus related replies"),
    )
    for word in words.split()
}
#: Words that may come before a bad word in the name of a bad thing, and after it.
_PLACES = (
    "article bottom entry fixed global google header inline left lower main mobile page post "
    "primary right secondary site sticky story top upper user"
)
_PARTS = (
    "area author bar block body bottom box btn button buttons close cloud column container content "
    "count form header heading icon icons inline inner item items left link links list main media "
    "meta outer overlay panel primary reply respond right row secondary section slot text thread "
    "title top unit wrap wrapper"
)
_OTHERS = "article articles content items news pages post posts stories story topics"


def _bad_name() -> re.Pattern:
    def any_of(words):
        return "(?:" + "|".join(words) + ")"

    bad, parts = any_of(BAD_WORDS), any_of(_PARTS.split())
    after = rf"(?:[-_]+(?:{bad}|{parts}|\d+(?:x\d+)?))*"
    return re.compile(
        rf"(?:{any_of(_PLACES.split())}[-_]+)*"
        rf"(?:tag(?:[-_]+{parts})*|related[-_]+{any_of(_OTHERS.split())}{after}|(?!tag\b|tag_){bad}{after})"
    )


_BAD_NAME = _bad_name()


@lru_cache(10_000)
def _badness(name: str) -> int:
    """How bad a class, id or role is: it must name a bad thing as a whole, as ``cookie-notice`` does.

    What only tells of one, like ``tag-politics``, ``with-sidebar`` or ``comments-open``, is not bad.
    """
    if not _BAD_NAME.fullmatch(name):
        return 0
    return max(BAD_WORDS.get(word, 0) for word in re.split("[-_]+", name))


# Weights of the classifier's logistic curve, and of the edges.
W_BASE, W_GOOD, W_BAD, W_LINKS, W_LONG, W_ENDS, W_HEADING, W_LEGAL = -0.5, 4.0, -6.0, -4.0, 0.35, 0.6, 0.4, -2.5
E_NEXT, E_SIBLING = 0.3, 0.9
#: What is left of an edge between blocks of different kind.
UNLIKE = 0.25
#: Link-poor text under a bad name, in blocks of so many characters, begins to outweigh the name at the
#: first number of characters and does so wholly at the second.
PROSE, DOUBTED, REFUTED = 40, 400, 2000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|noscript|iframe)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-zA-Z][^<>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
#: One attribute after the other: its name, and its value if there is one.
_ATTRIBUTE = re.compile(
    r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?",
)


#: Forms, and elements of bad name only, that something is in: the innermost one and the others.
Chain = tuple[int, "Chain | None"]


@dataclass(slots=True)
class _Element:
    tag: str
    number: int
    good: bool
    bad: int
    named: Chain | None
    form: bool
    silent: bool
    link: bool
    #: Its place on the stack, and that of the innermost element around it that makes a block.
    at: int = 0
    holder: int = 0


@dataclass(slots=True)
class Block:
    """A run of text without a block border, with what is known of its place."""

    text: str
    parent: int
    good: bool
    bad: bool
    heading: bool
    linked: float
    #: Their text may outweigh their name.
    named: Chain | None = None


def _open(tag: str, attrs: str, parent: _Element, number: int) -> _Element:
    good, bad, named = parent.good, parent.bad, parent.named
    form = parent.form
    silent = parent.silent or tag in SILENT or (form and tag in LABELS)
    # An article stands for itself unless it lies beside the text, a main part even there; neither does
    # inside an aside, a footer, a list of comments or the like.
    if tag in GOOD_TAGS and bad < (SIDE if tag == "article" else FIRM):
        good, bad, named, form = True, 0, None, False
    elif tag == "form":
        bad, named, form = max(bad, FORM), (number, named), True
    elif tag in BAD_TAGS:
        bad = FIRM
    elif tag == "header" and not good:
        bad = max(bad, NAMED)
    if attrs and tag not in ("html", "body"):
        words, seen = [], set()
        for name, *values in _ATTRIBUTE.findall(attrs):
            name, value = name.lower(), next((v for v in values if v), "").lower()
            if name in seen:
                continue  # only the first of a name counts
            seen.add(name)
            if name == "hidden" or (name == "aria-hidden" and value == "true"):
                silent = True
            elif name == "style":
                silent = silent or bool(re.search(r"display\s*:\s*none", value))
            elif name in ("class", "id", "role", "itemprop"):
                words += value.split()
        called_good = GOOD_WORDS.search(re.sub(r"[-_]+", " ", " ".join(words)))
        level = max(map(_badness, words), default=0)
        if tag in GOOD_TAGS and (level < FIRM or called_good):
            level = 0  # the element outweighs the name
        if level:
            bad = max(bad, level)
            if level < FIRM and not (named and named[0] == number):
                named = (number, named)
        elif called_good and bad <= FORM:
            good = True
    return _Element(tag, number, good, bad, named, form, silent, parent.link or tag == "a")


def _closed_controls(page: str, start: int) -> set[int]:
    """Where the controls begin that are closed before another one of their tag opens."""
    opened: dict[str, int] = {}
    closed = set()
    for m in _TOKEN.finditer(page, start):
        tag = (m["tag"] or "").lower()
        if tag in CONTROLS:
            if not m["end"]:
                opened[tag] = m.start()
            elif tag in opened:
                closed.add(opened.pop(tag))
    return closed


def blocks(page: str | None) -> list[Block]:
    """The blocks of a page in order, references decoded and white space made single spaces."""
    page = page or ""
    found: list[Block] = []
    stack = [_Element("", 0, False, 0, None, False, False, False)]
    opened: Counter[str] = Counter()  # tags on the stack, so that stray ends cost one look
    parts: list[str] = []
    linked = total = number = 0
    closed: set[int] | None = None
    loose: set[int] = set()

    def flush() -> None:
        nonlocal linked, total
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                holder = stack[stack[-1].holder]
                heading = len(holder.tag) == 2 and holder.tag[0] == "h" and holder.tag[1].isdigit()
                share = linked / total if total else 0.0
                outer = stack[max(0, holder.at - 1)]
                named = holder.named if holder.bad < FIRM else None
                bad = holder.bad > 0
                found.append(Block(text, outer.number, holder.good, bad, heading, share, named))
        linked = total = 0

    def push(element: _Element) -> None:
        element.at = len(stack)
        element.holder = stack[-1].holder if stack and element.tag in INLINE else element.at
        stack.append(element)
        opened[element.tag] += 1

    def close(i: int) -> None:
        """End the elements from place ``i`` on."""
        opened.subtract(e.tag for e in stack[i:])
        del stack[i:]

    def add(text: str) -> None:
        nonlocal linked, total
        top = stack[-1]
        if text and not top.silent:
            parts.append(html.unescape(text) if "&" in text else text)
            size = len(text)
            total += size
            linked += size if top.link else 0

    at = 0
    for m in _TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        tag = m["tag"]
        if not tag:
            continue
        tag = tag.lower()
        if tag in ("br", "td", "th"):
            parts.append(" ")
        if tag not in INLINE:
            flush()
        if m["end"]:
            if opened[tag]:
                i = next(i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag)
                if any(e.tag not in INLINE for e in stack[i:]):
                    flush()
                close(i)
            continue
        if tag == "body" and opened["head"]:
            kept = [e for e in stack[1:] if e.tag != "head"]
            close(1)
            for element in kept:
                push(element)
        if loose and tag not in INLINE and tag not in ("option", "optgroup"):
            ended = next((i for i, e in enumerate(stack) if e.number in loose), len(stack))
            close(ended)
            loose.clear()
        group = CLOSES.get(tag, ())
        if any(opened[t] for t in group):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ("table", "ul", "ol", "dl", "div", "article"):
                    break
                if stack[i].tag in group:
                    flush()
                    close(i)
                    break
        if tag not in VOID and not m["attrs"].rstrip().endswith("/"):
            number += 1
            push(_open(tag, m["attrs"], stack[-1], number))
            if tag in CONTROLS and stack[-1].silent:
                closed = _closed_controls(page, m.start()) if closed is None else closed
                if m.start() not in closed:
                    loose.add(number)
    add(page[at:])
    flush()
    return found


def _doubts(found: list[Block]) -> dict[int, float]:
    """For each element of bad name the share of its and its outer ones' weight that text outweighs.

    Outside of what is called good, only text beyond the text that is called good counts.
    """
    outer: dict[int, int] = {}
    prose: Counter[int] = Counter()
    inside: set[int] = set()
    good = 0
    for block in found:
        long = len(block.text) >= PROSE and block.linked < 0.3
        if long and block.good and not block.bad:
            good += len(block.text)
        chain = block.named
        if chain:
            prose[chain[0]] += len(block.text) if long else 0
            if block.good:
                inside.add(chain[0])
        while chain and chain[0] not in outer:
            above = chain[1] if len(chain) > 1 else None  # a chain of one has nothing outside
            outer[chain[0]] = above[0] if above else 0
            chain = above
    # Elements are numbered as they open, so an inner one has the greater number.
    for element in sorted(outer, reverse=True):
        prose[outer[element]] += prose[element]
        if element in inside:
            inside.add(outer[element])
    shares = {0: 1.0}
    for element in sorted(outer):
        size = prose[element] - (0 if element in inside else good)
        share = math.log(max(size, 1) / DOUBTED) / math.log(REFUTED / DOUBTED)
        shares[element] = min(shares[outer[element]], max(0.0, share))
    return shares


def _costs(block: Block, doubts: dict[int, float]) -> tuple[float, float]:
    """Cost of calling a block boilerplate, and of calling it content: minus log probabilities."""
    z = W_BASE + W_LINKS * block.linked + W_LONG * math.log(len(block.text))
    if block.named:
        z += W_BAD * (1.0 - doubts[block.named[0]])
        z += W_GOOD / 2 if block.good else 0.0
    elif block.bad:
        z += W_BAD
    elif block.good:
        z += W_GOOD
    if block.text[-1] in ".!?…。":
        z += W_ENDS
    if block.heading:
        z += W_HEADING
    if "©" in block.text or "all rights reserved" in block.text.lower():
        z += 0.0 if block.good and not block.bad else W_LEGAL
    return math.log1p(math.exp(min(z, 40.0))), math.log1p(math.exp(min(-z, 40.0)))


class _Flow:
    """Maximum flow by shortest augmenting paths in layers; node 0 is the source, 1 the sink."""

    def __init__(self, nodes: int):
        self._edges: list[list[int]] = [[] for _ in range(nodes)]
        self._to: list[int] = []
        self._room: list[float] = []

    def join(self, a: int, b: int, forth: float, back: float = 0.0) -> None:
        for here, there, room in ((a, b, forth), (b, a, back)):
            self._edges[here].append(len(self._to))
            self._to.append(there)
            self._room.append(room)

    def _layers(self) -> list[int]:
        layer = [-1] * len(self._edges)
        layer[0], queue = 0, deque([0])
        while queue:
            a = queue.popleft()
            for e in self._edges[a]:
                b = self._to[e]
                if layer[b] < 0 and self._room[e] > 1e-12:
                    layer[b] = layer[a] + 1
                    queue.append(b)
        return layer

    def source_side(self) -> list[bool]:
        """Saturate the network; which nodes the source still reaches."""
        while (layer := self._layers())[1] >= 0:
            tried = [0] * len(self._edges)
            path: list[int] = []
            node = 0
            while True:
                if node == 1:
                    least = min(self._room[e] for e in path)
                    for e in path:
                        self._room[e] -= least
                        self._room[e ^ 1] += least
                    path.clear()
                    node = 0
                    continue
                while tried[node] < len(self._edges[node]):
                    e = self._edges[node][tried[node]]
                    if self._room[e] > 1e-12 and layer[self._to[e]] == layer[node] + 1:
                        break
                    tried[node] += 1
                if tried[node] < len(self._edges[node]):
                    path.append(e)
                    node = self._to[e]
                elif path:
                    node = self._to[path.pop() ^ 1]
                    tried[node] += 1
                else:
                    break
        return [depth >= 0 for depth in layer]


def content(found: list[Block]) -> list[bool]:
    """Which blocks are content."""
    if not found:
        return []
    flow = _Flow(len(found) + 2)
    last: dict[int, int] = {}
    doubts = _doubts(found)
    for i, block in enumerate(found):
        boilerplate, own = _costs(block, doubts)
        flow.join(0, i + 2, boilerplate)
        flow.join(i + 2, 1, own)
        alike = block.good == (before := found[i - 1]).good and block.bad == before.bad
        if i:
            room = E_NEXT if alike else E_NEXT * UNLIKE
            flow.join(i + 1, i + 2, room, room)
        sibling = last.get(block.parent)
        if sibling is not None:
            room = E_SIBLING if found[sibling].bad == block.bad else E_SIBLING * UNLIKE
            flow.join(sibling + 2, i + 2, room, room)
        last[block.parent] = i
    return flow.source_side()[2:]


def main_text(page: str | None) -> str:
    """The content blocks of a page, two line ends between them; empty if there are none."""
    found = blocks(page)
    return "\n\n".join(b.text for b, keep in zip(found, content(found), strict=True) if keep)


def extract():
    """A column function: the main text of a whole page. NULL and empty pages give empty text.

    Every page is read by itself and whole, in time that grows with its length, however deep its
    elements lie; equal pages have equal texts.
    """

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p) for p in pages.to_pylist()], pa.string())

    return run
