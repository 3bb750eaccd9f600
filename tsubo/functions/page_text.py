"""Elements and text of one HTML page.

A small helper for the page operators: it only opens the page; blocks, units
and links become rows and columns in Spark.  One regular expression walks over
the tags, two to three times as fast as the standard library's parser; attributes
are read only where somebody asks for them.  Pages of one make differ in text and
links alone: ``Reader`` builds their tree once, and a ``Form`` finds the values
of many such pages without one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from html import unescape
from operator import attrgetter
from typing import NamedTuple

# Elements without content, elements whose end tag may be left
# out (closed by the next of their kind, inside the given parents), and
# elements whose text is not page text.
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
}
NOT_TEXT = {"script", "style", "template", "rt", "rp"}
NO_TAGS_INSIDE = {
    "script": re.compile(r"</script(?=[\s/>])", re.I),
    "style": re.compile(r"</style(?=[\s/>])", re.I),
}

# A tag with its quoted attribute values, a comment, a declaration, or a broken
# beginning of one.  The possessive quantifiers keep a broken tag from being
# tried in many ways.
TOKEN = re.compile(
    r"""<(?:(/)?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*+>|([a-zA-Z!?/]))""", re.S
)
# The same for splitting a whole page: a script or style takes its content along,
# and the first broken tag takes the rest of the page.
WHOLE = re.compile(
    r"""<(?:(?i:(script|style))(?=[\s/>])((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>.*?(?=</(?i:\1)[\s/>]|\Z)"""
    r"""|(/)?([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|!--.*?(?:-->|\Z)|[!?/][^>]*+>|([a-zA-Z!?/]).*+)""", re.S
)
OPENING = re.compile(r"<(/)?[a-zA-Z]")
NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile(r"""[>"']""")
CLOSED_COMMENT = re.compile(r"<!--.*-->", re.S)
AMPERSAND = re.compile(b"&")
QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")

# What a reader remembers: elements of trees, and class texts of attribute texts.
ELEMENTS_HELD, CLASSES_HELD = 200_000, 10_000
# The most tokens of a page that a form is made of.
FORM_TOKENS = 4096
PLACE = attrgetter("place")


def attribute(raw: str, name: str) -> str | None:
    """An attribute's value; the first one counts, and one without a value is empty."""
    for key, value in ATTRIBUTE.findall(raw):
        if key.lower() == name:
            value = value[1:-1] if value[:1] in ('"', "'") else value
            return unescape(value) if "&" in value else value
    return None


class Gap(NamedTuple):
    """A value that may differ between pages of one tree: the text from piece ``start`` to ``end``, or attribute ``name`` of element ``start``."""

    start: int
    end: int
    name: str | None = None


class Element:
    """One element; ``place`` to ``end`` are its descendants in the page's list."""

    __slots__ = ("page", "tag", "parent", "place", "end", "text_from", "text_to", "_classes")

    def __init__(self, page: Page, tag: str, raw: str, parent: Element | None) -> None:
        self.page, self.tag, self.parent = page, tag, parent
        self._classes: frozenset[str] | None = None
        self.place, self.text_from = len(page.elements), len(page.pieces)
        page.elements.append(self)
        page.raws.append(raw)
        page.by_tag.setdefault(tag, []).append(self)

    def close(self) -> None:
        self.end, self.text_to = len(self.page.elements), len(self.page.pieces)

    def get(self, name: str) -> str | Gap | None:
        if self.page.traced:
            return Gap(self.place, self.place, name)
        return attribute(self.page.raws[self.place], name)

    @property
    def classes(self) -> frozenset[str]:
        if self._classes is None:
            raw = self.page.raws[self.place]
            self._classes = frozenset((attribute(raw, "class") or "").split()) if raw else frozenset()
        return self._classes


class Page:
    """The tree, and what differs between pages of one tree: ``pieces`` of text, one per token, and ``raws``, attributes per element.

    While the page is ``traced``, texts and attributes are the gaps they stand in.
    """

    __slots__ = ("elements", "by_tag", "found", "opened", "hushed", "pieces", "raws", "traced", "reads", "make")

    def __init__(self) -> None:
        self.elements: list[Element] = []
        self.by_tag: dict[str, list[Element]] = {}
        self.found: dict[tuple, list[Element]] = {}  # elements that were asked for
        self.opened: list[int] = []  # the token that opens each element but the root
        self.hushed: list[int] = []  # pieces that are not page text
        self.pieces: list[str] = []
        self.raws: list[str] = []
        self.traced = False
        self.reads = 1  # pages read with this tree
        self.make: object = None  # for who reads pages of this tree by a form

    def clear(self) -> None:
        """Leaves no cycles for the collector."""
        self.elements.clear()
        self.by_tag.clear()
        self.found.clear()


class Tokens:
    """The tokens of a page, in turn.

    The expression reads well-formed pages.  After the first broken tag, ends of
    tags are sought step by step, and every quote from which no end was found is
    remembered: no later tag follows it again, so a page costs its length
    whatever is left open in it.
    """

    def __init__(self, html: str) -> None:
        self.html = html
        self.broken = False
        self.dead: set[int] = set()  # quotes after which the tag never ends
        self.missing: dict[str, int] = {}  # from here on the text does not occur
        self.ahead: dict[re.Pattern, tuple[int, int]] = {}  # what is next from the first place on, at the second

    def find(self, text: str, at: int) -> int:
        if at >= self.missing.get(text, len(self.html) + 1):
            return -1
        found = self.html.find(text, at)
        if found < 0:
            self.missing[text] = at
        return found

    def next(self, what: re.Pattern, at: int) -> int:
        """The next place of ``what`` from ``at`` on, or the end of the page; asked for ascending places."""
        since, place = self.ahead.get(what, (0, -1))
        if not since <= at <= place:
            found = what.search(self.html, at)
            place = found.start() if found else len(self.html)
            self.ahead[what] = (at, place)
        return place

    def end_of_tag(self, at: int) -> int:
        """Place of the ``>`` that ends a tag, outside quotes; -1 if there is none."""
        passed, spot = [], self.next(SPECIAL, at)
        while 0 <= spot < len(self.html) and spot not in self.dead:
            if self.html[spot] == ">":
                return spot
            passed.append(spot)
            close = self.find(self.html[spot], spot + 1)
            # not remembered as the next one: the following tag begins before it
            later = SPECIAL.search(self.html, close + 1) if close >= 0 else None
            spot = later.start() if later else -1
        self.dead.update(passed)
        return -1

    def read(self, at: int) -> Iterator[tuple[int, int, str | None, str | None, str | None]]:
        """Start, end, slash, tag and attributes of each token from ``at`` on; no tag for comments and declarations."""
        if not self.broken:
            for token in TOKEN.finditer(self.html, at):
                if token[4]:
                    self.broken, at = True, token.start()
                    break
                yield token.start(), token.end(), token[1], token[2], token[3]
        if self.broken:
            yield from self._read_broken(at)

    def _read_broken(self, at: int) -> Iterator[tuple[int, int, str | None, str | None, str | None]]:
        html = self.html
        while (start := html.find("<", at)) >= 0:
            at = start + 1
            opening = OPENING.match(html, start)
            named = self.next(NAME_END, opening.end()) if opening else 0
            end = self.end_of_tag(named) if opening else -1
            if end >= 0:
                at = end + 1
                yield start, at, opening[1], html[opening.end() - 1 : named], html[named:end]
                continue
            if html.startswith("!--", at):
                close = self.find("-->", at + 3)
                end = len(html) if close < 0 else close + 3
            elif html.startswith(("!", "?", "/"), at):
                end = self.find(">", at + 1) + 1
            if end > 0:
                at = end
                yield start, end, None, None, None


def read_page(html: str | None) -> Element:
    html = html or ""
    page = Page()
    pieces = page.pieces
    root = Element(page, "", "", None)
    open_ = [root]
    count = Counter()  # open elements by tag: a scan starts only where it can end
    silent = 0  # open elements whose text is not page text
    at = 0
    tokens = Tokens(html)
    more = True
    while more:
        more = False
        for start, end, ending, tag, raw in tokens.read(at):
            if silent:
                page.hushed.append(len(pieces))
            piece = "" if silent else html[at:start]
            pieces.append(unescape(piece) if "&" in piece else piece)
            at = end
            if tag is None:
                continue
            tag = tag.lower()
            keep = len(open_)  # how many open elements stay open
            if ending and count[tag]:
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth].tag == tag:
                        keep = depth
                        break
            elif not ending and tag in ENDS and any(count[t] for t in ENDS[tag][0]):
                closes, parents = ENDS[tag]
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth].tag in parents:
                        break
                    if open_[depth].tag in closes:
                        keep = depth
            while len(open_) > keep:
                closed = open_.pop()
                closed.close()
                count[closed.tag] -= 1
                silent -= closed.tag in NOT_TEXT
            if ending:
                continue
            element = Element(page, tag, raw, open_[-1])
            page.opened.append(len(pieces) - 1)
            if tag in VOID:
                element.close()
                continue
            open_.append(element)
            count[tag] += 1
            if tag in NOT_TEXT:
                silent += 1
                if tag in NO_TAGS_INSIDE:
                    finish = NO_TAGS_INSIDE[tag].search(html, at)
                    at = finish.start() if finish else len(html)
                    more = True
                    break
    if silent:
        page.hushed.append(len(pieces))
    pieces.append("" if silent else unescape(html[at:]))
    for element in open_:
        element.close()
    return root


class _ClassTexts(dict):
    """The class text of an attribute text."""

    def __missing__(self, raw: str | None) -> str | None:
        found = attribute(raw, "class") if raw else None
        if len(self) < CLASSES_HELD:
            self[raw] = found
        return found


class Reader:
    """Reads one page after the other; a page is valid until the next one is read.

    The tree follows from the tags and their classes alone.  Pages that agree in
    them get the tree of the first one with their own texts and attributes, found
    elements included; all others, and broken pages, are read by ``read_page``.
    """

    def __init__(self) -> None:
        self.trees: dict[tuple, Element] = {}
        self.held = 0
        self.class_texts = _ClassTexts()
        self.last: Element | None = None  # of a page that is not kept

    def read(self, html: str | None) -> Element:
        html = html or ""
        if self.last is not None:
            self.last.page.clear()
            self.last = None
        parts = WHOLE.split(html)
        broken = parts[6::7]
        if broken.count(None) < len(broken):
            self.last = read_page(html)
            return self.last
        loud, texts, slashes, names, raws = parts[1::7], parts[0::7], parts[3::7], parts[4::7], parts[5::7]
        if loud.count(None) < len(loud):
            names = [a or b for a, b in zip(loud, names)]
            raws = [own if a else raw for a, own, raw in zip(loud, parts[2::7], raws)]
        shape = (*names, *slashes, *map(self.class_texts.__getitem__, raws))
        root = self.trees.get(shape)
        if root is None:
            root = read_page(html)
            self.held += len(root.page.elements) + len(names)
            if self.held > ELEMENTS_HELD:
                for tree in self.trees.values():
                    tree.page.clear()
                self.trees.clear()
                self.held = len(root.page.elements) + len(names)
            self.trees[shape] = root
            return root
        page = root.page
        page.reads += 1
        for i in page.hushed:
            texts[i] = ""
        page.pieces = [unescape(t) if "&" in t else t for t in texts] if "&" in html else texts
        page.raws = ["", *map(raws.__getitem__, page.opened)]
        return root


class Form:
    """All tags of a page as one expression over UTF-8, with gaps for its texts and the quoted values of its attributes.

    A page that fits has the page's tokens one by one, so its tree and classes are the same: no token begins inside a
    text without ``<``, and every tag of the form ends where it does in the page.  A page that does not fit may still
    have the tree; it is for the reader.
    """

    def __init__(self, html: str, page: Page, gaps: list[Gap]) -> None:
        hushed = set(page.hushed)
        pieces = {gap: [i for i in range(gap.start, gap.end) if i not in hushed] for gap in gaps if gap.name is None}
        wanted = {i for several in pieces.values() for i in several}
        named = {gap for gap in gaps if gap.name is not None}
        asked = {(page.opened[gap.start - 1], gap.name): gap for gap in named if gap.start}
        groups: dict[int | Gap, int] = {}

        def gap_for(what: int | Gap | None, sign: str) -> str:
            if what is None:
                return f"[^{sign}]*+"
            groups[what] = len(groups)
            return f"([^{sign}]*+)"

        out, at, inside = [], 0, False
        for i, token in enumerate([*WHOLE.finditer(html), None]):
            # the content of a script is in its token
            out.append("" if inside else gap_for(i if i in wanted else None, "<"))
            if token is None:
                break
            at = token.start()
            inside = token[1] is not None
            which = 2 if inside else 5
            raw, keys = token[which] or "", set()
            quoted = {found.span() for found in QUOTED.finditer(raw)}  # as the tag has them; after a stray quote attributes differ
            for found in ATTRIBUTE.finditer(raw):
                key = found[1].lower()
                if found.span(2) in quoted and key != "class":
                    start, end = (token.start(which) + place for place in found.span(2))
                    out.append(re.escape(html[at : start + 1]))
                    out.append(gap_for(asked.get((i, key)) if key not in keys else None, html[start]))
                    at = end - 1
                keys.add(key)
            out.append(re.escape(html[at : token.end()]))
        self.match = re.compile("".join(out).encode()).fullmatch
        # The groups that make up a value, in turn; attributes without quotes are the same on all pages.
        self.groups = {gap: [groups[i] for i in several] for gap, several in pieces.items()} | {gap: [groups[gap]] for gap in named if gap in groups}
        self.fixed = {gap: attribute(page.raws[gap.start], gap.name) for gap in named if gap not in groups}


def group_values(found: re.Match) -> tuple[bytes, ...]:
    """What stands in the gaps of a form, with its character references read."""
    values = found.groups()
    if AMPERSAND.search(found.string, *found.span()):
        values = tuple([unescape(v.decode()).encode() if b"&" in v else v for v in values])
    return values


def form_of(html: str, page: Page, gaps: list[Gap]) -> Form | None:
    """The form of a page that the reader keeps a tree of; none if the page is very large or a comment ends with it."""
    last = None
    for i, last in enumerate(WHOLE.finditer(html)):
        if i >= FORM_TOKENS:
            return None
    # an open comment goes on to the end of any page
    if last and last[0].startswith("<!--") and not CLOSED_COMMENT.fullmatch(last[0]):
        return None
    return Form(html, page, gaps)


def elements(within: Element, tag: str, *classes: str) -> list[Element]:
    """Descendants with the tag and all classes, in document order."""
    page = within.page
    asked = (within.place, tag, classes)
    found = page.found.get(asked)
    if found is None:
        same = page.by_tag.get(tag, ())
        found = same[bisect_right(same, within.place, key=PLACE) : bisect_left(same, within.end, key=PLACE)]
        if classes:
            wanted = frozenset(classes)
            found = [e for e in found if wanted <= e.classes]
        page.found[asked] = found
    return found


def first(within: Element, tag: str, *classes: str) -> Element | None:
    return next(iter(elements(within, tag, *classes)), None)


def text(element: Element | None) -> str | Gap | None:
    if element is None:
        return None
    if element.page.traced:
        return Gap(element.text_from, element.text_to)
    return "".join(element.page.pieces[element.text_from : element.text_to]).strip()


def following(element: Element, tag: str) -> list[Element]:
    """Later siblings of ``element`` with the tag."""
    later = element.page.elements[element.end : element.parent.end]
    return [e for e in later if e.parent is element.parent and e.tag == tag]
