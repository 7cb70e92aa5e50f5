"""One HTML page as blocks of text, each with its place in the tree of elements.

A lenient reader: it takes tags as they come, closes what HTML closes by itself (paragraphs,
list items, cells), ignores end tags that close nothing, and skips comments and the insides of
scripts, styles and other elements that show no text. Inline elements stay inside their block;
a line break is white space.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import xxhash

_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_STOP = re.compile("[>\"']")
#: Tags of a page whose quotes may turn out to stay open before quotes count as plain signs.
OPEN_QUOTES = 8
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NAME_WORD = re.compile(r"[a-z]+")

#: How HTML treats elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template title textarea select iframe svg math object canvas audio video".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var".split()
)
CLOSED_WITHIN = {"li": ("ul", "ol"), "tr": ("table",), "td": ("tr",), "th": ("tr",), "dt": ("dl",), "dd": ("dl",)}

#: Elements, roles and whole class names and ids that stand for what is around an article.
AROUND = frozenset("nav header footer aside button menu".split())
AROUND_ROLES = frozenset("navigation banner contentinfo complementary menu".split())
AROUND_NAMES = frozenset(
    "nav navbar nav-bar main-nav site-nav navigation menu main-menu breadcrumb breadcrumbs masthead topbar site-header page-header "
    "site-footer page-footer sidebar side-bar aside ad ads ad-slot ad-unit ad-container advert adverts advertisement advertising "
    "sponsor sponsored cookie cookies cookie-notice cookie-banner cookie-bar cookie-consent consent gdpr comment comments "
    "comment-list comment-body comment-form comments-area reply replies respond disqus disqus-thread pagination pager".split()
)
#: The same, but they also stand for layout and for parts of an article: the text decides.
UNSURE = frozenset("form dialog".split())
UNSURE_ROLES = frozenset("search form dialog alert alertdialog".split())
UNSURE_NAMES = frozenset(
    "header footer widget promo promotion banner notice notices notification notifications alert popup modal overlay newsletter "
    "newsletter-signup subscribe subscription signup login login-form share share-buttons sharing social social-links social-share "
    "related related-posts related-articles search search-form search-box form toolbar copyright disclaimer".split()
)
#: In an article the elements, roles and classes named so are its own, unless the template says that they are constant.
OWN_NAMES = frozenset("header banner notice notices notification notifications alert widget search form login disclaimer copyright".split())
OWN_ROLES = frozenset("alert form search".split())
COMMENT_NAMES = frozenset("comment comments comment-body reply replies ad ads advert sponsored promo related teaser".split())
MAIN_WORDS = frozenset("article content post entry story main maincontent articlebody".split())

#: How surely an element holds the main text.
ARTICLE, MAIN, NAMED = 4, 2, 1

#: How surely an element is around it.
MAYBE, SURELY, HIDES = 1, 2, 3


def digest(*parts: str | int) -> int:
    """A signed 64-bit hash."""
    value = xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts)))
    return value - (1 << 64) if value >> 63 else value


@dataclass(frozen=True)
class Block:
    """Text of a block, the path of elements to it, its token, and which kinds of main element hold it."""

    text: str
    path: int
    around: int
    main: int

    @property
    def token(self) -> int:
        return digest(self.path, self.text)


@dataclass(frozen=True)
class _Element:
    name: str
    inline: bool
    path: int
    around: int
    main: int


def _opened(name: str, rest: str, parent: _Element) -> _Element:
    """The element of a start tag below its parent."""
    inline = name in INLINE
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)} if rest.strip() else {}
    label = f"{found.get('class', '')} {found.get('id', '')}".lower()
    words = set(_NAME_WORD.findall(label))
    names = {whole.replace("_", "-").rstrip("-0123456789") for whole in label.split()}
    role = found.get("role", "").lower()
    style = found.get("style", "").replace(" ", "").lower()
    inside = bool(parent.main & (ARTICLE | MAIN))
    around, main = parent.around, parent.main
    if name in ("article", "main") or role in ("article", "main"):
        # It ends what an element above it said, unless it is itself a comment or an advert.
        main |= ARTICLE if "article" in (name, role) else MAIN
        around = HIDES if around == HIDES else SURELY if names & COMMENT_NAMES else max(0, around - 1)
    elif name not in ("html", "body"):
        if (name in AROUND and not (name == "header" and inside)) or role in AROUND_ROLES or names & AROUND_NAMES:
            around = max(around, SURELY)
        elif name in UNSURE or role in (UNSURE_ROLES - OWN_ROLES if inside else UNSURE_ROLES):
            around = max(around, MAYBE)
        elif (names - OWN_NAMES if inside else names) & UNSURE_NAMES:
            around = max(around, MAYBE)
        main |= NAMED if words & MAIN_WORDS else 0
    if "hidden" in found or "display:none" in style:
        around = HIDES
    path = parent.path if inline else digest(parent.path, name, " ".join(sorted(label.split())))
    return _Element(name, inline, path, around, main)


class _Tags:
    """The tags of a page one after the other, in time proportional to its length."""

    def __init__(self, source: str) -> None:
        self.source, self.last = source, source.rfind(">")
        self.quotes_left = OPEN_QUOTES

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, name (empty for comments and the like), whether it is an end tag, and what follows the name."""
        source = self.source
        while (start := source.find("<", at)) >= 0:
            for opening, closing in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                if source.startswith(opening, start):
                    end = source.find(closing, start + len(opening))
                    return start, len(source) if end < 0 else end + 3, "", False, ""
            at = start + 1
            if start > self.last:
                # No tag ends behind here; a comment may still begin.
                start = min((x for x in (source.find("<!--", at), source.find("<![CDATA[", at)) if x >= 0), default=-1)
                if start < 0:
                    return None
                at = start
                continue
            if source.startswith(("<!", "<?"), start):
                return start, source.index(">", at) + 1, "", False, ""
            named = _NAME.match(source, start)
            if named:
                end = self._end(named.end())
                return start, end + 1, named[1], source[at] == "/", source[named.end() : end]
        return None

    def _end(self, at: int) -> int:
        """Where a tag ends: behind its quoted values, or at the first sign that may be it if a quote stays open."""
        source, place = self.source, at
        if self.quotes_left and source[at].isspace():
            while stop := _STOP.search(source, place):
                if stop[0] == ">":
                    return stop.start()
                place = source.find(stop[0], stop.end()) + 1
                if not place:
                    break
            self.quotes_left -= 1
        return source.index(">", at)


class _Stack(list):
    """The open elements, with the place of the innermost one of each name and of the innermost block."""

    def __init__(self, root: _Element) -> None:
        super().__init__([root])
        self.places: dict[str, list[int]] = {}
        self.block_places = [0]

    def push(self, element: _Element) -> None:
        self.places.setdefault(element.name, []).append(len(self))
        self.block_places.append(self.block_places[-1] if element.inline else len(self))
        self.append(element)

    def cut(self, index: int) -> None:
        while len(self) > index:
            self.places[self.pop().name].pop()
            self.block_places.pop()

    def innermost(self, *names: str) -> int:
        """The place of the innermost element with one of the names; 0 for none."""
        return max((found[-1] for name in names if (found := self.places.get(name))), default=0)

    def closed_by(self, name: str) -> int:
        """From where on the start of a block element closes what is open; 0 for nothing."""
        bounds = CLOSED_WITHIN.get(name)
        if bounds and (index := self.innermost(name)) > self.innermost(*bounds):
            return index
        return self.block_places[-1] if self[self.block_places[-1]].name == "p" else 0


def read(source: str) -> tuple[list[Block], list[tuple[int, int]]]:
    """The blocks of a page in order, and path and parent's path of each element that isn't inline."""
    stack = _Stack(_Element("", False, digest("page"), 0, 0))
    blocks: list[Block] = []
    paths = [(stack[0].path, 0)]
    buffer: list[str] = []
    tags, at, size = _Tags(source), 0, len(source)

    def flush() -> None:
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                top = stack[-1]
                blocks.append(Block(text, top.path, top.around, top.main))
            buffer.clear()

    def cut(index: int) -> None:
        flush()
        stack.cut(index)

    def add(text: str) -> None:
        top = stack[-1]
        if text and not (top.inline and top.around > max(MAYBE, stack[stack.block_places[-1]].around)):
            buffer.append(html.unescape(text) if "&" in text else text)

    while at < size:
        found = tags.next(at)
        if found is None:
            add(source[at:])
            break
        start, end, name, closing, rest = found
        add(source[at:start])
        at, name = end, name.lower()
        if not name:
            continue
        if closing:
            index = stack.innermost(name)
            if not index:
                continue
            if name not in INLINE:
                cut(index)
            elif index > stack.block_places[-1]:
                stack.cut(index)
        elif name == "br" or name == "hr":
            buffer.append(" ")
        elif name in VOID:
            continue
        elif name in HIDDEN:
            end = re.compile(rf"</{name}\s*>", re.I).search(source, at)
            at = end.end() if end else size
        else:
            if name not in INLINE:
                flush()
                cut_at = stack.closed_by(name)
                if cut_at:
                    cut(cut_at)
            element, parent = _opened(name, rest, stack[-1]), stack[-1].path
            if not rest.endswith("/") or name in INLINE:
                stack.push(element)
                if not element.inline:
                    paths.append((element.path, parent))
    flush()
    return blocks, paths


def main_text(blocks: list[Block], constant: frozenset[int] | set[int] = frozenset()) -> str:
    """The main text: the slots of the main element, without what is around it.

    Slots are the blocks whose tokens are not constant on the host. The main element is the
    surest kind that holds at least half of their text; without one it is the whole page. A
    main element with constant texts only (as on near copies of one page) keeps them. What only
    may be around comes back on a page whose main element has no slots, if it is longer than the
    rest: then its name was one of the layout.
    """
    inside = [block for block in blocks if block.around < SURELY]
    left = [block for block in inside if block.token not in constant]
    inside = [block for block in inside if not block.around]
    slots = [block for block in left if not block.around]
    if not any(block.main & (ARTICLE | MAIN) for block in slots):
        size = sum(len(block.text) for block in slots)
        if sum(len(block.text) for block in left) > 2 * size:
            slots = left
    if not slots:
        slots = [block for block in inside if block.main & (ARTICLE | MAIN)]
    whole = sum(len(block.text) for block in slots)
    for kind in (ARTICLE, MAIN, NAMED):
        held = [block for block in slots if block.main & kind]
        if held and 2 * sum(len(block.text) for block in held) >= whole:
            slots = held
            break
    return " ".join(block.text for block in slots)
