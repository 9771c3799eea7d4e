"""Blocks of text and block elements of an HTML page, as far as text extraction needs them."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

# Elements by what they do to text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option optgroup p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
#: Elements that never hold article text.
NEVER = frozenset(
    "aside audio button canvas datalist dialog footer head iframe map menu nav noembed noframes noscript object option "
    "optgroup script search select style svg template textarea title video".split()
)
#: Elements that hold none unless they hold the article as a whole.
SELDOM = frozenset(("form", "header"))
#: Elements that can be a region of a page.
REGIONS = frozenset("article body center div main section td".split())
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Words of class, id and role that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert alerts banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disclaimer disqus footer form gdpr header masthead menu menubar "
    "modal nav navbar navigation newsletter notice notices notification notifications overlay pager pagination popup "
    "promo promoted promotion related replies reply responses search share sharing sidebar sidenav signup skip social "
    "sponsor sponsored subscribe subscription tags teaser toolbar topbar widget".split()
)
#: A start tag of these ends an open element of those.
_ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"), "option": ("option",),
    "body": ("head",),
}
#: Where the search for an open element stops.
_SCOPES = frozenset("article aside body div footer form header main nav section table ul ol dl td th html".split())

_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)"""
    r"""((?:[^>"']++|"[^"]*"|'[^']*')*+(?:>|\Z)|[^>]*(?:>|\Z)))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?=[\s/>]))""", re.I)
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_NUMBER = re.compile(r"\d+")
_HELD = 20_000

OPEN, CLOSE, TEXT = 0, 1, 2


@dataclass
class Element:
    tag: str
    mark: int  # hash of the path of tags and names
    parent: int
    never: bool
    seldom: bool
    holds_article: bool = False


@dataclass
class Page:
    elements: list[Element] = field(default_factory=list)
    #: (OPEN | CLOSE, element, "") and (TEXT, element, text of a block), in page order.
    events: list[tuple[int, int, str]] = field(default_factory=list)

    def left_out(self) -> tuple[list[bool], list[bool]]:
        """By element: whether its own text is not article text, and whether it stands in an article or main element."""
        found: list[bool] = []
        in_article: list[bool] = []
        for e in self.elements:
            out = e.parent >= 0 and found[e.parent]
            inside = e.parent >= 0 and in_article[e.parent]
            if e.parent >= 0 and self.elements[e.parent].tag == "header" and inside and e.tag in HEADINGS:
                out = e.never
            found.append(out or e.never or (e.seldom and not e.holds_article))
            in_article.append(inside or e.tag in ("article", "main"))
        return found, in_article


_tags: dict[str, tuple[str, bool, bool, bool]] = {}
_marks: dict[tuple[int, str], int] = {}


def _start_tag(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """Key in paths, whether the element never or seldom holds article text, and whether its names matter."""
    raw = tag + attributes
    if (known := _tags.get(raw)) is not None:
        return known
    names, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes):
        value = html.unescape(value.strip("\"'"))
        name = name.lower()
        if name in ("class", "id", "role"):
            names.append((name, value))
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            hidden = True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
    key = tag + "".join(f" {n}={_NUMBER.sub('0', v)}" for n, v in sorted(names))
    main = tag in ("article", "main", "body", "html") or ("role", "main") in names
    named = any(word.lower() in NAMES for _, value in names for word in _WORD.findall(value))
    if tag == "article":  # a comment or teaser may be an article of its own; it has no h1
        found = (key, hidden, named, not named)
    else:
        found = (key, hidden or tag in NEVER, tag in SELDOM or (named and not main), main and tag not in ("body", "html"))
    if len(_tags) >= _HELD:
        _tags.clear()
    _tags[raw] = found
    return found


def _mark(parent: int, key: str) -> int:
    """61 bits."""
    if (known := _marks.get((parent, key))) is None:
        if len(_marks) >= _HELD:
            _marks.clear()
        known = _marks[parent, key] = xxhash.xxh64_intdigest(key, parent & 0xFFFFFFFF) ^ (parent * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        known = _marks[parent, key] = known >> 3
    return known


def read_page(text: str | None) -> Page:
    """The blocks of a page. White space in a block is one space; a block without text is left out."""
    text = text or ""
    page = Page()
    elements, events = page.elements, page.events
    stack: list[tuple[str, int, bool]] = []  # tag, block element it is or stands in, whether its text is dropped
    open_tags: dict[str, int] = {}
    pieces: list[str] = []
    here, dropped = -1, 0

    def flush() -> None:
        if pieces:
            words = " ".join("".join(pieces).split())
            pieces.clear()
            if words:
                events.append((TEXT, here, words))

    def pop() -> None:
        nonlocal here, dropped
        tag, element, drop = stack.pop()
        open_tags[tag] -= 1
        dropped -= drop
        if tag in BLOCKS:
            flush()
            events.append((CLOSE, element, ""))
            here = elements[element].parent

    def close(names: tuple[str, ...], scoped: bool) -> None:
        """Ends the innermost open element of these names; if `scoped`, only within the region around."""
        if not any(open_tags.get(name) for name in names):
            return
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in names:
                while len(stack) > k:
                    pop()
                return
            if scoped and stack[k][0] in _SCOPES:
                return

    at, size = 0, len(text)
    while at < size:
        found = _TAG.search(text, at)
        begin = found.start() if found else size
        if begin > at and not dropped:
            pieces.append(html.unescape(text[at:begin]))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag in BLOCKS:
                flush()
                close((tag,), False)
            elif open_tags.get(tag):
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        while len(stack) > k:
                            pop()
                        break
                    if stack[k][0] in BLOCKS:
                        break
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(text, at)
            at = end.end() if end else size
            continue
        if tag in ("br", "hr"):
            pieces.append(" ")
            if tag == "hr":
                flush()
            continue
        if tag in VOID:
            continue
        key, never, seldom, main = _start_tag(tag, found[3])
        if tag not in BLOCKS:
            if not found[3].endswith("/>"):
                drop = never or (seldom and tag != "a")
                stack.append((tag, here, drop))
                open_tags[tag] = open_tags.get(tag, 0) + 1
                dropped += drop
            continue
        flush()
        if ends := _ENDS.get(tag):
            for _ in range(3):
                close(ends, True)
        else:
            close(("p",), True)
        element = len(elements)
        parent = here
        elements.append(Element(tag, _mark(elements[parent].mark if parent >= 0 else 0, key), parent, never, seldom))
        if main or tag == "h1":
            above = parent
            while tag == "h1" and above >= 0 and elements[above].tag != "article":
                above = elements[above].parent
            while above >= 0 and not elements[above].holds_article:
                elements[above].holds_article = True
                above = elements[above].parent
        here = element
        stack.append((tag, element, False))
        open_tags[tag] = open_tags.get(tag, 0) + 1
        events.append((OPEN, element, ""))
    flush()
    while stack:
        pop()
    return page
