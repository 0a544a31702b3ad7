"""Pages as blocks of text below a path of elements: a tolerant reading of HTML, errors and all."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# HTML elements by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg math title textarea noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr nobr center".split()
)
#: Elements whose start ends an open paragraph, and which elements end by a new one of their kind.
NO_PARAGRAPH = frozenset(
    "address article aside blockquote details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul li dt dd".split()
)
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
}
SCOPES = frozenset("ul ol dl table html body article section div td th main".split())
# Elements, roles and words of class or id that mark what is not the article.
NOT_TEXT = frozenset("nav footer aside form button select dialog menu script style".split())
NOT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
NOT_WORDS = frozenset(
    "ad ads adbox adslot adunit banner nav navbar navigation menu footer sidebar cookie cookies consent gdpr notice "
    "comment comments reply replies respond disqus share sharing social related recommended promo promotion "
    "newsletter subscribe subscription breadcrumb breadcrumbs popup modal overlay login signup search pagination "
    "pager sponsor sponsored sponsors widget toolbar skip disclaimer masthead topbar".split()
)
NOT_STARTS = ("advert", "comment", "cookie", "sidebar", "breadcrumb", "newsletter", "sponsor")
MAIN_TAGS = frozenset(("article", "main"))

TAG = re.compile(
    r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]{0,9999}\"|'[^']{0,9999}')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>"
)
ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|itemprop)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    """An open or closed element: its path, and whether it marks text outside of the article."""

    tag: str
    path: str
    parent: Element | None
    outside: bool = False
    by_words: bool = False
    within_main: bool = False

    def is_outside(self) -> bool:
        at = self
        while at is not None:
            if at.outside or at.by_words:
                return True
            at = at.parent
        return False


@dataclass
class Block:
    element: Element
    text: str
    linked: int


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), a or b or c)
    return found


def _element(tag: str, source: str, parent: Element | None) -> Element:
    """An element with its class and id in its path, digits left out, and its marks read."""
    given = _attributes(source) if source and not source.isspace() else {}
    names = f"{given.get('class', '')} {given.get('id', '')}".split()
    label = tag + "".join("." + re.sub(r"\d+", "", n) for n in names)
    outer = parent.path if parent is not None else ""
    made = Element(tag, f"{outer}/{label}", parent, within_main=parent is not None and parent.within_main)
    if tag in MAIN_TAGS:
        made.within_main = True
        at = parent
        while at is not None:  # what holds the article is not left out for its name
            at.by_words = False
            at = at.parent
        return made
    if tag in ("html", "body"):
        return made
    made.outside = (
        tag in NOT_TEXT
        or (tag == "header" and not made.within_main)
        or given.get("role", "").lower() in NOT_ROLES
        or "hidden" in given
        or "display:none" in given.get("style", "").replace(" ", "").lower()
    )
    words = {w.lower() for n in names for w in WORD.findall(n)}
    made.by_words = bool(words & NOT_WORDS) or any(w.startswith(NOT_STARTS) for w in words)
    return made


def _squeezed(parts: list[str]) -> str:
    text = "".join(parts)
    if "&" in text:
        text = html.unescape(text)
    return " ".join(text.split())


def read_page(source: str) -> Page:
    """Blocks in page order, and all elements that hold blocks or may.

    Inline elements and ``br`` do not end a block (``br`` is white space). Unclosed elements end
    with what holds them, stray end tags are skipped, comments and raw elements hold no text. What
    is cut off ends the page.
    """
    page = Page()
    top = Element("", "", None)
    stack: list[Element] = [top]
    parts: list[str] = []
    linked: list[str] = []
    in_link = False
    at, end = 0, len(source)

    def flush():
        nonlocal parts, linked
        if parts:
            text = _squeezed(parts)
            if text:
                page.blocks.append(Block(stack[-1], text, len(_squeezed(linked)) if linked else 0))
            parts, linked = [], []

    def take(text):
        parts.append(text)
        if in_link:
            linked.append(text)

    def close(depth):
        flush()
        del stack[depth:]

    while at < end:
        start = source.find("<", at)
        if start < 0:
            take(source[at:])
            break
        if start > at:
            take(source[at:start])
        mark = source[start + 1 : start + 2]
        if mark == "!" or mark == "?":
            if source.startswith("<!--", start):
                stop = source.find("-->", start + 4)
                at = end if stop < 0 else stop + 3
            else:
                stop = source.find(">", start)
                at = end if stop < 0 else stop + 1
            continue
        found = TAG.match(source, start)
        if found is None:
            if mark == "/" or mark.isalpha():  # a tag that the page's end cuts off
                break
            take("<")
            at = start + 1
            continue
        at = found.end()
        closing, tag, rest = (found.group(i) or found.group(i + 3) or "" for i in (1, 2, 3))
        tag = tag.lower()
        if tag in INLINE:
            if tag == "a":
                in_link = not closing
            continue
        if tag == "br":
            take("\n")
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    close(depth)
                    in_link = False
                    break
            continue
        if tag in RAW:
            if not rest.endswith("/"):
                stop = re.compile(f"</{tag}\\b[^>]*>", re.I).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in NO_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == "p":
                    close(depth)
                    break
                if stack[depth].tag in SCOPES:
                    break
        if tag in CLOSES:
            depth = len(stack) - 1
            while depth > 0 and stack[depth].tag not in SCOPES | CLOSES.keys():
                depth -= 1
            lowest = len(stack)
            while depth > 0 and stack[depth].tag in CLOSES[tag]:
                lowest = depth
                depth -= 1
            if lowest < len(stack):
                close(lowest)
        flush()
        in_link = False
        made = _element(tag, rest, stack[-1])
        page.elements.append(made)
        if not rest.endswith("/"):
            stack.append(made)
    flush()
    return page
