"""A small tolerant reader of web pages into a tree of nodes."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: Opening one of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Opening one of the keys ends an open element of the same list, up to the nearest of the second names.
ENDS_LIKE = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table tbody thead tfoot"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS_LIKE = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in ENDS_LIKE.items()}

#: As browsers read them: a quote opens a value only right after an equals sign; elsewhere it is a character like others, as is one that nothing closes.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>][^\s>]*)))?")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I) for name in RAW}


@dataclass
class Node:
    tag: str
    attributes: str = ""  # class, id, role and such names, lower-cased
    parent: Node | None = None
    children: list = field(default_factory=list)  # nodes and texts, in page order
    hidden: bool = False


def _names(raw: str) -> tuple[str, bool]:
    """Words that class, id, role and the like give, and whether the element is hidden."""
    words, hidden = [], False
    for m in _ATTRIBUTE.finditer(raw):
        name = m[1].lower()
        value = html.unescape(m[2] or m[3] or m[4] or "").lower()
        if name in ("class", "id", "role", "itemprop", "aria-label", "itemtype"):
            words.append(value)
        hidden |= name == "hidden" or name == "style" and "display:none" in value.replace(" ", "") or name == "aria-hidden" and value == "true"
    return " ".join(words), hidden


def parse(page: str) -> Node:
    """Tree of a page; end tags without a start are skipped, open elements end with their parent."""
    root = here = Node("#root")
    at = 0
    opened: dict[str, int] = {}  # open elements by name, so that a stray end tag costs nothing

    def close() -> None:
        nonlocal here
        opened[here.tag] -= 1
        here = here.parent

    def text(part: str) -> None:
        if part:
            here.children.append(part)

    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            text(html.unescape(page[at:]))
            break
        text(html.unescape(page[at : m.start()]))
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            if opened.get(tag):
                while here.tag != tag:
                    close()
                close()
            continue
        if tag in ENDS_P and opened.get("p"):
            up = here
            while up.tag in INLINE:
                up = up.parent
            if up.tag == "p":
                while here.tag != "p":
                    close()
                close()
        elif tag in ENDS_LIKE:
            same, until = ENDS_LIKE[tag]
            up = here
            while up.parent and up.tag not in same and up.tag not in until:
                up = up.parent
            if up.tag in same:
                while here is not up:
                    close()
                if not (tag == "td" and up.tag == "tr"):
                    close()
        attributes, hidden = _names(m[3]) if m[3] else ("", False)
        node = Node(tag, attributes, here, hidden=hidden)
        here.children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in RAW:
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            node.children.append(page[at : end.start() if end else len(page)])
            at = end.end() if end else len(page)
            continue
        here = node
        opened[tag] = opened.get(tag, 0) + 1
    return root
