"""Main text of web pages: boosted trees over DOM nodes, decoded as a tree.

Every block element of a page gets features of its subtree (text and link
density, tags, words of its class and id, depth, place among its siblings), and
gradient-boosted trees give the log-odds that it holds main text. Decoding picks
the set of nodes with the largest total log-odds in which the parent of each
picked node is picked too, so no choice contradicts an ancestor's. The text of
a page is the picked nodes' own text, block by block.

The trees are fitted on labelled layouts: PAGES pages that a fixed rule draws
(articles in many kinds of containers among menus, headers, footers, sidebars,
notices, adverts, forms and reader comments, well-formed or not). That is a
bounded training sample; the pages to extract from never enter it.

Edge cases: null html is empty; a page without main text gives the empty string.
Repeated rows are extracted one by one. Elements that are never shown as text
(scripts, styles, titles, form controls) are left out whatever the trees say.
Other columns than page_id, url and html are not read.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.boosting import Trees
from panelscope.llm.dom import INLINE, Node, parse

PAGES = 700
BATCH_CHARS = 1 << 20

# Elements without text of their own, and words that class and id names use.
NEVER = frozenset("head script style title meta link template noscript textarea select option button input iframe svg object audio video canvas map".split())
TAGS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "ul", "ol", "li", "table", "td", "blockquote", "pre", "figure", "figcaption", "dl", "body", "html")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TOKENS = (
    ("ad", "ads", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion", "banner", "dfp"),
    ("cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "warning", "message"),
    ("nav", "navigation", "navbar", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "tabs", "skip"),
    ("sidebar", "side", "aside", "widget", "related", "recommended", "popular", "teaser", "trending", "complementary", "rail"),
    ("comment", "comments", "reply", "replies", "respond", "disqus", "discussion", "feedback", "reviews", "commentlist"),
    ("footer", "foot", "copyright", "legal", "bottom", "colophon", "contentinfo", "imprint"),
    ("header", "masthead", "top", "logo", "brand", "branding", "tagline", "topbar", "hero"),
    ("share", "social", "follow", "subscribe", "newsletter", "signup", "login", "search", "form", "register", "contact"),
    ("article", "content", "post", "entry", "story", "body", "text", "main", "page", "single", "blog", "news", "articlebody", "hentry"),
)
_SETS = [frozenset(t) for t in TOKENS]
_WORD = re.compile(r"[a-z]+")
MARK = "\ue000"  # private use, before each word of main text in labelled pages


class Block:
    """A block element: own text segments, child blocks in page order, and subtree sums."""

    __slots__ = ("attributes", "blocks", "chars", "hidden", "items", "links", "main", "marks", "parent", "tag", "words")

    def __init__(self, tag: str, attributes: str, parent: Block | None, hidden: bool):
        self.tag, self.attributes, self.parent, self.hidden = tag, attributes, parent, hidden
        self.items: list[str | Block] = []
        self.chars = self.links = self.words = self.marks = self.blocks = 0
        self.main = False


def blocks(root: Node) -> list[Block]:
    """Blocks of a page, parents before children; the sums of a block count its whole subtree."""
    top = Block("#root", "", None, False)
    found, pieces = [top], []

    def flush(block: Block) -> None:
        if pieces:
            words = "".join(p for p, _ in pieces).split()
            if words:
                block.items.append(" ".join(words))
            pieces.clear()

    # Each step is a node with its block and whether it is in a link; None ends a block.
    stack: list[tuple] = [(root, top, False, 0)]
    while stack:
        node, block, linked, state = stack.pop()
        if state == 1:
            flush(node)
            continue
        if isinstance(node, str):
            pieces.append((node, linked))
            if linked:
                block.links += len(node.strip())
            continue
        if node.tag in NEVER:
            continue
        if node.tag == "br":
            pieces.append((" ", False))
            continue
        inside = block
        if node.tag not in INLINE and node is not root:
            flush(block)
            inside = Block(node.tag, node.attributes, block, node.hidden)
            block.items.append(inside)
            found.append(inside)
            stack.append((inside, None, False, 1))
        linked = linked or node.tag == "a"
        stack += [(child, inside, linked, 0) for child in reversed(node.children)]
    flush(top)
    for block in reversed(found):
        for item in block.items:
            if isinstance(item, str):
                block.main |= MARK in item
                text = item.replace(MARK, "")
                block.chars += len(text)
                block.words += text.count(" ") + 1
                block.marks += sum(map(text.count, ".,;!?"))
                block.blocks += 1
            else:
                block.main |= item.main
                block.chars += item.chars
                block.links += item.links
                block.words += item.words
                block.marks += item.marks
                block.blocks += item.blocks
    return found


def features(found: list[Block]) -> list[list[float]]:
    """A row for each block."""
    depth, above, place = {}, {}, {}
    total = max(found[0].chars, 1)
    rows = []
    for block in found:
        up = block.parent
        depth[block] = depth[up] + 1 if up else 0
        words = set(_WORD.findall(block.attributes))
        tokens = [float(bool(words & s)) for s in _SETS]
        above[block] = [max(a, b) for a, b in zip(tokens[:8], above[up], strict=True)] if up else tokens[:8]
        kin = [i for i in up.items if not isinstance(i, str)] if up and up not in place else None
        if kin is not None:
            place[up] = {k: n for n, k in enumerate(kin)}
        index = place[up][block] if up else 0
        siblings = len(place[up]) if up else 1
        own = sum(len(i) for i in block.items if isinstance(i, str))
        parent_chars = max(up.chars, 1) if up else total
        rows.append(
            [
                *(float(block.tag == t) for t in TAGS), float(block.tag in HEADINGS), float(block.hidden), *tokens, *above[block][:8],
                math.log1p(block.chars), math.log1p(own), block.links / max(block.chars, 1), block.words / max(block.blocks, 1),
                block.marks / max(block.words, 1), block.chars / total, block.chars / parent_chars, block.blocks, depth[block], index, siblings,
                index / max(siblings, 1), up.links / max(up.chars, 1) if up else 0.0, float(bool(up) and up.tag in ("nav", "header", "footer", "aside", "form")),
                float(bool(up) and up.tag in ("article", "main")), float(sum(1 for i in block.items if not isinstance(i, str))),
            ]
        )
    return rows


def picked(found: list[Block], odds: np.ndarray) -> set[int]:
    """Indices of the blocks of the best subtree that contains the root: a block is worth its log-odds and its best children's."""
    number = {block: k for k, block in enumerate(found)}
    worth = odds.astype(float).copy()
    for k in range(len(found) - 1, 0, -1):
        if worth[k] > 0:
            worth[number[found[k].parent]] += worth[k]
    keep = {0}
    for k in range(1, len(found)):
        if worth[k] > 0 and number[found[k].parent] in keep:
            keep.add(k)
    return keep


def text_of(found: list[Block], keep: set[int]) -> str:
    chosen = {id(found[k]) for k in keep}
    out, stack = [], [found[0]]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif id(item) in chosen:
            stack += reversed(item.items)
    return " ".join(out)


def layouts(n: int, seed: int = 7) -> Iterator[str]:
    """Labelled pages: each word of main text starts with MARK."""
    rng = np.random.default_rng(seed)
    syllables = "an ba co de el fi go hu in ja ke lo mi no or pa qu re sa ti un ve wo xi ya zu é ß ñ ü".split()

    def pick(*options):
        return options[int(rng.integers(len(options)))]

    def chance(p: float) -> bool:
        return rng.random() < p

    def text(lo: int, hi: int, main: bool = False, stops: float = 0.1) -> str:
        size = int(rng.integers(lo, hi + 1))
        words = ["".join(syllables[k] for k in rng.integers(0, len(syllables), rng.integers(1, 5))) for _ in range(size)]
        return " ".join((MARK if main else "") + w + (pick(".", ",", "") if chance(stops) else "") for w in words) + pick(".", ".", "")

    def tag(name: str, names: str, inner: str) -> str:
        given = f' {pick("class", "class", "id")}="{names}"' if names else ""
        return f"<{name}{given}>{inner}</{name}>"

    def links(lo: int, hi: int) -> str:
        return "".join(f'<li><a href="/{k}">{text(1, 3, stops=0)}</a></li>' for k in range(int(rng.integers(lo, hi + 1))))

    def paragraph(main: bool, lo: int = 4, hi: int = 90) -> str:
        inner = text(lo, hi, main)
        if chance(0.2):
            inner += f' <a href="/x">{text(1, 4, main)}</a> ' + text(2, 20, main)
        if chance(0.2):
            inner = f"<b>{inner}" + pick("</b>", "<br>")
        return f"<p>{inner}" + pick("</p>", "</p>", "</p>", "")

    def advert() -> str:
        return tag(pick("div", "div", "aside", "p", "section"), pick("ad", "ads", "ad-slot", "advert", "banner", "sponsored", "promo-box"), pick(text(2, 25), paragraph(False, 3, 25)))

    def notice() -> str:
        return tag(pick("div", "div", "section", "p"), pick("cookie-notice", "cookie", "notice", "alert", "consent-banner", "gdpr", "popup"), text(5, 40) + pick("", "<button>ok</button>", f'<a href="#">{text(1, 2)}</a>'))

    def menu() -> str:
        inner = f"<ul>{links(3, 9)}</ul>"
        return pick(f"<nav>{inner}</nav>", f"<nav>{inner}</nav>", tag("div", pick("menu", "nav", "navbar", "breadcrumbs"), inner), tag("ul", "menu", links(3, 9)))

    def header() -> str:
        inner = pick("", f"<h1>{text(1, 4)}</h1>", f"<h2>{text(1, 4)}</h2>") + pick("", f"<p>{text(3, 12)}</p>", text(2, 10)) + (menu() if chance(0.4) else "")
        return pick(f"<header>{inner}{text(1, 6)}</header>", tag("div", pick("header", "masthead", "topbar"), inner + text(1, 5)))

    def footer() -> str:
        inner = "&copy; " + text(2, 25) + pick("", f"<p>{text(4, 30)}</p>", f"<ul>{links(2, 5)}</ul>")
        return pick(f"<footer>{inner}</footer>", f"<footer>{inner}</footer>", tag("div", pick("footer", "site-footer", "copyright"), inner))

    def sidebar() -> str:
        inner = "".join(pick(f"<h3>{text(1, 4)}</h3><ul>{links(2, 6)}</ul>", f"<h3>{text(1, 4)}</h3>{paragraph(False, 5, 40)}", paragraph(False, 5, 50)) for _ in range(int(rng.integers(1, 4))))
        return pick(f"<aside>{inner}</aside>", f"<aside>{inner}</aside>", tag("div", pick("sidebar", "side", "widget", "related-posts", "recommended"), inner))

    def form() -> str:
        inner = pick(f"<label>{text(1, 3)}</label><input>", f"<p>{text(3, 20)}</p><input>", text(2, 10)) + "<button>go</button>"
        return pick(f"<form>{inner}</form>", tag("form", pick("newsletter", "search", "contact-form", "login"), inner), tag("div", pick("newsletter", "subscribe", "signup"), f"<form>{inner}</form>"))

    def comments() -> str:
        one = pick("div", "li", "article")
        each = "".join(tag(one, pick("comment", "comment", "reply", ""), f"<b>{text(1, 2)}</b> " + pick(paragraph(False, 4, 60), text(4, 50))) for _ in range(int(rng.integers(1, 6))))
        title = pick("", f"<h2>{text(1, 2)}</h2>", f"<h3>{text(1, 3)}</h3>")
        return tag(pick("section", "div", "div", "ol"), pick("comments", "comment-list", "comments-area", "discussion", "disqus"), title + each + (form() if chance(0.3) else ""))

    def share() -> str:
        return tag(pick("ul", "div"), pick("share", "social", "share-buttons"), links(2, 4))

    def main_part() -> str:
        kind = rng.random()
        if kind < 0.72:
            return paragraph(True, 1 if chance(0.15) else 5, 120)
        if kind < 0.8:
            return f"<{pick('h2', 'h3')}>{text(1, 7, True, 0)}</{pick('h2', 'h3')}>"
        if kind < 0.86:
            name = pick("ul", "ol")
            return f"<{name}>" + "".join(f"<li>{text(2, 20, True)}</li>" for _ in range(int(rng.integers(2, 6)))) + f"</{name}>"
        if kind < 0.9:
            return f"<blockquote>{paragraph(True, 5, 40)}</blockquote>"
        if kind < 0.93:
            return "<table>" + "".join(f"<tr><td>{text(1, 5, True)}</td><td>{text(1, 5, True)}</td></tr>" for _ in range(3)) + "</table>"
        if kind < 0.95:
            return f"<pre>{text(5, 30, True)}</pre>"
        if kind < 0.97:
            return f"<div>{text(5, 60, True)}</div>"
        return f"<section>{paragraph(True, 5, 80)}{paragraph(True, 5, 80)}</section>"

    def inner_noise() -> str:
        return pick(advert, advert, sidebar, share, form, notice)()

    def article() -> str:
        parts = [f"<h1>{text(1, 10, True, 0)}</h1>"] if chance(0.8) else []
        for _ in range(int(rng.integers(1, 4) if chance(0.3) else rng.integers(2, 14))):
            parts.append(main_part())
            if chance(0.08):
                parts.append(inner_noise())
        if chance(0.15):
            parts.append(comments())
        inner = "".join(parts)
        if chance(0.3):
            inner = tag("div", pick("", "content", "entry-content", "article-body", "text", "post-body"), inner)
        name = pick("article", "article", "article", "main", "div", "div", "section")
        out = tag(name, pick("", "", "post", "story", "content", "entry", "main", "article") if name != "div" else pick("article", "content", "post", "entry", "story", "main-content", "text", ""), inner)
        if chance(0.25):
            out = f"<main>{out}{advert() if chance(0.2) else ''}</main>"
        return out

    for _ in range(n):
        before = [part() for part, p in ((notice, 0.3), (header, 0.5), (menu, 0.8), (advert, 0.5), (form, 0.15), (sidebar, 0.2)) if chance(p)]
        after = [part() for part, p in ((share, 0.2), (comments, 0.45), (sidebar, 0.4), (advert, 0.3), (form, 0.25), (notice, 0.15), (footer, 0.85)) if chance(p)]
        if chance(0.3):  # any part at any place
            parts = before + after
            rng.shuffle(parts)
            cut = int(rng.integers(0, len(parts) + 1))
            before, after = parts[:cut], parts[cut:]
        inner = "".join([*before, article(), *after])
        if chance(0.25):
            inner = tag("div", pick("wrapper", "container", "page", ""), inner)
        yield f"<!DOCTYPE html><html><head><title>{text(2, 8)}</title><script>var a='</p>';</script></head><body>{inner}" + pick("</body></html>", "")


@functools.lru_cache(maxsize=1)
def model() -> Trees:
    x, y = [], []
    for page in layouts(PAGES):
        found = blocks(parse(page))
        x += features(found)
        y += [float(b.main) for b in found]
    return Trees(np.array(x), np.array(y), rounds=60)


def extracted(pages: list[str], trees: Trees) -> list[str]:
    found = [blocks(parse(p)) for p in pages]
    rows = [r for f in found for r in features(f)]
    odds = trees.log_odds(np.array(rows)) if rows else np.zeros(0)
    out, at = [], 0
    for f in found:
        out.append(text_of(f, picked(f, odds[at : at + len(f)])))
        at += len(f)
    return out


def extractor(trees: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, lo = batch.column(2), 0
            while lo < batch.num_rows:
                hi, size, part = lo, 0, []
                while hi < batch.num_rows and size < BATCH_CHARS:
                    part.append(pages[hi].as_py() or "")
                    size += len(part[-1])
                    hi += 1
                texts = extracted(part, trees)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in (0, 1)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"],
                )
                lo = hi

    return run


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages` (page_id, url, html)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html")
    return rows.mapInArrow(extractor(model()), "page_id long, url string, text string, n_chars long")
