"""Main text of web pages by tag-path ratios.

A page is read once into blocks: the text between two block-level tags, with its root-to-leaf
tag path (block tags with their first class; inline tags are not part of it).

1. Blocks inside what never is article text are set aside: page furniture by tag (menus,
   headers, footers, sidebars, forms, scripts, styles …), by role, or by a word of the class
   or id (adverts, notices, comments, sharing …), and hidden elements.
2. Per tag path the remaining blocks' text length and punctuation are aggregated to the
   ratios characters per block and punctuation marks per block and to their spread.
3. The ratios are smoothed over the page order with a Gaussian window, so that short blocks
   between long ones gain and lonely ones lose, and fused into one value per block, damped by the
   share of link text; a path's value is the mean over its blocks.
4. Paths at or above ``SHARE`` of the page's length-weighted mean are content paths.
5. The content's root is the article element (or main, or a container that is named so)
   above most of the content paths' text; without one the lowest element that holds
   ``MOST`` of it. All blocks below a root of the first kind are the article, since an article
   may hold short lines, lists and headings of any statistics (below a named container list
   items that are links only are left out); below another root a block
   stays if its path is a content path, or if it is a heading or a line among them that is
   not mostly links.

Inside a block white space of any kind becomes one space; ``br`` is white space. Character references
are decoded, once and after the tags are found. Comments, declarations and tags without an
end go. An unclosed element ends where HTML ends it (``p``, ``li``, ``dd``, ``dt``, table
parts, ``option``) or with its parent.

Null and empty pages, and pages without article text, give an empty text. Pages of any length
are read whole, in linear time. Repeated rows are read alike; an empty table gives no rows. Nothing is
compared between pages, so there are no ties. Callers' columns may have any name.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statweave.llm.base import Renamed

SHARE, MOST = 0.25, 0.8
ARTICLE = 0.3  # article elements with less of the content paths' text are teasers
# HTML's element names by what they do to a block.
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "select summary table caption colgroup tbody td tfoot th thead tr ul button noscript object".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea iframe noembed noframes xmp svg template audio video canvas".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
FURNITURE = set("nav header footer aside form head menu select button noscript dialog fieldset search object dir".split())
FURNITURE_ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert alertdialog form".split())
# Words of classes and ids that name page furniture.
FURNITURE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense alert alerts aside banner breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies copyright disclaimer disqus feedback footer gdpr header hidden leaderboard login masthead "
    "menu menus modal nav navbar navigation newsletter notice notices notification notifications outbrain overlay pagination pager "
    "paywall popup privacy promo promoted promotion promotions recommended related replies reply respond share sharing sidebar "
    "signup skip social sponsor sponsored sponsors subscribe subscription taboola teaser teasers toolbar topbar widget widgets".split()
)
# Words that, beside one of the above, tell a container that merely has or lacks such a part.
LAYOUT_WORDS = set("with without has no layout".split())
# Words that also name the layout of a container around the whole page; an article or main element inside is not furniture for them.
SOFT_WORDS = set("header footer sidebar menu nav navbar navigation banner".split())
CONTENT_WORDS = set("article articlebody post entry story maincontent content body text main".split())
# A start tag that ends an open element of these kinds, up to the nearest of the limits.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
}
_NEVER_CLOSE_P = set("option optgroup button head html body object noscript".split())
_TAG = re.compile(
    r"""<(?:!--(?:.*?-->|.*\Z)|(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*+)(?P<rest>(?:=\s*+"[^"]*+"|=\s*+'[^']*+'|[^>])*+)(?:>|\Z)|[!?/][^>]*+(?:>|\Z))""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z_:][-A-Za-z0-9_:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_MARKS = re.compile(r"[.,;:!?…。、，！？；：]")


@dataclass(slots=True)
class Element:
    tag: str
    path: str
    parent: Element | None
    furniture: bool
    named: int  # 2: article element or body, 1: a container that is named so
    soft: bool = False  # furniture by a word of the layout only


@dataclass(slots=True)
class Block:
    text: str
    element: Element
    linked: int  # characters inside links


@dataclass(slots=True)
class Page:
    blocks: list[Block] = field(default_factory=list)


def _attributes(rest: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _judge(tag: str, rest: str, parent: Element) -> tuple[bool, int, str, bool]:
    """(furniture, how much the element is named as content, first class, furniture by a word of the layout only)."""
    if tag in ("html", "body"):
        return False, 0, "", False
    named = 2 if tag == "article" else 1 if tag == "main" else 0
    furniture = tag in FURNITURE
    if tag == "header" and _within(parent, 2):
        furniture = False  # an article's own header holds its headings; see ``_kept_header``
    if not rest.strip(" /\n\t"):
        return furniture, named, "", False
    known = _attributes(rest)
    label = known.get("class", "")
    if "hidden" in known or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", known.get("style", "")):
        return True, 0, label, False
    role = known.get("role", "").lower()
    if role in FURNITURE_ROLES or known.get("aria-hidden", "").lower() == "true":
        furniture = True
    words = {w.lower() for w in _WORDS.findall(f"{label} {known.get('id', '')}")}
    if role in ("main", "article") or "articlebody" in known.get("itemprop", "").lower():
        named = max(named, 2 if role != "main" else 1)
    elif not named and tag in ("div", "section", "td") and words & CONTENT_WORDS:
        named = 1
    hard = furniture
    if words & FURNITURE_WORDS and not words & LAYOUT_WORDS and tag != "main":
        own_header = words & FURNITURE_WORDS == {"header"} and (tag in HEADINGS or bool(words & CONTENT_WORDS))
        furniture = furniture or not own_header
    soft = furniture and not hard and words & FURNITURE_WORDS <= SOFT_WORDS
    return furniture, named if not furniture else 0, (label.split() or [""])[0], soft


def _within(element: Element | None, named: int) -> bool:
    while element is not None:
        if element.named >= named:
            return True
        element = element.parent
    return False


def _kept_header(element: Element) -> bool:
    """False for what an article's own header holds beside headings."""
    heading = False
    while element is not None:
        heading = heading or element.tag in HEADINGS
        if element.tag == "header":
            return heading
        element = element.parent
    return True


def read_page(source: str) -> Page:
    """Blocks in page order, those inside page furniture left out."""
    page, top = Page(), Element("", "", None, False, 0)
    stack, pieces, linked, links, at = [top], [], 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            element = stack[-1]
            if text and not element.furniture and _kept_header(element):
                page.blocks.append(Block(text, element, linked))
            pieces.clear()
        linked = 0

    def add(text: str) -> None:
        nonlocal linked
        if stack[-1].furniture:
            return
        text = html.unescape(text) if "&" in text else text
        pieces.append(text)
        if links:
            linked += len(text.strip())

    def pop_to(place: int) -> None:
        nonlocal links
        flush()
        links = 0  # a link that is still open here was never closed
        del stack[place:]

    while True:
        tag = _TAG.search(source, at)
        if tag is None:
            add(source[at:])
            break
        if tag.start() > at:
            add(source[at : tag.start()])
        at = tag.end()
        if tag["name"] is None:
            continue
        name = tag["name"].lower()
        if tag["end"]:
            if name == "a":
                links = max(0, links - 1)
            elif name in BLOCK:
                place = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0)
                if place:
                    pop_to(place)
                elif name == "p":
                    flush()
            continue
        if not source.endswith(">", 0, at) and at == len(source):
            break  # a tag without its end
        if name in RAW:
            if not tag["rest"].endswith("/") or name != "svg":
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name == "a":
            links += 1
            continue
        if name not in BLOCK:
            continue
        flush()
        if name != "head" and stack[-1].tag == "head":
            stack.pop()
        if name in _CLOSES:
            ends, limits = _CLOSES[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in limits:
                    break
                if stack[i].tag in ends:
                    outer = i
                    while outer > 1 and stack[outer - 1].tag in ends:
                        outer -= 1
                    del stack[outer:]
                    break
        elif name not in _NEVER_CLOSE_P and stack[-1].tag == "p":
            stack.pop()
        elif name in HEADINGS and stack[-1].tag in HEADINGS:
            stack.pop()
        if name in VOID:
            continue
        parent = stack[-1]
        furniture, named, label, soft = _judge(name, tag["rest"], parent)
        path = f"{parent.path}/{name}.{label}" if label else f"{parent.path}/{name}"
        if parent.furniture and not (parent.soft and name in ("article", "main")):
            furniture, soft = True, parent.soft and (soft or not furniture)
        stack.append(Element(name, path, parent, furniture, named, soft))
    flush()
    return page


def content_paths(blocks: list[Block]) -> dict[str, float]:
    """Value of each tag path relative to the page's mean: smoothed, fused text and punctuation ratios."""
    names: dict[str, int] = {}
    path = np.array([names.setdefault(b.element.path, len(names)) for b in blocks])
    length = np.array([len(b.text) for b in blocks], float)
    marks = np.array([len(_MARKS.findall(b.text)) for b in blocks], float)
    free = 1 - np.minimum(np.array([b.linked for b in blocks]) / length, 1)
    many = np.bincount(path)
    spread = lambda x: np.sqrt(np.maximum(np.bincount(path, x * x) / many - (np.bincount(path, x) / many) ** 2, 0))
    ratios = [
        (np.bincount(path, length) / many)[path] + spread(length)[path],
        (np.bincount(path, marks) / many)[path] + spread(marks)[path],
    ]
    kernel = np.exp(-0.5 * np.arange(-2, 3) ** 2)
    weight = np.convolve(np.ones(len(blocks)), kernel, "same") if len(blocks) >= 5 else np.ones(len(blocks))
    if len(blocks) >= 5:
        ratios = [np.convolve(r, kernel, "same") / weight for r in ratios]
    fused = np.sqrt(ratios[0] * (1 + ratios[1])) * free
    mean = float((fused * length).sum() / length.sum()) or 1.0
    value = np.bincount(path, fused) / many / mean
    return {name: float(value[i]) for name, i in names.items()}


def main_blocks(page: Page, share: float = SHARE, most: float = MOST) -> list[Block]:
    """The blocks of the article, in page order."""
    blocks = page.blocks
    if not blocks:
        return []
    values = content_paths(blocks)
    chosen = [values[b.element.path] >= share for b in blocks]
    held: dict[int, float] = {}
    elements: dict[int, Element] = {}
    for block, content in zip(blocks, chosen):
        element = block.element
        while element is not None:
            elements[id(element)] = element
            held[id(element)] = held.get(id(element), 0.0) + len(block.text) * content
            element = element.parent
    total = held[id(next(e for e in elements.values() if e.parent is None))]
    articles: dict[str, list[Element]] = {}
    for element in elements.values():
        if element.named == 2 and not _within(element.parent, 2):
            articles.setdefault(element.path, []).append(element)
    share_of = lambda own: sum(held[id(e)] for e in own)
    best = max(articles.values(), key=share_of, default=[])
    if best and share_of(best) >= ARTICLE * total:
        same = {id(e) for e in best}
        return [b for b in blocks if _below(b.element, same)]
    named = [e for e in elements.values() if e.named == 1 and total and held[id(e)] >= most * total]
    if named:
        root = max(named, key=lambda e: e.path.count("/"))  # the innermost
        return [b for b in blocks if _below(b.element, {id(root)}) and not (b.element.tag == "li" and 5 * b.linked > 4 * len(b.text))]
    if not total:
        return []
    enough = [e for e in elements.values() if held[id(e)] >= most * total]
    root = {id(max(enough, key=lambda e: e.path.count("/")))}
    inside = [i for i, b in enumerate(blocks) if _below(b.element, root)]
    content = [i for i in inside if chosen[i]]
    return [
        blocks[i]
        for i in inside
        if chosen[i]
        or ((blocks[i].element.tag in HEADINGS or content[0] < i < content[-1]) and 2 * blocks[i].linked < len(blocks[i].text))
    ]


def _below(element: Element | None, roots: set[int]) -> bool:
    while element is not None:
        if id(element) in roots:
            return True
        element = element.parent
    return False


def main_text(source: str | None) -> str:
    return "\n\n".join(b.text for b in main_blocks(read_page(source))) if source else ""


def extracted(pages: DataFrame, column: str = "html", result: str = "text") -> DataFrame:
    """``pages`` without ``column``, with ``result``: the page's main text."""
    own = Renamed(pages)
    others = [c for c in own.safe if c != own.name(column)]
    schema = own.df.select(*others, F.lit("").alias("_main")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(v) for v in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[f.name for f in schema])

    found = own.df.select(*others, F.col(own.name(column)).cast("string").alias("_html")).mapInArrow(run, schema)
    return found.toDF(*[n for n in pages.columns if n != column], result)
