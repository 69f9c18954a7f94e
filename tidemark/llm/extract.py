"""Main text of web pages by tag-path ratios.

A page becomes a list of text blocks, each with its path of block tags from the root. For each
path the length of its text (without links), its punctuation and the number of its blocks are
summed over the page. Text per block is the ratio of the path, punctuation per block another;
both are smoothed over the blocks in page order and fused by their product. Paths above a part
of the page's mean make the content. The smallest element that holds nearly all of it is the
article; it is never less than the article or main element around it, and grows while content
stands right beside it. The result is all content, and the blocks in the article whose path is not
mostly links, such as headings and short items.

What is boilerplate by its markup (navigation, footers, asides, forms, scripts) never gets a path.
Names are weighed. A class, id or role that names an advert, a notice, comments and the like as a
whole, such as ``cookie-banner``, takes its element out, but never an element around the article:
one that holds the main element, or most of the page's unlinked text. A name that such a word is
only a part of, such as ``has-sidebar`` or ``related-work``, lowers the scores of its path outside
of an article, and no more. Inside the article headings stay though they are linked, and in an
article element lists of links do. Character references are
decoded, white space inside a block becomes one space, blocks are joined by one space.

Cases. Null, empty or text-free html: empty text. Tags that are not closed, or closed without
being open: repaired as browsers do for paragraphs, lists and tables, else ignored. Very long
pages: whole, in time that grows with length times depth of nesting. Repeated rows: each is extracted. Ties between
elements: the innermost. Extra columns: ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table

#: Part of the mean fused ratio that a path must reach, part of the content in the article.
THRESHOLD, COVER = 0.25, 0.85
LINK_SHARE = 0.6

# Elements of HTML by what they do to text.
RAW = {"script", "style", "textarea", "title", "iframe", "noframes", "noembed", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark",
    "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
SKIPPED = {
    "nav", "footer", "aside", "form", "noscript", "template", "button", "select", "svg", "math", "object", "audio", "video", "canvas",
    "menu", "dialog", "head", "applet", "map", "datalist", "fieldset",
}
#: A tag closes an open one of these, if no element of the second set stands between.
CLOSES = {
    "p": ({"p"}, {"article", "section", "div", "td", "th", "li", "body", "blockquote", "main", "button", "table"}),
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
CLOSE_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hr", "main", "nav", "ol", "pre", "section", "table", "ul",
}
#: Words in class, id or role that name what is not the article.
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "adslot", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "notification", "alert", "popup", "modal", "overlay", "comment", "comments", "commentlist", "disqus", "respond", "replies",
    "reply", "sidebar", "rail", "menu", "navbar", "nav", "navigation", "breadcrumb", "breadcrumbs", "footer", "copyright", "share", "sharing", "social",
    "related", "recommended", "newsletter", "subscribe", "subscription", "signup", "login", "widget", "toolbar", "pagination", "pager", "search",
    "masthead", "topbar", "contentinfo", "complementary", "dialog", "form", "skip", "hidden", "tags",
}
#: These name page furniture only outside of the article.
OUTER_NAMES = {"header", "heading"}
#: Words that say where such a thing stands or what it is made of, not what it is.
NEUTRAL = {
    "left", "right", "top", "bottom", "main", "site", "page", "box", "block", "container", "wrapper", "wrap", "area", "section", "list", "item", "items", "inner", "outer",
    "bar", "panel", "content", "slot", "unit", "link", "links", "button", "buttons", "post", "posts", "icon", "icons", "text", "title", "body", "row", "column", "columns",
    "global", "primary", "secondary", "header", "heading", "default", "module", "component", "region", "zone", "group", "holder", "frame", "mobile", "desktop", "sticky",
    "fixed", "large", "small", "wide", "inline", "center", "first", "last", "thread", "count", "toggle", "dropdown", "policy", "user", "media", "network", "networks",
    "article", "articles", "story", "stories", "entry", "message", "site", "web", "layer", "window", "section", "reader", "readers", "blog",
}
#: Comments may be articles of their own, and so are no sign of the page's.
REMARKS = {"comment", "comments", "commentlist", "disqus", "respond", "replies", "reply"}
#: Parts of the unlinked text that speak for an element with such a name, with and without an article or title.
MOST, NEARLY_ALL = 0.5, 0.8
#: What a name with such a word in it does to the scores of a path outside of an article.
NAMED_WEIGHT = 0.5
WHOLE = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = ".,;:!?。，¡¿…"

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>?|[^<]++|<",
    re.DOTALL,
)
_NAMED = re.compile(r"(?:^|[\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """Text between two block tags."""

    path: tuple[int, ...]
    tags: str
    pieces: list[str]
    linked: int = 0
    doubtful: bool = False

    def text(self) -> str:
        return " ".join(entities.unescape("".join(self.pieces)).split())


@dataclass
class Suspect:
    """An element whose name says that it is not the article, and what speaks for it."""

    words: set[str]
    holds: set[str]


def _names(attributes: str) -> list[list[str]]:
    """The words of each class, id and role."""
    return [
        words
        for groups in _NAMED.findall(attributes)
        for name in "".join(groups).split()
        if (words := _WORD.findall(_CAMEL.sub(" ", name).lower()))
    ]


def _told(names: list[list[str]], words: set[str]) -> set[str]:
    """Those of ``words`` that stand in a name with nothing but neutral words beside them."""
    return {w for name in names if all(x in words or x in NEUTRAL for x in name) for w in name if w in words}


def blocks_of(page: str) -> tuple[list[Block], dict[int, Suspect], list[int]]:
    """The text blocks of a page that are not boilerplate by their tags, in order, the elements
    under suspicion by their names, and the article and main elements."""
    stack: list[tuple[str, int, str, bool]] = []  # tag, number, label, skipped
    out: list[Block] = []
    suspects: dict[int, Suspect] = {}
    wholes: list[int] = []
    doubts: list[int] = []  # open elements with a doubtful name outside of an article
    now: Block | None = None
    links = number = 0
    inside = 0  # open article or main elements
    skipped_inline: list[str] = []
    at, end = 0, len(page)

    def close(upto: int) -> None:
        nonlocal now, inside
        for tag, *_ in stack[upto:]:
            inside -= tag in WHOLE
        while doubts and doubts[-1] >= stack[upto][1]:
            doubts.pop()
        del stack[upto:]
        now = None

    while at < end:
        token = _TOKEN.match(page, at)
        at = token.end()
        name = token[2] or token[5]
        if name is None:
            text = token[0]
            if text[0] == "<" and len(text) > 1:
                continue
            if (stack and stack[-1][3]) or skipped_inline:
                continue
            if now is None:
                if not text.strip():
                    continue
                now = Block(tuple(n for _, n, _, _ in stack), "/".join(label for _, _, label, _ in stack), [], doubtful=bool(doubts) and not inside)
                out.append(now)
            now.pieces.append(text)
            if links:
                now.linked += len(text.strip())
            continue
        name, closing, attributes = name.lower(), bool(token[1] or token[4]), token[3] or token[6] or ""
        if name in RAW:
            if not closing:
                stop = re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else end
            continue
        if name in INLINE:
            if name == "a":
                links = 0 if closing else 1
            # Inline elements that are named as boilerplate, or hidden, are left out up to their end.
            if skipped_inline:
                if name == skipped_inline[0] and name not in VOID:
                    skipped_inline.pop() if closing else skipped_inline.append(name)
            elif not closing and name not in VOID and attributes and (_HIDDEN.search(attributes) or _told(_names(attributes), NAMES)):
                skipped_inline.append(name)
            continue
        if skipped_inline:
            skipped_inline.clear()
        links = 0
        if name == "br":
            if now is not None:
                now.pieces.append(" ")
            continue
        now = None
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    close(i)
                    break
            continue
        if name in VOID:
            continue
        ends = [CLOSES[name]] if name in CLOSES else []
        if name in CLOSE_P:
            ends.append(CLOSES["p"])
        for closed, walls in ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in closed:
                    close(i)
                    if name != "tr":
                        break
                elif stack[i][0] in walls:
                    break
        names = _names(attributes) if attributes else []
        skip = bool(stack and stack[-1][3]) or name in SKIPPED or (not inside and name == "header")
        skip = skip or bool(attributes and _HIDDEN.search(attributes))
        if attributes.rstrip().endswith("/") and name in ("svg", "math"):
            continue
        number += 1
        if name in WHOLE or name == "h1":
            for _, element, *_ in stack:
                if element in suspects:
                    suspects[element].holds.add(name)
        if names and not skip and name not in ("html", "body", "article", "main"):
            told = _told(names, NAMES) or (set() if inside else _told(names, OUTER_NAMES))
            if told:
                suspects[number] = Suspect(told, set())
            elif not inside and any(w in NAMES for words in names for w in words):
                doubts.append(number)
        if name in WHOLE and not skip:
            wholes.append(number)
        inside += name in WHOLE
        words = sorted({w for own in names for w in own})
        stack.append((name, number, name + ("." + ".".join(words) if words else ""), skip))
    return out, suspects, wholes


def without_suspects(found: list[tuple[Block, str]], suspects: dict[int, Suspect], wholes: list[int]) -> list[tuple[Block, str]]:
    """The blocks that are in no element whose name takes it out."""
    if not suspects:
        return found
    held: dict[int, int] = defaultdict(int)
    around: dict[int, set[int]] = {}
    total = 0
    for block, text in found:
        own = max(0, len(text) - block.linked)
        total += own
        for element in block.path:
            held[element] += own
            if element in wholes:
                around[element] = set(block.path[: block.path.index(element)])

    def stays(element: int, suspect: Suspect) -> bool:
        if "main" in suspect.holds:
            return True
        signs = suspect.holds - ({"article"} if suspect.words & REMARKS else set())
        if signs and held[element] >= MOST * total:
            return True
        others = any(element not in above for above in around.values())
        return held[element] >= NEARLY_ALL * total and not others

    gone = {element for element, suspect in suspects.items() if not stays(element, suspect)}
    return [(block, text) for block, text in found if gone.isdisjoint(block.path)]


def smoothed(values: np.ndarray, width: int = 2) -> np.ndarray:
    """Mean with Gaussian weights over the neighbours in page order."""
    kernel = np.exp(-0.5 * (np.arange(-width, width + 1) / max(1, width / 2)) ** 2)
    weights = np.convolve(np.ones(len(values)), kernel)[width : width + len(values)]
    return np.convolve(values, kernel)[width : width + len(values)] / weights


def main_text(page: str | None) -> str:
    """The article of a page."""
    blocks, suspects, wholes = blocks_of(page or "")
    found = [(block, block.text()) for block in blocks]
    found = without_suspects([(block, text) for block, text in found if text], suspects, wholes)
    if not found:
        return ""
    length, marks, count, linked, plain = (defaultdict(float) for _ in range(5))
    for block, text in found:
        own = max(0, len(text) - block.linked)
        length[block.tags] += own
        plain[block.tags] += len(text)
        linked[block.tags] += min(block.linked, len(text))
        marks[block.tags] += sum(map(text.count, PUNCTUATION))
        count[block.tags] += 1
    ratio = smoothed(np.array([length[b.tags] / count[b.tags] for b, _ in found]))
    pointed = smoothed(np.array([1 + marks[b.tags] / count[b.tags] for b, _ in found]))
    fused = defaultdict(float)
    for (block, _), value in zip(found, np.sqrt(ratio * pointed), strict=True):
        fused[block.tags] = max(fused[block.tags], value)
    own = np.array([max(0, len(text) - block.linked) for block, text in found], float)
    scores = np.array([fused[block.tags] * (NAMED_WEIGHT if block.doubtful else 1.0) for block, _ in found])
    mean = float((scores * own).sum() / own.sum()) if own.sum() else 0.0
    content = (scores >= THRESHOLD * mean) & np.array([linked[b.tags] <= LINK_SHARE * plain[b.tags] for b, _ in found])
    weight = np.where(content, own, 0.0)
    if not weight.sum():
        return ""
    held: dict[int, float] = defaultdict(float)
    depth: dict[int, int] = {}
    tag: dict[int, str] = {}
    for (block, _), w in zip(found, weight, strict=True):
        for d, (element, label) in enumerate(zip(block.path, block.tags.split("/"), strict=False)):
            held[element] += w
            depth[element] = d
            tag[element] = label.split(".", 1)[0]
    enough = [e for e, w in held.items() if w >= COVER * weight.sum()]
    article = max(enough, key=lambda e: (depth[e], e), default=None)
    deepest = max((b.path for b, _ in found if article in b.path), key=len, default=())
    # A paragraph is not an article: what stands beside it belongs to it.
    if article is not None and article == deepest[-1] and len(deepest) > 1 and held[deepest[-2]] >= held[article]:
        article = deepest[-2]
    if article is not None:
        chain = deepest[: depth[article] + 1]
        whole = [d for d, element in enumerate(chain) if tag[element] in WHOLE]
        if whole:
            chain = chain[: whole[-1] + 1]
        paths = {block.path for (block, _), is_content in zip(found, content, strict=True) if is_content}
        while len(chain) > 1 and any(_beside(path, chain, tag) for path in paths):
            chain = chain[:-1]
        article = chain[-1]

    def belongs(block: Block) -> bool:
        if article is not None and article not in block.path:
            return False
        if linked[block.tags] <= LINK_SHARE * plain[block.tags] or block.tags.rsplit("/", 1)[-1].split(".", 1)[0] in HEADINGS:
            return True
        return any(tag[element] == "article" for element in block.path)

    return " ".join(text for (block, text), is_content in zip(found, content, strict=True) if is_content or belongs(block))


def _beside(path: tuple[int, ...], chain: tuple[int, ...], tag: dict[int, str]) -> bool:
    """Whether a block is a neighbour of the last element of ``chain``, or in an article that is one."""
    n = len(chain)
    if path[: n - 1] != chain[:-1] or path[:n] == chain:
        return False
    return len(path) <= n or tag[path[n - 1]] in WHOLE


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")


def op4_tag_path_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract_text(table(spark, sf_dir, "pages"))
