"""Pages as flat text blocks with features, for main-text extraction.

A block is the text between two block-level tags.  Its features are its own word count
and link density, those of the blocks before and after it, and where it stands.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# --- fixed values: what tags and names of classes say ---------------------------------
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their text is no markup, or not shown as text.
RAW = frozenset("script style noscript template svg math iframe object textarea select title canvas audio video".split())
# Without an end tag, these reach to the page's end; others are read as any tag.
TO_END = frozenset("script style textarea title".split())
# Empty if they end in />.
SELF_CLOSED = frozenset("svg math".split())
AROUND = frozenset("nav footer aside form menu dialog fieldset button".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices notification alert announcement newsletter subscribe subscription signup login share sharing social related "
    "recommended recommendations popular trending sidebar widget menu nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead topbar toolbar comment comments disqus reply replies respond popup modal overlay skip pagination pager "
    "copyright legal disclaimer search form".split()
)
# What holds the text where no article or main element does.
CONTENT = frozenset("article post entry story content main".split())
# Of the page, not of an article.
OUTER = frozenset("header site-header page-header".split())
UNHINTED = frozenset("html head body article main".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<close2>/?)(?P<tag2>[a-z][a-z0-9:-]*)(?P<more2>[^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-z][^>]*\Z",
    re.IGNORECASE | re.DOTALL,
)
RAW_END = {name: re.compile(rf"</{name}\s*>", re.IGNORECASE) for name in RAW}
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.IGNORECASE)
NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

FEATURES = (
    "words", "link density", "words before", "link density before", "words after", "link density after",
    "around", "hinted", "in article", "heading", "list item", "paragraph", "sentence end",
)


@dataclass
class Block:
    text: str
    linked: int
    around: bool
    hinted: bool
    article: bool
    heading: bool
    item: bool
    paragraph: bool
    words: int = field(init=False)

    def __post_init__(self):
        self.words = self.text.count(" ") + 1

    @property
    def density(self) -> float:
        return min(1.0, self.linked / self.words)


def hinted(attributes: str) -> tuple[bool, bool, bool]:
    """Whether class, id, role or style say that a tag is no content; that it is none outside articles; that it is."""
    inner = outer = content = False
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name == "hidden":
            inner = True
        elif name == "style":
            inner |= "display:none" in value.replace(" ", "").lower()
        elif name == "role":
            inner |= value.strip().lower() in ROLES
            content |= value.strip().lower() in ("main", "article")
        else:
            for one in value.split():
                parts = [part.lower() for part in NAME_PART.findall(one)]
                outer |= one.lower() in OUTER
                content |= not CONTENT.isdisjoint(parts)
                inner |= any(
                    part in HINTS and (i == 0 or parts[i - 1] not in ("has", "with", "no", "without"))
                    for i, part in enumerate(parts)
                )
    return inner, outer, content and not inner


def _kinds(tag: str) -> tuple[bool, bool, bool]:
    return tag in HEADINGS, tag in ("li", "dd", "dt"), tag in ("p", "blockquote", "pre", "td", "th", "figcaption")


class _Reader:
    """Walks through a page's tags; `open` holds (tag, around, hinted, article) of the open block-level tags."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, bool, bool]] = []
        self.parts: list[str] = []
        self.linked, self.links = 0, 0
        self.last = ""

    def text(self, raw: str) -> None:
        if raw:
            self.parts.append(raw)
            if self.links:
                self.linked += len(raw.split())

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                top = self.open[-1] if self.open else ("", False, False, False)
                self.blocks.append(Block(text, self.linked, top[1], top[2], top[3], *_kinds(self.last)))
        self.parts, self.linked = [], 0

    def start(self, tag: str, attributes: str) -> None:
        if tag == "a":
            self.links = 1
        elif tag == "br":
            self.parts.append(" ")
        if tag in INLINE:
            return
        self.flush()
        self.links = 0
        if tag in VOID:
            return
        self.last = tag
        _, around, hint, article = self.open[-1] if self.open else ("", False, False, False)
        inner, outer, content = hinted(attributes) if attributes and tag not in UNHINTED else (False, False, False)
        article = article or content or tag in ("article", "main")
        around = around or tag in AROUND or (tag == "header" and not article)
        if tag == "p" and self.open and self.open[-1][0] == "p":
            self.open.pop()  # a paragraph ends where the next begins
        self.open.append((tag, around, hint or inner or (outer and not article), article))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.links = 0
        if tag in INLINE:
            return
        self.flush()
        self.last = ""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                return


def _raw_end(page: str, tag: str, at: int) -> int | None:
    """Where the raw element whose start tag ends at `at` is over; None if it is never closed and read as any tag."""
    found = RAW_END[tag].search(page, at)
    return found.end() if found else len(page) if tag in TO_END else None


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order; scripts, styles, comments and the title have none."""
    reader, at, unclosed = _Reader(), 0, set()
    while match := TOKEN.search(page, at):
        reader.text(page[at:match.start()])
        at = match.end()
        tag = (match["tag"] or match["tag2"] or "").lower()
        more = match["more"] or match["more2"] or ""
        if not tag:
            continue
        if match["close"] or match["close2"]:
            reader.end(tag)
        elif tag in SELF_CLOSED and more.endswith("/"):
            continue
        elif match["tag"] and tag in RAW and tag not in unclosed and (end := _raw_end(page, tag, at)) is not None:
            at = end
        else:
            if match["tag"] and tag in RAW:
                unclosed.add(tag)  # not searched for again, so many of them stay linear
            reader.start(tag, more)
    reader.text(page[at:])
    reader.flush()
    return reader.blocks


def features(rows: list[Block]) -> list[list[float]]:
    """One list of numbers for each block, in the order of FEATURES; -1 where there is no neighbour."""
    result = []
    for i, one in enumerate(rows):
        before, after = rows[i - 1] if i else None, rows[i + 1] if i + 1 < len(rows) else None
        near = [x for other in (before, after) for x in ((other.words, other.density) if other else (-1, -1))]
        flags = [one.around, one.hinted, one.article, one.heading, one.item, one.paragraph, one.text[-1] in ".!?…\"”»:;。"]
        result.append([float(x) for x in (one.words, one.density, *near, *flags)])
    return result
