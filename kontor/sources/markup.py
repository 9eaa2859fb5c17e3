"""A small reader for one HTML page: its table rows and its marked elements.

Runs inside an Arrow UDF, one page at a time; everything after the raw cells and
texts is done with DataFrame expressions in `pages`.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from collections.abc import Iterable, Iterator
from html import unescape

# One token: comment, silent element, tag, declaration, or text.
TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
    | <(?:script|style)\b[^>]*>.*?(?:</(?:script|style)\s*>|\Z)
    | <(?P<end>/?)(?P<tag>[a-z][^\s/<>]*+)(?P<attrs>(?:"[^"]*"|'[^']*'|[^'"<>]++)*+)>
    | <[!?][^>]*>?
    | (?P<text>(?:[^<]++|<(?![a-z/!?]))++)
    | <""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BREAKS = frozenset("br p div li tr h1 h2 h3 h4 h5 h6 ul ol table section".split())
# Stands for a line break among the text runs.
BREAK = None
# Tags as they mostly stand in a page, without attributes, and what they are read as.
NAMES = """
a abbr address article aside b blockquote body br button caption center code col colgroup dd div dl dt em fieldset font
footer form h1 h2 h3 h4 h5 h6 head header hr html i img input label legend li link main meta nav ol option p pre
section select small span strong sub sup table tbody td textarea tfoot th thead time title tr u ul
""".split()
PLAIN = {
    f"<{mark}{written}>": (kind, name, "")
    for name in NAMES for written in (name, name.upper()) for mark, kind in (("", "open"), ("/", "close"))
}
PLAIN_SIZE = max(map(len, PLAIN))
# What makes a tag or a declaration of the `<` before it.
TAG_STARTS = frozenset(string.ascii_letters + "/!?")


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    if not text:
        return found
    for name, value in ATTRIBUTE.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), unescape(value) if "&" in value else value)
    return found


def tokens(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag or text, attribute text) with kind one of open, close, text.

    Tags without attributes, and text up to a tag, are cut out without the pattern,
    which reads everything else; the tokens are those of the pattern alone.
    """
    at, size, find, plain = 0, len(html), html.find, PLAIN.get
    while at < size:
        if html[at] == "<":
            end = find(">", at, at + PLAIN_SIZE)
            tag = plain(html[at:end + 1]) if end > 0 else None
            if tag is not None:
                yield tag
                at = end + 1
                continue
        else:
            end = find("<", at)
            if end < 0 or html[end + 1:end + 2] in TAG_STARTS:
                text = html[at:] if end < 0 else html[at:end]
                yield "text", unescape(text) if "&" in text else text, ""
                at += len(text)
                continue
        match = TOKEN.match(html, at)
        at = match.end()
        text = match["text"]
        if text is not None:
            yield "text", unescape(text) if "&" in text else text, ""
        elif match["tag"] is not None:
            yield "close" if match["end"] else "open", match["tag"].lower(), match["attrs"]


class Piece:
    """An element's part of the page's text runs, from its start to its end."""

    __slots__ = ("tag", "attrs", "runs", "start", "end", "link", "linked")

    def __init__(self, tag: str, attrs: dict[str, str], runs: list[str | None]):
        self.tag, self.attrs, self.runs = tag, attrs, runs
        self.start, self.end = len(runs), None
        # Target of the first link inside; a first link without a target counts.
        self.link, self.linked = None, False

    def close(self) -> None:
        self.end = len(self.runs)

    def joined(self, sep: str) -> str:
        """Stripped text runs, put together with `sep`."""
        stripped = (run.strip() for run in self.runs[self.start:self.end] if run is not BREAK)
        return sep.join(run for run in stripped if run)

    def lines(self) -> str:
        """Visible text: one line per block or break, white space squeezed, blank lines left out."""
        lines, line = [], []
        for run in [*self.runs[self.start:self.end], BREAK]:
            if run is not BREAK:
                line.append(run)
                continue
            squeezed = " ".join("".join(line).split())
            line = []
            if squeezed:
                lines.append(squeezed)
        return "\n".join(lines)

    def shown(self) -> tuple[str, str]:
        """Its text runs joined without a separator, and its lines; most cells have one run or none."""
        size = self.end - self.start
        if not size:
            return "", ""
        run = self.runs[self.start]
        if run is BREAK or size > 2 or (size == 2 and self.runs[self.start + 1] is not BREAK):
            return self.joined(""), self.lines()
        return run.strip(), " ".join(run.split())


class Table:
    """An open table: where its next row and cell go."""

    def __init__(self, number: int):
        self.number, self.part, self.rows = number, "", 0
        self.row: dict | None = None
        self.cell: Piece | None = None

    def close_cell(self) -> None:
        cell, self.cell = self.cell, None
        if cell is not None:
            cell.close()
            text, lines = cell.shown()
            self.row["cells"].append({
                "tag": cell.tag, "class": cell.attrs.get("class", ""), "href": cell.link, "text": text, "lines": lines,
            })

    def close_row(self) -> None:
        self.close_cell()
        self.row = None


def inside(parts: Iterable[tuple[str, str, str]], panel: str) -> Iterator[tuple[str, str, str]]:
    """The tokens within the elements whose id is `panel`."""
    tag, depth = "", 0
    for kind, name, attrs in parts:
        if depth:
            if name == tag and kind != "text":
                depth += 1 if kind == "open" else -1
                if not depth:
                    continue
            yield kind, name, attrs
        elif kind == "open" and panel in attrs and attributes(attrs).get("id") == panel:
            tag, depth = name, 1


def table_rows(html: str) -> list[dict]:
    """All rows of all tables in document order; a cell or row ends where the next begins."""
    return rows_of(tokens(html))


def rows_of(parts: Iterable[tuple[str, str, str]]) -> list[dict]:
    rows: list[dict] = []
    tables: list[Table] = []
    runs: list[str | None] = []
    count = 0
    for kind, name, attrs in parts:
        if kind == "text":
            if tables:
                runs.append(name)
            continue
        table = tables[-1] if tables else None
        if table is not None and name in BREAKS:
            runs.append(BREAK)
        if kind == "open":
            if name == "table":
                tables.append(Table(count))
                count += 1
            elif table is None:
                continue
            elif name == "tr":
                table.close_row()
                table.row = {"table_no": table.number, "row_no": table.rows, "part": table.part, "cells": []}
                table.rows += 1
                rows.append(table.row)
            elif name in ("td", "th"):
                table.close_cell()
                if table.row is not None:
                    table.cell = Piece(name, attributes(attrs), runs)
            elif name in ("thead", "tbody", "tfoot"):
                table.close_row()
                table.part = name
            elif name == "a":
                link = attributes(attrs).get("href")
                # Cells around one that has its first link have theirs.
                for cell in (outer.cell for outer in reversed(tables) if outer.cell is not None):
                    if cell.linked:
                        break
                    cell.link, cell.linked = link, True
        elif table is not None:
            if name in ("td", "th"):
                table.close_cell()
            elif name == "tr":
                table.close_row()
            elif name in ("thead", "tbody", "tfoot"):
                table.close_row()
                table.part = ""
            elif name == "table":
                table.close_row()
                tables.pop()
    for table in reversed(tables):
        table.close_row()
    return rows


def elements(html: str, ids: frozenset[str], classes: frozenset[str], links: bool) -> list[dict]:
    """Elements with a wanted id or class, and links, in document order."""
    return elements_of(tokens(html), ids, classes, links)


def elements_of(
    parts: Iterable[tuple[str, str, str]], ids: frozenset[str], classes: frozenset[str], links: bool
) -> list[dict]:
    found: list[Piece] = []
    runs: list[str | None] = []
    stack: list[tuple[str, Piece | None]] = []
    opened: dict[str, int] = defaultdict(int)
    for kind, name, attrs in parts:
        if kind == "text":
            runs.append(name)
            continue
        if name in BREAKS:
            runs.append(BREAK)
        if kind == "open":
            if name in VOID:
                continue
            piece = None
            if attrs:
                given = attributes(attrs)
                if (
                    (links and name == "a" and "href" in given) or given.get("id") in ids
                    or not classes.isdisjoint(given.get("class", "").split())
                ):
                    piece = Piece(name, given, runs)
                    found.append(piece)
            stack.append((name, piece))
            opened[name] += 1
        elif opened[name]:
            while True:
                tag, piece = stack.pop()
                opened[tag] -= 1
                if piece is not None:
                    piece.close()
                if tag == name:
                    break
    return [
        {
            "tag": piece.tag, "id": piece.attrs.get("id", ""), "class": piece.attrs.get("class", ""),
            "href": piece.attrs.get("href"), "text": piece.joined(""), "spaced": piece.joined(" "),
            "lines": piece.lines(),
        }
        for piece in found
    ]
