"""Main text of pages: flat blocks, classified by a decision tree grown on a small labelled table."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.blocks import blocks, features

DEPTH, LEAF = 8, 2

_SENTENCE = "the council agreed on a new plan for the old harbour after a long debate among all its members"


def _words(n: int) -> str:
    words = _SENTENCE.split()
    return " ".join(words[i % len(words)] for i in range(n)).capitalize() + "."


def _menu(n: int) -> str:
    return "".join(f'<li><a href="/{i}">-menu {i}</a></li>' for i in range(n))


# Labelled pages: a block that starts with + is content, one with - is not.  {n} is a sentence of n words.
PAGES = (
    "<nav><ul>{menu}</ul></nav><div class='ad'>-{8}</div><article><h1>+{6}</h1><p>+{60}<br><p>+{25}</article><footer>-{12}</footer>",
    "<nav><ul>{menu}</ul></nav><article><h1>+{9}</h1><p>+{4}</article><footer>-{20}<p>-{5}</footer>",
    "<header>-{3}<a href='/'>-home</a></header><main><h1>+{5}</h1><p>+{40}</p><h2>+{3}</h2><p>+{2}</p><p>+{70}</p></main><aside>-{30}</aside>",
    "<div id='sidebar'><h3>-{2}</h3><ul>{menu}</ul></div><div id='content'><h1>+{7}</h1><p>+{45}</p><p>+{30}</p></div>",
    "<div class='top'><a href='/'>-one</a> <a href='/b'>-two</a></div><h1>+{5}</h1><p>+{50}</p><p>+{35}</p><p>+{28}</p><div>-{4}</div>",
    "<article><header><h1>+{8}</h1><p>+{14}</p></header><p>+{33}</p><ul><li>+{5}</li><li>+{7}</li></ul></article><div class='comments'><p>-{40}</p><p>-{22}</p></div>",
    "<main><article><p>+{55}</p><div class='share'>-{3}</div><p>+{41}</p><section id='comments'><h2>-{2}</h2><p>-{35}</p></section></article></main>",
    "<div class='cookie-notice'><p>-{24}</p><button>-{2}</button></div><article><h1>+{4}</h1><blockquote>+{18}</blockquote><p>+{12}</p></article>",
    "<form><label>-{2}</label><p>-{15}</p></form><article><p>+{26}</p><table><tr><td>+{2}</td><td>+{3}</td></tr></table></article><footer><p>-{26}</p></footer>",
    "<article><h2>+{4}</h2><p>+{3}</p><aside><p>-{28}</p></aside><p>+{31}</p><form>-{9}</form><footer>-{10}</footer></article>",
    "<div role='alert'>-{16}</div><main><p>+{38}</p><p>+{1}</p><nav><a href='/x'>-next</a></nav></main>",
    "<p><a href='/1'>-{6}</a></p><p><a href='/2'>-{7}</a></p><p>+{48}</p><p>+{52}</p><p><a href='/3'>-{9}</a></p><div>-{3}</div>",
    "<article><p>+{20}</p><p>+{15} <a href='/in'>{5}</a></p><p>+{44}</p></article><div class='related'><a href='/r'>-{8}</a></div><div class='newsletter'>-{18}</div>",
    "<body><div class='page has-sidebar'><article><p>+{22}</p><p>+{6}</p></article></div><div class='widget'>-{21}</div></body>",
    "<article><h1>+{3}</h1><p>+{2}</p></article><section class='reader-comments'><article><p>-{30}</p></article></section>",
    "<nav><ul>{menu}</ul></nav><article><h1>+{2}</h1><p>+{3}</p><p>+{1}",
    "<article><p>+{20}</p><p><a href='/x'>+{4}</a></p><ul><li><a href='/y'>+{3}</a></li></ul><p>+{2}</p></article>",
    "<main><p><a href='/x'>+{9}</a></p><p>+{16}</p><p><a href='/z'>+{2}</a></p></main>",
    "<div id='story'><p>+{45}</p><p>+{10}</p><p>+{37}</p></div><aside><p>-{50}</p><p>-{33}</p></aside><footer><p>-{45}</p></footer>",
    "<div class='post-body'><h1>+{6}</h1><p>+{60}</p></div><div class='comments'><p>-{60}</p><p>-{80}</p><p>-{9}</p></div>",
    "<div class='cookie-consent'><p>-{38}</p></div><div class='text'><p>+{40}</p><p>+{29}</p></div><div class='sponsored'><p>-{34}</p></div>",
    "<div class='promo'><p>-{29}</p></div><div class='entry'><p>+{36}</p><p>+{44}</p></div><div class='sidebar-widget'><p>-{31}</p></div>",
    "<nav><p>-{30}</p><p>-{47}</p></nav><div><p>+{50}</p><p>+{29}</p></div><form><p>-{42}</p></form><header><p>-{28}</p></header>",
    "<div>-{3}</div><h1>+{4}</h1><p>+{9}</p><p>+{12}</p><p>+{5}</p><div>-{6}</div>",
    "<div><a href='/'>-home</a></div><h2>+{6}</h2><p>+{3}</p><p>+{20}</p><h2>+{2}</h2><p>+{8}</p><div>-{2}</div>",
    "<div>-{2}</div><div>-{3}</div><p>+{11}</p><p>+{30}</p>",
    "<div>-{4}</div><h1>+{3}</h1><p>+{17}</p><p>+{6}</p>",
    "<h1>+{5}</h1><p>+{22}</p><div>-{5}</div><p>+{13}</p><div>-{2}</div><p>+{9}</p>",
    "<div>-{3}</div><div>+{35}</div><div>+{50}</div><div>-{4}</div>",
    "<div>-{8}</div><p>+{4}</p><p>+{2}</p><p>+{3}</p><div>-{6}</div><div>-{5}</div>",
    "<h2>+{2}</h2><p>+{3}</p><p>+{4}</p><div>-{7}</div>",
    "+{40}",
    "<article><div class='advert'><p>-{14}</p></div><p>+{18}</p></article><ul class='menu'>{menu}</ul><div class='copyright'>-{6}</div>",
)


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of all blocks of the labelled pages."""
    import re

    rows, labels = [], []
    for k, page in enumerate(PAGES):
        filled = re.sub(r"\{(\d+)\}", lambda m: _words(int(m[1])), page.replace("{menu}", _menu(3 + k % 4)))
        found = blocks(filled)
        labels += [one.text[0] == "+" for one in found]
        rows += features(found)
    return np.array(rows), np.array(labels)


# --- the tree -------------------------------------------------------------------
@dataclass(frozen=True)
class Tree:
    """A leaf has a vote; a node sends values up to `border` of feature `place` to `low`, others to `high`."""

    vote: bool
    place: int = -1
    border: float = 0.0
    low: Tree | None = None
    high: Tree | None = None

    def decide(self, row: list[float]) -> bool:
        node = self
        while node.place >= 0:
            node = node.low if row[node.place] <= node.border else node.high
        return node.vote


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = DEPTH, leaf: int = LEAF) -> Tree:
    """A binary tree by least Gini impurity; of equal splits the first feature and the lowest border."""
    vote = bool(2 * labels.sum() >= len(labels))
    if depth == 0 or labels.all() or not labels.any():
        return Tree(vote)
    best = (_impurity(labels), -1, 0.0)
    for place in range(rows.shape[1]):
        values = np.unique(rows[:, place])
        for border in (values[1:] + values[:-1]) / 2:
            low = rows[:, place] <= border
            if leaf <= low.sum() <= len(low) - leaf:
                cost = _impurity(labels[low]) + _impurity(labels[~low])
                best = min(best, (round(cost, 9), place, float(border)))
    if best[1] < 0:
        return Tree(vote)
    low = rows[:, best[1]] <= best[2]
    return Tree(vote, best[1], best[2], grow(rows[low], labels[low], depth - 1, leaf), grow(rows[~low], labels[~low], depth - 1, leaf))


def _impurity(labels: np.ndarray) -> float:
    share = labels.mean()
    return float(2 * len(labels) * share * (1 - share))


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page or "")
    return "\n\n".join(one.text for one, row in zip(found, features(found)) if tree.decide(row))


# --- the operator ---------------------------------------------------------------
def extracted(page: Column) -> Column:
    """The main text of a page: its content blocks joined by empty lines, empty for a null page or one without content.

    A block's character references are decoded and its white space is turned into one
    space; no block is cut short.  Tags that are never closed, or cut off, are read as far
    as they go.
    """
    tree = grow(*labelled())

    @F.pandas_udf("string")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(one, tree) for one in pages], dtype=object)

    return each(page)


def extract(df: DataFrame, html: str = "html", into: str = "text") -> DataFrame:
    """`df` with the main text of `html` as column `into`; every row stays, also repeated ones."""
    kept = [F.col(f"`{name}`") for name in df.columns if name != into]
    return df.select(*kept, extracted(F.col(f"`{html}`")).alias(into))
