"""Secrets in texts: three fixed patterns, and literals assigned to names that mean a secret.

The second part reads statements of source and configuration syntax: a target name, an
assignment sign, and a sum of literals and names of constants; also block scalars and
pairs of attributes (key="..." value="...").  Constants are resolved within their text,
also over several steps and before their definition.  An expression counts by how much its
target's name means a secret and how little all its parts together look like a
placeholder; all parts of a sum that counts are marked, wherever they are defined.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: the base patterns, their kinds in order, and their least lengths ----
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the same as runs of any length without those below 32
KINDS = ("assign", "access", "hex", "named")
LEAST_ASSIGNED, LEAST_ACCESS = 8, 16

# --- fixed values: what names mean, and values that stand for none ---------------------
MEANING = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "secret": 1.0, "token": 0.9,
    "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "bearer": 0.9, "authorization": 0.8, "auth": 0.6, "pass": 0.7,
    "signature": 0.6, "private": 0.5, "access": 0.4, "api": 0.4, "key": 0.5, "encryption": 0.4, "signing": 0.5, "client": 0.1,
}
HARMLESS = {"public", "name", "id", "path", "file", "url", "uri", "type", "length", "size", "count", "expires", "ttl", "hint"}
PLACEHOLDER = re.compile(
    r"(?i)example|sample|dummy|placeholder|change_?me|your[_-]|^x+$|^\*+$|^<.*>$|^\$\{.*\}$|^\$\w+$|^%\(?\w+|^\{\{.*\}\}$"
    r"|^(true|false|null|none|undefined|nil|todo|test)$"
)
LEAST_LITERAL, LEAST_SCORE = 8, 0.5

_COPIED = r"[A-Za-z_$][A-Za-z0-9_$.\-]*"
_NAME = _COPIED + "+"  # possessive, so names of any length are read in linear time
_LITERAL = r'"(?:[^"\\\n]|\\.)*+"|' + r"'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`"
_TERM = rf"(?:{_LITERAL})|{_NAME}(?![(\[])"
STATEMENT = re.compile(
    rf"(?<![A-Za-z0-9_$.\-])(?:[\"']({_NAME})[\"']|({_NAME}))(?:\[[\"']({_NAME})[\"']\])?"
    rf"[ \t]*(?:\:[ \t]*[A-Za-z_][A-Za-z0-9_]*[ \t]*=|:=|=>|[:=])(?![=:])[ \t]*"
    rf"(?:((?:{_LITERAL}|{_COPIED}(?![\w(]))(?:[ \t]*\+[ \t]*(?:{_TERM}))*+)|([^\s\"'`,;#{{}}\[\]()<>]+))"
)
# Attributes of one element, and a key whose value is the deeper lines below it.
PAIR = re.compile(rf"""(?<![\w-])(?:key|name|id)=["']({_NAME})["'][ \t]+value=["']([^"'\n]*+)["']""")
BLOCK = re.compile(
    rf"""(?m)^([ \t]*+)["']?({_NAME})["']?:[ \t]*[|>][+-]?[0-9]?[ \t]*\n((?:\1[ \t]++[^\s].*+(?:\n|\Z)|[ \t]*+\n)++)"""
)
_ONE = re.compile(rf"{_LITERAL}|{_COPIED}")
_LINE = re.compile(r"(?m)^[ \t]*+(?!-----)(\S+(?:[ \t]+\S+)*)")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in code points."""
    found = []
    if "=" in text or ":" in text:
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=_order)


def _order(span: tuple) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def name_score(name: str) -> float:
    """0 to 1: what the parts of a name say, a last part that names something else taking it back."""
    parts = [part.lower() for part in _PART.findall(name)]
    if not parts or parts[-1] in HARMLESS or "public" in parts:
        return 0.0
    joined = max((MEANING.get(a + b, 0.0) for a, b in zip(parts, parts[1:])), default=0.0)
    return min(1.0, max(joined, sum(MEANING.get(part, MEANING.get(part.removesuffix("s"), 0.0)) for part in parts)))


def varied(counts: Counter) -> float:
    """0 for short values and prose; towards 1 the more the counted characters vary."""
    size = counts.total()
    if size < LEAST_LITERAL or counts[" "] > 2:
        return 0.0
    entropy = -sum(n / size * math.log2(n / size) for n in counts.values())
    kinds = sum(any(map(test, counts)) for test in (str.islower, str.isupper, str.isdigit))
    return min(1.0, entropy / 3.5) * (1.0 if kinds > 1 else 0.85)


def literal_score(value: str) -> float:
    """0 for short values, prose and placeholders; towards 1 the more its characters vary."""
    return 0.0 if PLACEHOLDER.search(value) else varied(Counter(value))


def statements(text: str) -> Iterator[tuple[str, list[tuple[int, int, str | None]]]]:
    """(target name, parts of its value) of each assignment; a part is (start, end, the constant's name or None)."""
    for match in STATEMENT.finditer(text):
        name = match[3] or match[1] or match[2]
        if match[4] is not None:
            at = match.start(4)
            parts = ((at + m.start(), at + m.end(), m[0]) for m in _ONE.finditer(match[4]))
            yield name, [(a + 1, b - 1, None) if one[0] in "\"'`" else (a, b, one) for a, b, one in parts]
        else:
            yield name, [(*match.span(5), None)]
    if "value=" in text:
        for match in PAIR.finditer(text):
            yield match[1], [(*match.span(2), None)]
    if "|" in text or ">" in text:
        for match in BLOCK.finditer(text):
            at = match.start(3)
            yield match[2], [(at + m.start(1), at + m.end(1), None) for m in _LINE.finditer(match[3])]


def _resolved(read: list[tuple[str, list]]) -> list[tuple[str, list[tuple[int, int]], list[str]]]:
    """(target, spans of its own literals, constants it names).  An unknown name alone is a value if it holds a digit."""
    known = {name for name, _ in read}
    result = []
    for name, parts in read:
        spans = [(a, b) for a, b, one in parts if one is None]
        named = [one for _, _, one in parts if one in known]
        if not spans and not named and any(any(map(str.isdigit, one)) for _, _, one in parts):
            spans = [(a, b) for a, b, _ in parts]  # a bare word, as configuration has it
        result.append((name, spans, named))
    return result


def _contents(text: str, read: list[tuple[str, list, list]]) -> dict[str, Counter]:
    """Counted characters of each name's first value, its constants' among them; one that names itself adds nothing."""
    first = {name: (spans, named) for name, spans, named in reversed(read)}
    done: dict[str, Counter] = {}
    for name in first:
        todo, begun = [name], set()
        while todo:
            one = todo[-1]
            spans, named = first[one]
            if one not in done and one not in begun:
                begun.add(one)
                todo += [other for other in named if other not in done and other not in begun]
                continue
            todo.pop()
            if one not in done:
                done[one] = Counter("".join(text[a:b] for a, b in spans))
                for other in named:
                    done[one].update(done.get(other, ()))
    return done


def named_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of literals whose target, directly or by way of constants, means a secret."""
    if "=" not in text and ":" not in text:
        return []
    read = _resolved(list(statements(text)))
    wanted = {name: name_score(name) for name, _, _ in read}
    if not any(wanted.values()):
        return []
    by_name: dict[str, list[tuple[list, list]]] = {}
    for name, spans, named in read:
        by_name.setdefault(name, []).append((spans, named))
    todo = [name for name, score in wanted.items() if score]
    while todo:  # a constant means what the names it reaches mean
        name = todo.pop()
        for _, named in by_name[name]:
            for other in named:
                if wanted[other] < wanted[name]:
                    wanted[other] = wanted[name]
                    todo.append(other)
    contents = _contents(text, read)
    found, parts = set(), []
    for name, score in wanted.items():
        for spans, named in by_name[name] if score else ():
            own = "".join(text[a:b] for a, b in spans)
            whole = Counter(own)
            for other in named:
                whole.update(contents[other])
            if score * varied(whole) >= LEAST_SCORE and not PLACEHOLDER.search(own):
                found |= {(a, b, "named") for a, b in spans if b > a}
                if len(spans) + len(named) > 1:
                    parts += named
    whole_names = set()
    while parts:  # what a secret is put together from is part of it
        name = parts.pop()
        if name not in whole_names:
            whole_names.add(name)
            for spans, named in by_name[name]:
                if not PLACEHOLDER.search("".join(text[a:b] for a, b in spans)):
                    found |= {(a, b, "named") for a, b in spans if b > a}
                parts += named
    return sorted(found, key=_order)


def secret_spans(text: str | None) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The base spans, and with them the named ones that no single base span holds whole."""
    base = base_spans(text or "")
    more = [one for one in named_spans(text or "") if not any(start <= one[0] and one[1] <= end for start, end, _ in base)]
    return base, sorted(base + more, key=_order)


def spelled(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


SCHEMA = (
    "n_assign long, n_access long, n_hex long, n_named long, base_sha256 string, "
    "spans array<struct<kind: string, start: int, end: int>>"
)


def scanned(text: Column) -> Column:
    """struct of counts by kind, the digest of the base spans, and all spans; a null text counts as empty."""

    @F.pandas_udf(SCHEMA)
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for one in texts:
                base, spans = secret_spans(one)
                kinds = [kind for _, _, kind in spans]
                rows.append((
                    *(kinds.count(kind) for kind in KINDS), hashlib.sha256(spelled(base).encode()).hexdigest(),
                    [{"kind": kind, "start": start, "end": end} for start, end, kind in spans],
                ))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "n_named", "base_sha256", "spans"])

    return each(text)


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, n_named, base_sha256, spans) of every row; spans in code points, end exclusive."""
    rows = df.select(F.col(f"`{key}`").alias("key"), scanned(F.col(f"`{text}`")).alias("found"))
    return rows.select("key", "found.*")
