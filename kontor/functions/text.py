"""Text functions: strip, fold, split, clean, fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V

# White space as Python sees it: Unicode space plus the four ASCII separators.
SPACE = r"[\s\x1c-\x1f]"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column | str) -> Column:
    """Remove white space of any kind from both ends; `trim` only drops blanks.

    A run inside the text is tried once, at its start.
    """
    return F.regexp_replace(as_col(text), rf"(?U)^{SPACE}++|(?<!{SPACE}){SPACE}++\z", "")


def blank_to_null(text: Column | str) -> Column:
    """One null convention: blank text is missing."""
    return F.nullif(strip(text), F.lit(""))


def has_text(text: Column | str) -> Column:
    """Whether there is anything but white space; false for NULL."""
    return F.coalesce(as_col(text).rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def missing_to_null(text: Column | str, tokens: Sequence[str] = V.MISSING_TOKENS) -> Column:
    """Cells a data-frame scan would read as missing become NULL; others stay untouched."""
    text = as_col(text)
    return F.when(~text.isin(*tokens), text)


def fold_newlines(text: Column | str, by: str) -> Column:
    return F.replace(strip(text), F.lit("\n"), F.lit(by))


def text_or_empty(text: Column | str) -> Column:
    return F.coalesce(as_col(text), F.lit(""))


def split_list(text: Column | str, sep: str = ",") -> Column:
    """Separated text to an array; empty or missing text is an empty array."""
    text = as_col(text)
    empty = F.array().cast("array<string>")
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(F.split(text, f"\\Q{sep}\\E"))


def join_list(items: Column | str, sep: str = ",") -> Column:
    """Array to separated text; an empty or missing array is NULL."""
    return F.nullif(F.array_join(as_col(items), sep), F.lit(""))


def title_fields(block: Column | str, names: Sequence[str] = V.TITLE_FIELDS) -> Column:
    """Lines of a title block as a struct; NULL if there are fewer lines than fields."""
    lines = F.split(as_col(block), "\n")
    fields = F.struct(*(strip(F.get(lines, F.lit(i))).alias(name) for i, name in enumerate(names)))
    return F.when(F.size(lines) >= len(names), fields)


def words(text: Column | str, stop_words: Sequence[str] = V.STOP_WORDS) -> Column:
    """Lower-cased words without punctuation, digits and stop words, in text order.

    The classes are spelled with Unicode properties: word characters are letters,
    numbers and the underscore, so a combining mark splits a word.
    """
    no_digits = F.regexp_replace(F.lower(text_or_empty(text)), r"\p{Nd}+", "")
    # White space and punctuation alike end a word; a-z first, as most letters are.
    parts = F.split(no_digits, r"[^a-z_\p{L}\p{N}]+")
    # More than ten literals, so Catalyst turns the test into a hash-set probe.
    unwanted = sorted(set(stop_words) | {""})
    return F.filter(parts, lambda word: ~word.isin(*unwanted))


def clean_text(text: Column | str, stop_words: Sequence[str] = V.STOP_WORDS) -> Column:
    return F.array_join(words(text, stop_words), " ")


def fill(template: str, **places: Column | str) -> Column:
    """Put Columns into the `{place}` marks of a template as one `concat`.

    NULL values fill in as empty text, so a missing field never loses the row.
    """
    parts: list[Column] = []
    rest = template
    while rest:
        found = [(rest.find("{" + name + "}"), name) for name in places]
        found = [hit for hit in found if hit[0] >= 0]
        if not found:
            parts.append(F.lit(rest))
            break
        at, name = min(found)
        if at:
            parts.append(F.lit(rest[:at]))
        parts.append(text_or_empty(places[name]))
        rest = rest[at + len(name) + 2:]
    return F.concat(*parts) if parts else F.lit("")


def model_text(name: Column | str, purpose: Column | str) -> Column:
    """The cleaned text a zero-shot scorer sees; the literal words survive, lower-cased."""
    return clean_text(fill(V.MODEL_TEXT, name=as_col(name), purpose=as_col(purpose)))


def hypothesis(label: Column | str, template: str) -> Column:
    """A label put into the `{}` of a hypothesis template."""
    return F.replace(F.lit(template), F.lit("{}"), as_col(label))


def percent_text(part: Column, whole: Column, digits: int = 1) -> Column:
    """Display form only: compare the double, not this text."""
    return F.format_string(f"%.{digits}f%%", part / whole * 100)
