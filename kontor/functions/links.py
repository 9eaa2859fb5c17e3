"""URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor.functions.text import as_col


def form_encode(text: Column | str) -> Column:
    """Query-string encoding: blank as `+`, `*` escaped, `~` left alone."""
    encoded = F.url_encode(as_col(text))
    return F.replace(F.replace(encoded, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_url(name: Column | str, base: str, suffix: str = "") -> Column:
    return F.concat(F.lit(base), form_encode(name), F.lit(suffix))


def origin(url: Column | str) -> Column:
    """Scheme and host of an absolute URL."""
    return F.nullif(F.regexp_extract(as_col(url), r"^(https?://[^/?#]+)", 1), F.lit(""))


def resolve(base: Column | str, href: Column | str) -> Column:
    """`href` made absolute against a base without a path; blank links are NULL."""
    base, href = as_col(base), as_col(href)
    scheme = F.regexp_extract(base, r"^([a-z]+:)//", 1)
    return (
        F.when(href == "", None)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.rlike(r"^[/?#]"), F.concat(base, href))
        .otherwise(F.concat(base, F.lit("/"), F.regexp_replace(href, r"^(\.{1,2}/)+", "")))
    )
