"""Registration dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import as_col


def date_text(phrase: Column | str, pattern: str = V.REGISTERED_ON) -> Column:
    """The date inside a registration phrase as text, NULL if the phrase has none."""
    return F.nullif(F.regexp_extract(as_col(phrase), pattern, 1), F.lit(""))


def parse_date(text: Column | str, fmt: str = V.REGISTERED_ON_FORMAT) -> Column:
    """Text to DATE; impossible dates are NULL, never an error."""
    return F.try_to_date(as_col(text), fmt)


def within_years(day: Column | str, first: int = V.FIRST_YEAR, last: int = V.LAST_YEAR) -> Column:
    """The date if its year lies in first..last (both allowed), else NULL."""
    day = as_col(day)
    return F.when(F.year(day).between(first, last), day)


def registration_date(phrase: Column | str) -> Column:
    return within_years(parse_date(date_text(phrase)))


def iso_date(day: Column | str) -> Column:
    return F.date_format(as_col(day), "yyyy-MM-dd")
