"""Request texts for the outside model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import as_col, fill


def single_prompt(name: Column | str, purpose: Column | str, taxonomy_text: Column) -> Column:
    return fill(V.SINGLE_PROMPT, name=name, purpose=purpose, taxonomy=taxonomy_text)


def category_prompt(name: Column | str, purpose: Column | str, categories_text: Column) -> Column:
    return fill(V.CATEGORY_PROMPT, name=name, purpose=purpose, categories=categories_text)


def subcategory_prompt(
    name: Column | str, purpose: Column | str, category: Column | str, subcategories: Column | str
) -> Column:
    """`subcategories` is the array of labels of the chosen category."""
    return fill(
        V.SUBCATEGORY_PROMPT, name=name, purpose=purpose, category=category,
        subcategories=F.array_join(as_col(subcategories), ", "),
    )


def tokens(text: Column | str) -> Column:
    """Rough token count: characters by four; missing text counts nothing."""
    return F.coalesce(F.floor(F.length(as_col(text)) / F.lit(V.CHARS_PER_TOKEN)).cast("bigint"), F.lit(0).cast("bigint"))


def flat_cost(token_count: Column | str, price_per_million: float = V.FLAT_PRICE_PER_1M) -> Column:
    return as_col(token_count) / F.lit(1_000_000) * F.lit(price_per_million)
