"""Counts, shares, coverage, distributions and cost estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.prompts import flat_cost, tokens
from kontor.operators.projection import quoted
from kontor.operators.sizing import written


def observed(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The same rows with a count taken along by whatever job reads them: `observation.get["n"]`."""
    observation = Observation(name)
    return df.observe(observation, F.count("*").alias("n")), observation


def value_counts(df: DataFrame, column: str, keep_nulls: bool = False) -> DataFrame:
    """Rows per value; without `keep_nulls` the NULL group is left out."""
    rows = df if keep_nulls else df.filter(quoted(column).isNotNull())
    return rows.groupBy(quoted(column)).agg(F.count("*").alias("n"))


def by_count(counts: DataFrame, column: str) -> DataFrame:
    return counts.orderBy(F.desc("n"), quoted(column).asc_nulls_first())


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """The k most frequent values, ties by value; planned as a take-ordered, not a full sort."""
    return by_count(value_counts(df, column), column).limit(k)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*(quoted(name) for name in order)).limit(n)


def distribution(df: DataFrame, column: str, keep_nulls: bool = True) -> DataFrame:
    """Rows per value and their percentage of all rows, unlabelled rows included.

    The grouped counts are written once and the total is a scalar subquery over
    them, so the input is read once whatever the number of values.
    """
    counts = written(value_counts(df, column, keep_nulls=True), "counts")
    total = counts.agg(F.sum("n")).scalar()
    shown = counts if keep_nulls else counts.filter(quoted(column).isNotNull())
    return shown.withColumn("percent", F.col("n") / total * 100)


def two_level_distribution(df: DataFrame, category: str, subcategory: str) -> DataFrame:
    """Category and subcategory counts in one result.

    Level 1 rows give the category's share of all rows, level 2 rows the
    subcategory's share of its category.  The pairs are counted once and written;
    totals come from those counts, never from the base rows again.
    """
    pairs = written(df.groupBy(quoted(category), quoted(subcategory)).agg(F.count("*").alias("n")), "pairs")
    total = pairs.agg(F.sum("n")).scalar()
    parents = pairs.groupBy(quoted(category)).agg(F.sum("n").alias("n"))
    parents = parents.filter(quoted(category).isNotNull())
    top = parents.select(
        F.lit(1).alias("level"), quoted(category), F.lit(None).cast("string").alias(subcategory), "n",
        (F.col("n") / total * 100).alias("percent"),
    )
    inner = (
        pairs.filter(quoted(subcategory).isNotNull())
        .join(parents.withColumnRenamed("n", "__whole"), category)
        .select(
            F.lit(2).alias("level"), quoted(category), quoted(subcategory), "n",
            (F.col("n") / F.col("__whole") * 100).alias("percent"),
        )
    )
    return top.unionByName(inner)


def subtotals(df: DataFrame, category: str, subcategory: str) -> DataFrame:
    """Counts per pair, per category and overall, by rollup; `grouping` tells them apart."""
    return df.rollup(quoted(category), quoted(subcategory)).agg(
        F.count("*").alias("n"), F.grouping_id().cast("int").alias("grouping")
    )


def contact_coverage(
    df: DataFrame, by: str, phone: str = "phone_numbers", email: str = "email", website: str = "website"
) -> DataFrame:
    """Per group: all rows and how many have a phone, an e-mail, a website."""
    return df.groupBy(quoted(by)).agg(
        F.count("*").alias("total"),
        F.count(quoted(phone)).alias("has_phone"),
        F.count(quoted(email)).alias("has_email"),
        F.count(quoted(website)).alias("has_website"),
    )


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, present and missing; one pass over the table."""
    counts = [F.count(quoted(name)).alias(f"n{i}") for i, name in enumerate(columns)]
    wide = df.agg(F.count("*").alias("total"), *counts)
    lines = F.array(*(
        F.struct(F.lit(name).alias("column"), F.col(f"n{i}").alias("present")) for i, name in enumerate(columns)
    ))
    return wide.select("total", F.inline(lines)).select(
        "column", "total", "present", (F.col("total") - F.col("present")).alias("missing")
    )


def date_profile(df: DataFrame, column: str) -> DataFrame:
    """Rows, valid and missing dates, earliest and latest."""
    day = quoted(column)
    return df.agg(
        F.count("*").alias("total_rows"), F.count(day).alias("valid_dates"),
        F.count_if(day.isNull()).alias("missing_dates"), F.min(day).alias("earliest"), F.max(day).alias("latest"),
    )


def progress_counts(df: DataFrame, is_pending: Column) -> DataFrame:
    """Rows in all, finished and remaining."""
    open_rows = F.count_if(F.coalesce(is_pending, F.lit(False)))
    return df.agg(
        F.count("*").alias("total_rows"), (F.count("*") - open_rows).alias("processed"), open_rows.alias("remaining")
    )


def key_set(df: DataFrame, record: str) -> DataFrame:
    """All keys of a map column over all rows, one row each."""
    return df.select(F.explode(F.map_keys(quoted(record))).alias("key")).distinct()


def items_per_page(df: DataFrame, page: str, item: str) -> DataFrame:
    """Records found on each page; a page whose rows have no `item` has none."""
    return df.groupBy(quoted(page)).agg(F.count(quoted(item)).alias("found"))


def token_estimate(
    df: DataFrame, name: str, purpose: str, base_tokens: Column | int,
    count_tokens=tokens, reply_tokens: int = V.REPLY_TOKENS,
) -> DataFrame:
    """Token totals of a run in one aggregate; missing text counts nothing, no rows average to 0."""
    rows = F.count("*")
    base = base_tokens if isinstance(base_tokens, Column) else F.lit(base_tokens)
    sums = df.agg(
        rows.alias("number_of_companies"),
        F.coalesce(F.sum(count_tokens(quoted(name))), F.lit(0)).alias("company_name_tokens"),
        F.coalesce(F.sum(count_tokens(quoted(purpose))), F.lit(0)).alias("purpose_tokens"),
    ).withColumns({
        "base_prompt_tokens": base.cast("bigint"),
        "estimated_response_tokens": F.col("number_of_companies") * reply_tokens,
    })
    total = (
        F.col("base_prompt_tokens") * F.col("number_of_companies") + F.col("company_name_tokens")
        + F.col("purpose_tokens") + F.col("estimated_response_tokens")
    )
    totals = sums.withColumn("total_estimated_tokens", total)
    return totals.select(
        "base_prompt_tokens", "company_name_tokens", "purpose_tokens", "estimated_response_tokens",
        "total_estimated_tokens", "number_of_companies",
        F.when(F.col("number_of_companies") > 0, F.col("total_estimated_tokens") / F.col("number_of_companies"))
        .otherwise(F.lit(0.0)).alias("average_tokens_per_company"),
    )


def cost_estimate(
    estimate: DataFrame, input_price: float = V.INPUT_PRICE_PER_1K, output_price: float = V.OUTPUT_PRICE_PER_1K
) -> DataFrame:
    """Input, output and total cost of a token estimate."""
    asked = (
        F.col("base_prompt_tokens") * F.col("number_of_companies")
        + F.col("company_name_tokens") + F.col("purpose_tokens")
    )
    input_cost = asked / 1000 * input_price
    output_cost = F.col("estimated_response_tokens") / 1000 * output_price
    return estimate.withColumns({
        "input_cost": input_cost, "output_cost": output_cost, "total_cost": input_cost + output_cost,
    })


def flat_cost_estimate(
    df: DataFrame, is_pending: Column, per_row: int = V.FLAT_TOKENS, price: float = V.FLAT_PRICE_PER_1M
) -> DataFrame:
    """Cost of the remaining rows at a flat number of tokens each."""
    return (
        df.agg(F.count_if(F.coalesce(is_pending, F.lit(False))).alias("remaining"))
        .withColumn("estimated_tokens", F.col("remaining") * per_row)
        .withColumn("estimated_cost", flat_cost("estimated_tokens", price))
    )
