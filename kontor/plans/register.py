"""Register pages: result lists to register rows, extract pages to company records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.text import blank_to_null
from kontor.operators.dedup import first_per_key
from kontor.operators.filters import drop_failed, with_all
from kontor.operators.joins import not_done
from kontor.operators.projection import quoted, reshape
from kontor.operators.sizing import written
from kontor.sources.pages import extract_records, table_records, with_page
from kontor.sources.store import replace_csv
from kontor.sources.tabular import append_csv, append_reconciled, records_to_columns, scan_or_empty

# The extract layout with the request's id under a name of its own: Spark holds
# `idi` and `IDI` for one column.
PAGE, POSITION = "page", "position"
EXTRACT_COLUMNS = ["source_idi", *V.EXTRACT_COLUMNS[1:]]


def result_rows(pages: DataFrame, page: str = "page_id", names: list[str] | None = None) -> DataFrame:
    """All result pages to register rows, one column per header name, blanks missing.

    Without `names` the records are written first, so that finding the header names
    does not read the markup a second time.
    """
    records = table_records(pages, page)
    rows = records_to_columns(records if names else written(records, "records"), "record", names)
    fields = [name for name in rows.columns if name not in (page, "position")]
    return rows.withColumns({name: blank_to_null(quoted(name)) for name in fields})


def extract_requests(register: DataFrame) -> DataFrame:
    """Rows with both a link and an id, in the layout of a request: for each id its first row, by page and place."""
    place = [F.coalesce(quoted(name).try_cast("bigint"), F.lit(0)) for name in (PAGE, POSITION) if name in register.columns]
    placed = with_all(register, [V.LINK_HEADER, V.ID_HEADER]).withColumn("__place", F.array(*place, F.lit(0).cast("bigint")))
    first = first_per_key(placed, V.ID_HEADER, ["__place", V.LINK_HEADER, "Ditta"])
    return reshape(first, {"source_idi": V.ID_HEADER, "company_name": "Ditta", "url": V.LINK_HEADER})


def linked_records(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """Requests with `record`: missing without a page, a struct of NULLs from a page that could not be read."""
    return with_page(requests, "url", pages, lambda some: extract_records(some, keep=["url"]))


def failures(linked: DataFrame) -> DataFrame:
    """The requests without a readable record, and why."""
    fields = [F.col("record")[name].isNotNull() for name in linked.schema["record"].dataType.names]
    readable = F.col("record").isNotNull() & reduce(lambda a, b: a | b, fields)
    why = F.when(F.col("record").isNull(), "no page").otherwise("unreadable page")
    return linked.filter(~readable).select(*EXTRACT_COLUMNS[:3], why.alias("error"))


def extracts(requests: DataFrame, pages: DataFrame) -> DataFrame:
    """The extract record of each request; requests without a readable record are dropped."""
    return as_extracts(linked_records(requests, pages))


def as_extracts(linked: DataFrame) -> DataFrame:
    records = drop_failed(linked, "record")
    return records.select(
        *EXTRACT_COLUMNS[:3], *(F.col("record")[name].alias(name) for name in EXTRACT_COLUMNS[3:])
    )


def collect_results(spark: SparkSession, pages: DataFrame, output: str, page: str = "page_id") -> DataFrame:
    """Add the rows of result pages the list does not have yet, whose header wins; returns the list.

    Each row keeps its page and its place there, so a page read again adds nothing.
    """
    asked = pages.withColumn(page, quoted(page).cast("string"))
    done = scan_or_empty(spark, output, [PAGE]).select(quoted(PAGE).alias(page))
    rows = result_rows(not_done(asked, done, page), page).withColumnsRenamed({page: PAGE, "position": POSITION})
    rows = written(rows, "results")
    if not rows.isEmpty():
        append_reconciled(rows, output)
    return scan_or_empty(spark, output, rows.columns, strip_blanks=True)


def collect_extracts(
    spark: SparkSession, register: DataFrame, pages: DataFrame, output: str, errors: str | None = None
) -> DataFrame:
    """Add the extracts of register rows that have none yet; a second run adds nothing.  Returns all.

    Requests that fail now are written to `errors`, with the reason; the next run asks them again.
    """
    done = scan_or_empty(spark, output, EXTRACT_COLUMNS)
    open_rows = written(not_done(extract_requests(register), done, "source_idi"), "open-requests")
    if open_rows.isEmpty():
        return done
    linked = written(linked_records(open_rows, pages), "linked")
    append_csv(as_extracts(linked), output)
    if errors is not None:
        replace_csv(failures(linked), errors)
    return scan_or_empty(spark, output, EXTRACT_COLUMNS)
