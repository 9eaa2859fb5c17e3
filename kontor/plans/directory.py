"""Directory lookups: names to search URLs, result pages, detail pages, contact records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.links import search_url
from kontor.functions.text import blank_to_null, join_list
from kontor.operators.dedup import latest_per_key
from kontor.operators.joins import by_distinct_name, not_done
from kontor.operators.numbering import batches
from kontor.operators.projection import quoted, reshape
from kontor.operators.sizing import written
from kontor.sources.pages import contact_records, result_links, with_page
from kontor.sources.store import delete, exists, replace_csv
from kontor.sources.tabular import ORDINAL, append_csv, scan_or_empty

KEYS = ["Company Name", "IDI"]
# The original saves after 50 names, one after the other; here many are looked up at once.
NAMES_AT_ONCE = V.DIRECTORY_BATCH * 2_000


@dataclass(frozen=True)
class Site:
    """Where a directory is and how its pages are marked up."""

    search_base: str
    search_suffix: str
    origin: str
    link_class: str
    address_class: str
    contact_class: str


def look_up(names: DataFrame, name: str, pages: DataFrame, site: Site) -> DataFrame:
    """One record per name: search page, first result, detail page, contacts.

    A page that is missing, or has no result, leaves the fields after it NULL.  The
    names with their detail URLs are written in between, a few short columns.
    """
    asked = names.select(quoted(name), search_url(quoted(name), site.search_base, site.search_suffix).alias("search_url"))
    found = with_page(
        asked, "search_url", pages, lambda some: result_links(some, site.origin, site.link_class, keep=["url"])
    )
    found = written(found, "detail-urls")
    return with_page(
        found, "detail_url", pages,
        lambda some: contact_records(some, site.address_class, site.contact_class, keep=["url"]),
    ).select(quoted(name), "address", "phone_numbers", "email", "website", "detail_url", "search_url")


def as_listing(records: DataFrame, name: str = "Ditta", key: str = "IDI") -> DataFrame:
    """Contact records in the column layout of the listing, phones as comma text."""
    sources = [quoted(name), quoted(key), F.col("address"), join_list("phone_numbers"), F.col("email"),
               F.col("website"), F.col("detail_url"), F.col("search_url")]
    return reshape(records, dict(zip(V.DIRECTORY_COLUMNS, sources)))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """The listing's rows with their order in the files; empty if there is none yet."""
    rows = scan_or_empty(spark, path, V.DIRECTORY_COLUMNS, strip_blanks=True, ordinal=True)
    return rows if ORDINAL in rows.columns else rows.withColumn(ORDINAL, F.lit(None))


def finish(spark: SparkSession, output: str, temporary: str) -> None:
    """Put the rows of an interrupted run's unfinished output over the listing's, by name and id."""
    if not exists(spark, temporary):
        return
    both = [listing(spark, path).drop(ORDINAL) if path == output else listing(spark, path) for path in (output, temporary)]
    last = latest_per_key(both[1], KEYS, ORDINAL).drop(ORDINAL)
    replace_csv(not_done(both[0], last, KEYS).unionByName(last), output)
    delete(spark, temporary)


def run(
    spark: SparkSession, companies: DataFrame, pages: DataFrame, output: str, site: Site, temporary: str | None = None,
    chunk: int = NAMES_AT_ONCE, chunks: int | None = None,
) -> DataFrame:
    """Look up the companies without a listing and append theirs; a second run adds nothing.

    A company is a name with an id: namesakes keep their own ids and share a lookup, and a
    new id of a listed name gets a copy of that name's contacts.  The other names are looked
    up `chunk` at a time, and each chunk is saved before the next begins, so a run that
    breaks off, or stops after `chunks`, goes on where it was.  `temporary` is the unfinished
    output of an interrupted run; its records win over the finished ones.  Returns the listing.
    """
    if temporary is not None:
        finish(spark, output, temporary)
    done = listing(spark, output)
    wanted = companies.select(blank_to_null("Ditta").alias("Company Name"), "IDI").filter(quoted("Company Name").isNotNull())
    open_rows = written(not_done(wanted.distinct(), done, KEYS), "open-names")
    if not open_rows.isEmpty():
        known = latest_per_key(done, "Company Name", ORDINAL).drop(ORDINAL, "IDI")
        copies = open_rows.join(known, "Company Name").select(*(quoted(name) for name in V.DIRECTORY_COLUMNS))
        copies = written(copies, "copies")
        if not copies.isEmpty():
            append_csv(copies, output)
        rest = not_done(open_rows, known, "Company Name").withColumnRenamed("Company Name", "Ditta")
        names = written(batches(rest.select("Ditta").distinct(), ["Ditta"], chunk, "chunk"), "names")
        count = names.agg(F.max("chunk")).first()[0]
        for number in range(_rounds(count, chunks)):
            some = rest.join(names.filter(F.col("chunk") == number).select("Ditta"), "Ditta")
            fresh = by_distinct_name(some, "Ditta", lambda asked: look_up(asked, "Ditta", pages, site))
            append_csv(as_listing(fresh), output)
    return listing(spark, output).drop(ORDINAL)


def _rounds(last: int | None, chunks: int | None) -> int:
    found = 0 if last is None else last + 1
    return found if chunks is None else min(found, chunks)
