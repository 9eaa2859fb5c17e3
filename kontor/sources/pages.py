"""Page tables `(page_id, url, html)` to records.

Reading the markup is the one step done in Python workers, and its output stays
inside the page's row as an array.  The readers are declared nondeterministic, which
keeps the optimiser from running them again for a filter pushed below them.  Records
are read from pages dealt over all tasks, see `dealt`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.contacts import register_id, route_blocks
from kontor.functions.links import resolve
from kontor.functions.text import as_col, fold_newlines, strip, title_fields
from kontor.sources import markup

CELL = "struct<tag:string,class:string,href:string,text:string,lines:string>"
ROWS = f"array<struct<table_no:int,row_no:int,part:string,cells:array<{CELL}>>>"
ELEMENTS = "array<struct<tag:string,id:string,class:string,href:string,text:string,spaced:string,lines:string>>"

_CELL_ARROW = pa.struct([(name, pa.string()) for name in ("tag", "class", "href", "text", "lines")])
_ROWS_ARROW = pa.list_(pa.struct([
    ("table_no", pa.int32()), ("row_no", pa.int32()), ("part", pa.string()), ("cells", pa.list_(_CELL_ARROW)),
]))
_ELEMENTS_ARROW = pa.list_(pa.struct([
    (name, pa.string()) for name in ("tag", "id", "class", "href", "text", "spaced", "lines")
]))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A folder of HTML files as a page table: the path is id and URL, a file is a page."""
    texts = spark.read.text(path, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("page_id"), F.col("_metadata.file_path").alias("url"),
                        F.col("value").alias("html"))


def dealt(pages: DataFrame, *columns: str) -> DataFrame:
    """Pages over as many tasks as an exchange has, by content.

    Markup is many times dearer to read than to move, and it packs well: one split of a
    page table, or one broadcast join, can leave a million pages to a single task.  The
    number is stated, as partitions of packed text look small enough to be put together again.
    """
    tasks = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pages.repartition(tasks, *(as_col(name) for name in columns))


def table_rows(html: Column | str) -> Column:
    """All table rows of a page; a missing page has none."""

    @F.arrow_udf(ROWS)
    def rows(pages: pa.Array) -> pa.Array:
        return pa.array((markup.table_rows(page.as_py() or "") for page in pages), type=_ROWS_ARROW)

    return rows.asNondeterministic()(as_col(html))


def elements(html: Column | str, ids: Sequence[str] = (), classes: Sequence[str] = (), links: bool = False) -> Column:
    """Elements of a page by id or class, and its links, in document order."""
    wanted_ids, wanted_classes = frozenset(ids), frozenset(classes)

    @F.arrow_udf(ELEMENTS)
    def found(pages: pa.Array) -> pa.Array:
        items = (markup.elements(page.as_py() or "", wanted_ids, wanted_classes, links) for page in pages)
        return pa.array(items, type=_ELEMENTS_ARROW)

    return found.asNondeterministic()(as_col(html))


def sheets(html: Column | str, panel: str, block: str) -> Column:
    """struct<rows, blocks> of a page read once: table rows of the panel, and the elements with the block's id."""

    @F.arrow_udf(f"struct<rows:{ROWS},blocks:{ELEMENTS}>")
    def read(pages: pa.Array) -> pa.Array:
        both = []
        for page in pages:
            parts = list(markup.tokens(page.as_py() or ""))
            both.append({
                "rows": markup.rows_of(markup.inside(parts, panel)),
                "blocks": markup.elements_of(parts, frozenset([block]), frozenset(), False),
            })
        return pa.array(both, type=pa.struct([("rows", _ROWS_ARROW), ("blocks", _ELEMENTS_ARROW)]))

    return read.asNondeterministic()(as_col(html))


def with_page(
    rows: DataFrame, url: str, pages: DataFrame, parse: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Rows with what `parse` makes of the page their URL names; NULL columns where there is no page.

    `parse` takes pages with `url, html` and keeps `url` as the first column.  Only the
    pages the rows name are moved and parsed: a semi-join on the URL comes first, at any size.
    """
    wanted = rows.select(as_col(url).alias("url")).filter(F.col("url").isNotNull()).distinct()
    found = pages.select("url", "html").join(wanted, "url", "left_semi")
    parsed = parse(dealt(found, "url", "html")).withColumnRenamed("url", "__page_url")
    return rows.join(parsed, rows[f"`{url}`"] == parsed["__page_url"], "left").drop("__page_url")


def has_class(item: Column, name: str) -> Column:
    return F.array_contains(F.split(item["class"], r"\s+"), name)


def table_records(
    pages: DataFrame, page: str = "page_id", html: str = "html",
    link_header: str = V.LINK_HEADER, id_header: str = V.ID_HEADER,
) -> DataFrame:
    """Rows of each page's first table as maps keyed by the table's header.

    A link column gives the first link of the cell, the id column the register id
    in it, other columns their text; a miss is blank text.  Cells beyond the header
    are dropped, of equal header names the last counts, a page without a table
    gives no rows.
    """
    first = F.filter("rows", lambda r: r["table_no"] == 0)
    head = F.get(F.filter(first, lambda r: r["part"] == "thead"), F.lit(0))
    names = F.transform(F.filter(head["cells"], lambda c: c["tag"] == "th"), lambda c: c["text"])
    body = F.filter(
        first, lambda r: (r["part"] == "tbody") & F.exists(r["cells"], lambda c: c["tag"] == "td")
    )
    asked = dealt(pages.select(as_col(page), as_col(html)), page, html)
    read = asked.select(as_col(page), table_rows(html).alias("rows"))
    rows = read.select(as_col(page), names.alias("names"), F.posexplode(body).alias("position", "row"))
    cells = F.filter(F.col("row.cells"), lambda c: c["tag"] == "td")

    def value(cell: Column, name: Column) -> Column:
        return F.coalesce(
            F.when(name == link_header, cell["href"]).when(name == id_header, register_id(cell["text"]))
            .otherwise(cell["text"]),
            F.lit(""),
        )

    width = F.least(F.size("names"), F.size("cells"))
    used = F.slice("names", F.lit(1), width)
    fields = F.transform(
        used,
        lambda name, i: F.struct(name.alias("key"), value(F.get(F.col("cells"), i), name).alias("value")),
    )
    last_of_name = F.filter(
        fields, lambda field, i: ~F.array_contains(F.slice(used, i + 2, width), field["key"])
    )
    return rows.withColumn("cells", cells).filter(F.size("names") > 0).select(
        as_col(page), "position", F.map_from_entries(last_of_name).alias("record")
    )


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """What `body` makes of a value worked out once; a lambda works out a column expression for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def section_rows(rows: Column, header: str) -> Column:
    """Data rows of the tables that have a header cell containing `header`, header row skipped.

    Each is a struct of table, place, whether its last cell is struck out, and cells.
    """
    tables = F.transform(
        F.filter(rows, lambda r: F.exists(r["cells"], lambda c: (c["tag"] == "th") & F.contains(c["text"], F.lit(header)))),
        lambda r: r["table_no"],
    )
    picked = bound(
        F.array_distinct(tables),
        lambda some: F.filter(rows, lambda r: F.array_contains(some, r["table_no"]) & (r["row_no"] > 0)),
    )
    return F.transform(
        picked,
        lambda r: F.struct(
            r["table_no"].alias("table_no"), r["row_no"].alias("row_no"),
            F.filter(r["cells"], lambda c: c["tag"] == "td").alias("cells"),
        ),
    )


def current_text(
    rows: Column, header: str, by: str, width: int = V.SECTION_CELLS, struck: str = V.STRUCK_CLASS
) -> Column:
    """Text of the first row, of the expected width and not struck out, under a header.

    If several tables carry the header the last one with such a row counts.
    """
    usable = F.filter(
        section_rows(rows, header),
        lambda r: (F.size(r["cells"]) == width) & ~F.contains(F.get(r["cells"], F.lit(width - 1))["class"], F.lit(struck)),
    )

    def first_of_last(found: Column) -> Column:
        last_table = F.try_element_at(found, F.lit(-1))["table_no"]
        return bound(last_table, lambda last: F.get(F.filter(found, lambda r: r["table_no"] == last), F.lit(0)))

    row = bound(usable, first_of_last)
    return fold_newlines(F.get(row["cells"], F.lit(width - 1))["lines"], by)


def extract_records(pages: DataFrame, keep: Sequence[str] = ("page_id",), html: str = "html") -> DataFrame:
    """Register extract pages to title fields, current address and current purpose.

    Headers count inside the content panel only.  A page without any of the fields has a
    record of NULLs; see `filters.drop_failed`.
    """
    read = pages.select(*keep, sheets(html, V.PANEL_ID, V.TITLE_ID).alias("sheet")).select(*keep, "sheet.*")
    title = title_fields(F.get("blocks", F.lit(0))["lines"])
    return read.withColumn("title", title).select(
        *keep,
        F.struct(
            *(F.col("title")[name].alias(name) for name in V.TITLE_FIELDS),
            current_text(F.col("rows"), V.ADDRESS_HEADER, ", ").alias("Registered_address"),
            current_text(F.col("rows"), V.PURPOSE_HEADER, " ").alias("Purpose"),
        ).alias("record"),
    )


def result_links(pages: DataFrame, base: str, link_class: str, keep: Sequence[str], html: str = "html") -> DataFrame:
    """The first element with a class on each result page, its link made absolute."""
    read = pages.select(*keep, elements(html, classes=[link_class]).alias("found"))
    href = F.get("found", F.lit(0))["href"]
    return read.select(*keep, resolve(F.lit(base), href).alias("detail_url"))


def contact_records(
    pages: DataFrame, address_class: str, contact_class: str, keep: Sequence[str], html: str = "html"
) -> DataFrame:
    """Directory detail pages to address, phone numbers, e-mail and website."""
    read = pages.select(*keep, elements(html, classes=[address_class, contact_class], links=True).alias("found"))
    address = F.get(F.filter("found", lambda e: has_class(e, address_class)), F.lit(0))["spaced"]
    blocks = F.filter(
        F.transform(F.filter("found", lambda e: has_class(e, contact_class)), lambda e: e["text"]), lambda t: t != ""
    )
    hrefs = F.transform(
        F.filter("found", lambda e: (e["tag"] == "a") & e["href"].isNotNull()), lambda e: e["href"]
    )
    return read.withColumns({"__address": address, "__route": route_blocks(blocks, hrefs)}).select(
        *keep, F.col("__address").alias("address"), "__route.phone_numbers", "__route.email", "__route.website"
    )


def page_links(html: Column | str) -> Column:
    """All link targets of a page by pattern, in order; enough where no cell structure matters."""
    return F.regexp_extract_all(as_col(html), F.lit(r'<a\s[^>]*href="([^"]*)"'), F.lit(1))


def page_title(html: Column | str) -> Column:
    """Text of the title element with its common entities decoded, closed by a semicolon or not."""
    raw = F.nullif(F.regexp_extract(as_col(html), r"<title>([^<]*)</title>", 1), F.lit(""))
    for entity, char in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "'"), ("&amp", "&")):
        raw = F.regexp_replace(raw, f"{entity};?", char)
    return strip(raw)


def visible_text(html: Column | str) -> Column:
    """Page text by pattern: scripts and styles removed, tags to blanks, white space squeezed.

    An unclosed element or tag ends with the page, so nothing is scanned twice; a `<`
    that begins no tag is text.
    """
    silent = F.regexp_replace(as_col(html), r"(?is)<(script|style)\b.*?(?:</\1>|\z)", " ")
    untagged = F.regexp_replace(silent, r"<[a-zA-Z/!?][^>]*(?:>|\z)", " ")
    return strip(F.regexp_replace(untagged, r"\s+", " "))
