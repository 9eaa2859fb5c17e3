"""Page tables to records."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.links import search_url
from kontor.operators import numbering, reports
from kontor.operators.sizing import written
from kontor.plans import directory, register
from kontor.session import scratch_path
from kontor.sources import pages, tabular
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table
from kontor.workload.texts import LINKS_SQL


def _decoded(text: str) -> str:
    for entity, char in (("&lt", "<"), ("&gt", ">"), ("&quot", '"'), ("&#39", "''"), ("&amp", "&")):
        text = f"regexp_replace({text}, '{entity};?', '{char}', 'g')"
    return text


@query("page_titles", sql=f"""
    SELECT page_id, {B.strip_sql(_decoded("nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '')"))} AS title
    FROM pages""")
def page_titles(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.page_title("html").alias("title"))


@query("page_titles_parsed", sql=f"""
    SELECT page_id, {B.strip_sql(_decoded("regexp_extract(html, '<h1[^>]*>([^<]*)', 1)"))} AS heading,
        len({LINKS_SQL}) AS links
    FROM pages""")
def page_titles_parsed(spark, sf):
    """The markup reader against patterns: headings by class or id would be the same call."""
    found = table(spark, sf, "pages").select(
        "page_id", F.regexp_replace("html", "<h1", '<h1 id="head"').alias("html")
    ).select("page_id", pages.elements("html", ids=["head"], links=True).alias("found"))
    return found.select(
        "page_id",
        F.coalesce(F.get(F.filter("found", lambda e: e["id"] == "head"), F.lit(0))["text"], F.lit("")).alias("heading"),
        F.size(F.filter("found", lambda e: e["href"].isNotNull())).cast("bigint").alias("links"),
    )


@query("page_links", sql=f"SELECT page_id, unnest({LINKS_SQL}) AS href FROM pages")
def page_links(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.explode(pages.page_links("html")).alias("href"))


@query("page_text", sql=rf"""
    SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html,
        '(?is)<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)', ' ', 'g'), '<[a-zA-Z/!?][^>]*(?:>|\z)', ' ', 'g'),
        '[\s\x0b]+', ' ', 'g')) AS visible
    FROM pages""")
def page_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", pages.visible_text("html").alias("visible"))


@query("page_link_counts", sql=f"""
    SELECT page_id, found, CAST(sum(found) OVER (ORDER BY page_id) AS bigint) AS found_so_far
    FROM (SELECT page_id, len({LINKS_SQL}) AS found FROM pages)""")
def page_link_counts(spark, sf):
    links = table(spark, sf, "pages").select("page_id", F.explode_outer(pages.page_links("html")).alias("href"))
    return numbering.running_total(reports.items_per_page(links, "page_id", "href"), ["page_id"], "found", "found_so_far")


# --- register pages made from the tables -------------------------------------------
def result_pages(spark, sf):
    """One result page per customer: header, the company's row, a row without an id, an unusable row."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    html = F.concat(
        F.lit("<html><script>var t='<table>';</script><table><thead><tr><th>Ditta</th><th> IDI </th>"
              "<th>Estratto cantonale</th><th>Sede</th></tr></thead><tbody><tr><td> "),
        "c_name", F.lit(" </td><td>No. "), B.idi("c_custkey"),
        F.lit(' (active)</td><td><a href="https://register.example/e/'), "c_custkey",
        F.lit('">open</a></td><td><b>'), "n_name",
        F.lit("</b></td><td>too many</td></tr><tr><td>Branch &amp; Co "), "c_custkey",
        F.lit("<td>none<td>no link<td></tr></tbody></table><table><thead><tr><th>x</th></tr></thead></table></html>"),
    )
    return rows.select(F.col("c_custkey").alias("page_id"), html.alias("html"))


@query("page_table_records", views=("v_place",), sql=f"""
    SELECT c_custkey AS page_id, 0 AS position, c_name AS ditta, {B.idi_sql('c_custkey')} AS idi,
        'https://register.example/e/' || c_custkey AS link, n_name AS sede
    FROM customer JOIN v_place ON c_nationkey = n_nationkey
    UNION ALL SELECT c_custkey, 1, 'Branch & Co ' || c_custkey, NULL, NULL, NULL FROM customer""")
def page_table_records(spark, sf):
    rows = register.result_rows(result_pages(spark, sf), names=["Ditta", "IDI", "Estratto cantonale", "Sede"])
    return rows.select(
        "page_id", "position", F.col("Ditta").alias("ditta"), F.col("IDI").alias("idi"),
        F.col("Estratto cantonale").alias("link"), F.col("Sede").alias("sede"),
    )


def extract_pages(spark, sf):
    """One extract page per customer, with struck rows and rows of the wrong width; every fifth unreadable."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    full = F.concat(
        F.lit('<div id="Titel">'), "c_name", F.lit("<br>"), "c_mktsegment", F.lit("<br/>"), "n_name", F.lit("<br>"),
        B.idi("c_custkey"), F.lit('<br>Registered on 01.02.1999</div><div id="idAuszugForm:auszugContentPanel">'
        '<table><tr><th>In</th><th>Out</th><th>Registered address</th></tr>'
        '<tr><td>1</td><td>2</td><td class="x strike">old</td></tr><tr><td>1</td><td>short</td></tr>'
        "<tr><td>3</td><td></td><td>Street 1<br>"), "r_name",
        F.lit("</td></tr><tr><td>4</td><td></td><td>later</td></tr></table><table><tr><th>In</th><th>Out</th>"
              "<th>Purpose</th></tr><tr><td>1</td><td></td><td>Trade of <i>"), "c_mktsegment",
        F.lit("</i><br>and more</td></tr></table></div>"),
    )
    readable = F.col("c_custkey") % 5 != 0
    return rows.select(
        F.concat(F.lit("https://register.example/e/"), "c_custkey").alias("url"),
        F.when(readable, full).otherwise("<html>busy</html>").alias("html"),
    )


@query("register_pipeline", views=("v_place",), sql=f"""
    SELECT {B.idi_sql('c_custkey')} AS idi, c_name AS ditta, c_mktsegment AS form, n_name AS sede,
        'Registered on 01.02.1999' AS registered, 'Street 1, ' || r_name AS address,
        'Trade of ' || c_mktsegment || ' and more' AS purpose
    FROM customer JOIN v_place ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0""")
def register_pipeline(spark, sf):
    """Result pages to a register list to extract records; the second run finds all of it done."""
    return _extracts(spark, sf, 1)


def _extracts(spark, sf, runs):
    listing, output = scratch_path(spark, "register"), scratch_path(spark, "extracts")
    for _ in range(runs):
        found = register.collect_results(spark, result_pages(spark, sf), listing)
    sheets = extract_pages(spark, sf)
    for _ in range(2):
        records = register.collect_extracts(spark, found, sheets, output)
    return records.select(
        F.col("source_idi").alias("idi"), F.col("Ditta").alias("ditta"), F.col("Forma giuridica").alias("form"),
        F.col("Sede").alias("sede"), F.col("Registration_date").alias("registered"),
        F.col("Registered_address").alias("address"), F.col("Purpose").alias("purpose"),
    )


# --- directory pages made from the tables ------------------------------------------
SITE = directory.Site(
    "https://directory.example/s/", "?page=1", "https://directory.example", "hit", "place", "contact"
)


def directory_pages(spark, sf):
    """A search page per company, and a detail page with the company's contacts."""
    names = table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    contacts = B.contact(spark, sf)
    rows = names.join(contacts, B.idi("c_custkey") == contacts["IDI"], "left")
    blank = F.lit("")
    search = rows.select(
        search_url("c_name", SITE.search_base, SITE.search_suffix).alias("url"),
        F.concat(F.lit('<ul><li class="ad">x</li><a class="big hit" href="/d/'), "c_custkey", F.lit('">hit</a>'
                 '<a class="hit" href="/d/none">second</a></ul>')).alias("html"),
    )
    detail = rows.select(
        F.concat(F.lit("https://directory.example/d/"), "c_custkey").alias("url"),
        F.concat(
            F.lit('<div class="place"><span>Street 1</span> <span> '), "c_mktsegment", F.lit("</span></div>"),
            F.coalesce(F.array_join(F.transform(
                F.split("Phone Numbers", ","),
                lambda p: F.concat(F.lit('<p class="contact info">'), F.substring(p, 1, 3), F.lit(" <b>"), F.substring(p, 4, 9), F.lit("</b></p>")),
            ), ""), blank),
            F.coalesce(F.concat(F.lit('<p class="contact">www.old.example</p><p class="contact">'),
                                F.regexp_replace("Website", "[0-9]", "x"), F.lit("</p>")), blank),
            F.coalesce(F.concat(F.lit('<a href="mailto:'), "Email", F.lit('">write</a>')), blank),
        ).alias("html"),
    )
    return search.unionByName(detail)


@query("directory_pipeline", views=("v_contact",), sql=f"""
    SELECT c_name AS name, {B.idi_sql('c_custkey')} AS idi, 'Street 1 ' || c_mktsegment AS address,
        phone_numbers, email, lower(regexp_replace(website, '[0-9]', 'x', 'g')) AS website,
        'https://directory.example/d/' || c_custkey AS detail_url,
        'https://directory.example/s/' || url_encode(c_name) || '?page=1' AS search_url
    FROM customer LEFT JOIN v_contact k ON k."IDI" = {B.idi_sql('c_custkey')}""")
def directory_pipeline(spark, sf):
    """Names to search pages to detail pages to a listing; the second run finds all of it done."""
    output = scratch_path(spark, "listing")
    found = written(directory_pages(spark, sf), "pages")
    directory.run(spark, B.register(spark, sf), found, output, SITE)
    listing = directory.run(spark, B.register(spark, sf), found, output, SITE)
    names = dict(zip(V.DIRECTORY_COLUMNS, [
        "name", "idi", "address", "phone_numbers", "email", "website", "detail_url", "search_url"]))
    return listing.withColumnsRenamed(names)


REGISTER_SQL = f"""
    SELECT {B.idi_sql('c_custkey')} AS idi, c_name AS ditta, c_mktsegment AS form, n_name AS sede,
        'Registered on 01.02.1999' AS registered, 'Street 1, ' || r_name AS address,
        'Trade of ' || c_mktsegment || ' and more' AS purpose
    FROM customer JOIN v_place ON c_nationkey = n_nationkey WHERE c_custkey % 5 <> 0"""


@query("register_rerun", views=("v_place",), sql=REGISTER_SQL)
def register_rerun(spark, sf):
    """The result pages collected twice: no row and no extract is doubled."""
    return _extracts(spark, sf, 2)


@query("directory_chunks", views=("v_contact",), sql=f"""
    SELECT c_name AS name, {B.idi_sql('c_custkey')} AS idi, phone_numbers, email
    FROM customer LEFT JOIN v_contact k ON k."IDI" = {B.idi_sql('c_custkey')}""")
def directory_chunks(spark, sf):
    """A run broken off after the first of three chunks, and started again."""
    output = scratch_path(spark, "listing")
    names = B.register(spark, sf)
    found = written(directory_pages(spark, sf), "pages")
    third = -(-names.count() // 3)
    directory.run(spark, names, found, output, SITE, chunk=third, chunks=1)
    listing = directory.run(spark, names, found, output, SITE, chunk=third)
    return listing.select(
        F.col("Company Name").alias("name"), F.col("IDI").alias("idi"), F.col("Phone Numbers").alias("phone_numbers"),
        F.col("Email").alias("email"),
    )


@query("directory_resume", sql=f"""
    SELECT 'Firm ' || c_custkey // 15 AS name, {B.idi_sql('c_custkey')} AS idi,
        'https://directory.example/d/' || c_custkey // 15 AS detail_url FROM customer""")
def directory_resume(spark, sf):
    """Namesakes keep their own ids over an interrupted run, and new ids of known names get a row."""
    output, temporary = scratch_path(spark, "listing"), scratch_path(spark, "unfinished")
    number = F.expr("c_custkey div 15").cast("string")
    firms = table(spark, sf, "customer").select(F.concat(F.lit("Firm "), number).alias("Ditta"), B.idi("c_custkey").alias("IDI"), "c_custkey")
    names = firms.select("Ditta").distinct()
    search = names.select(
        search_url("Ditta", SITE.search_base, SITE.search_suffix).alias("url"),
        F.concat(F.lit('<a class="hit" href="/d/'), F.substring("Ditta", 6, 9), F.lit('">hit</a>')).alias("html"),
    )
    found = written(search, "pages")
    directory.run(spark, firms.filter(F.col("c_custkey") % 3 == 0), found, output, SITE)
    unfinished = directory.listing(spark, output).drop("ordinal")
    tabular.write_csv(unfinished, temporary)
    listing = directory.run(spark, firms, found, output, SITE, temporary)
    return listing.select(
        F.col("Company Name").alias("name"), F.col("IDI").alias("idi"), F.col("Detail URL").alias("detail_url")
    )


@query("pages_from_files", sql="SELECT count(*) AS pages, CAST(sum(length(html)) AS bigint) AS chars FROM pages")
def pages_from_files(spark, sf):
    """Every page as a text file of its own partition folder, read as whole texts."""
    path = scratch_path(spark, "files")
    rows = table(spark, sf, "pages").select("page_id", F.regexp_replace("html", "[\\r\\n]", " ").alias("value"))
    rows.withColumn("bucket", F.col("page_id") % 4).select("bucket", "value").write.partitionBy("bucket").text(path)
    read = pages.read_pages(spark, f"{path}/*/*.txt")
    lines = read.select(F.explode(F.split("html", "\n")).alias("line")).filter("line <> ''")
    return lines.agg(F.count("*").alias("pages"), F.sum(F.length("line")).alias("chars"))


@query("extract_errors", sql=f"""
    SELECT {B.idi_sql('c_custkey')} AS idi, c_name AS company,
        CASE WHEN c_custkey % 7 = 0 THEN 'no page' ELSE 'unreadable page' END AS error
    FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 7 = 0""")
def extract_errors(spark, sf):
    """Every fifth page is unreadable and every seventh is missing: both are kept, with the reason."""
    listing, output, errors = (scratch_path(spark, name) for name in ("register", "extracts", "errors"))
    found = register.collect_results(spark, result_pages(spark, sf), listing)
    number = F.regexp_extract("url", "(\\d+)$", 1).cast("bigint")
    register.collect_extracts(spark, found, extract_pages(spark, sf).filter(number % 7 != 0), output, errors)
    return tabular.scan_csv(spark, errors).select(
        F.col("source_idi").alias("idi"), F.col("company_name").alias("company"), "error"
    )
