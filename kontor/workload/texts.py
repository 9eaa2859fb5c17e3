"""Scalar functions over texts, dates, contacts and links."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions import contacts, dates, links, text
from kontor.operators.reports import date_profile, value_counts
from kontor.session import scratch_path
from kontor.sources import pages, tabular
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table

STOP_SQL = ", ".join(f"'{word}'" for word in sorted(set(V.STOP_WORDS)))


def words_sql(column: str) -> str:
    letters = rf"regexp_replace(lower({column}), '[^\p{{L}}\p{{N}}_{B.SPACE_SQL}]', ' ', 'g')"
    parts = rf"string_split_regex(regexp_replace({letters}, '\p{{Nd}}+', '', 'g'), '[{B.SPACE_SQL}]+')"
    return f"list_filter({parts}, lambda w: w <> '' AND w NOT IN ({STOP_SQL}))"


# --- ids and dates ----------------------------------------------------------------
ID_TEXT_SQL = f"""CASE c_custkey % 4 WHEN 0 THEN {B.idi_sql('c_custkey')}
    WHEN 1 THEN 'No. ' || {B.idi_sql('c_custkey')} || ' (active), before CHE-000.000.001'
    WHEN 2 THEN 'CHE-12.' || c_custkey ELSE '' END"""


@query("register_id_extract", sql=rf"""
    SELECT c_custkey, nullif(regexp_extract(written, 'CHE-\d{{3}}\.\d{{3}}\.\d{{3}}'), '') AS idi,
        written <> '' AS requestable
    FROM (SELECT c_custkey, {ID_TEXT_SQL} AS written FROM customer)""")
def register_id_extract(spark, sf):
    key = F.col("c_custkey")
    written = (
        F.when(key % 4 == 0, B.idi("c_custkey"))
        .when(key % 4 == 1, F.concat(F.lit("No. "), B.idi("c_custkey"), F.lit(" (active), before CHE-000.000.001")))
        .when(key % 4 == 2, F.concat(F.lit("CHE-12."), key)).otherwise("")
    )
    return table(spark, sf, "customer").select(
        "c_custkey", contacts.register_id(written).alias("idi"),
        text.blank_to_null(written).isNotNull().alias("requestable"),
    )


DAY_SQL = r"CAST(try_strptime(nullif(regexp_extract(phrase, 'Registered on (\d{2}\.\d{2}\.\d{4})', 1), ''), '%d.%m.%Y') AS date)"


@query("registration_dates", views=("v_registered",), sql=f"""
    SELECT c_custkey, CASE WHEN year(day) BETWEEN 1800 AND 2030 THEN day END AS registered,
        CASE WHEN year(day) BETWEEN 1800 AND 2030 THEN strftime(day, '%Y-%m-%d') END AS registered_text
    FROM (SELECT c_custkey, {DAY_SQL} AS day FROM v_registered)""")
def registration_dates(spark, sf):
    dated = B.registered(spark, sf).withColumn("registered", dates.registration_date("phrase"))
    return dated.select("c_custkey", "registered", dates.iso_date("registered").alias("registered_text"))


@query("date_profile", views=("v_registered",), sql=f"""
    SELECT count(*) AS total_rows, count(day) AS valid_dates, count(*) - count(day) AS missing_dates,
        min(day) AS earliest, max(day) AS latest
    FROM (SELECT CASE WHEN year({DAY_SQL}) BETWEEN 1800 AND 2030 THEN {DAY_SQL} END AS day FROM v_registered)""")
def registration_profile(spark, sf):
    dated = B.registered(spark, sf).select(dates.registration_date("phrase").alias("day"))
    return date_profile(dated, "day")


@query("reject_split", views=("v_registered",), sql=f"""
    SELECT c_custkey, phrase, CASE WHEN year({DAY_SQL}) BETWEEN 1800 AND 2030 THEN 'valid' ELSE 'rejected' END AS part
    FROM v_registered""")
def reject_split(spark, sf):
    """Valid and rejected rows in two sinks, read back."""
    path = scratch_path(spark, "dated")
    valid = dates.registration_date("phrase").isNotNull()
    tabular.write_with_rejects(B.registered(spark, sf), valid, f"{path}/valid", f"{path}/error_valid")
    parts = [
        tabular.scan_csv(spark, f"{path}/{folder}").withColumn("part", F.lit(part))
        for folder, part in (("valid", "valid"), ("error_valid", "rejected"))
    ]
    return parts[0].unionByName(parts[1]).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


# --- contacts ---------------------------------------------------------------------
@query("phone_normalise", sql=f"""
    SELECT doc_id, len({B.PHONES_SQL}) AS phones, array_to_string({B.PHONES_SQL}, ',') AS phone_numbers FROM documents""")
def phone_normalise(spark, sf):
    found = table(spark, sf, "documents").select("doc_id", contacts.phones_in_text("text", B.PHONE).alias("found"))
    return found.select(
        "doc_id", F.size("found").cast("bigint").alias("phones"), F.array_join("found", ",").alias("phone_numbers")
    )


@query("phone_lines", sql=r"""
    SELECT conv_id, turn, regexp_replace(text, '[^\p{Nd}]', '', 'g') AS digits,
        length(regexp_replace(text, '[^\p{Nd}]', '', 'g')) = 10 AS is_phone
    FROM conversations""")
def phone_lines(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", contacts.digits("text").alias("digits"), contacts.is_phone("text").alias("is_phone")
    )


@query("email_extract_validate", sql=f"""
    WITH link AS (SELECT doc_id, nullif(regexp_extract(text, {B.EMAIL_SQL}), '') AS found,
        CASE doc_id % 3 WHEN 0 THEN 'mailto: ' || regexp_extract(text, {B.EMAIL_SQL}) || ' '
            WHEN 1 THEN 'mailto:' || source || '@' || lang || '.example.org'
            ELSE 'mailto:' || lang || '@example.org?subject=x' END AS href FROM documents)
    SELECT doc_id, found, CASE WHEN regexp_full_match(trim(replace(href, 'mailto:', '')), {B.EMAIL_SQL})
        THEN trim(replace(href, 'mailto:', '')) END AS linked FROM link""")
def email_extract_validate(spark, sf):
    kind = F.col("doc_id") % 3
    found = contacts.first_email("text")
    href = (
        F.when(kind == 0, F.concat(F.lit("mailto: "), F.coalesce("found", F.lit("")), F.lit(" ")))
        .when(kind == 1, F.concat(F.lit("mailto:"), "source", F.lit("@"), "lang", F.lit(".example.org")))
        .otherwise(F.concat(F.lit("mailto:"), "lang", F.lit("@example.org?subject=x")))
    )
    rows = table(spark, sf, "documents").withColumn("found", found)
    return rows.select("doc_id", "found", contacts.email_from_link(href).alias("linked"))


SITE_SQL = """CASE page_id % 4 WHEN 0 THEN upper(url) WHEN 1 THEN 'WWW.' || split_part(url, '//', 2)
    WHEN 2 THEN ' ' || url ELSE url || ' ' END"""


@query("website_normalise", sql=f"""
    SELECT page_id, CASE WHEN regexp_matches(lower(site), '^(www\\.|https?://)') THEN
        CASE WHEN starts_with(trim(lower(site)), 'www.') THEN 'https://' || trim(lower(site)) ELSE trim(lower(site)) END
        END AS website
    FROM (SELECT page_id, {SITE_SQL} AS site FROM pages)""".replace("\\\\", "\\"))
def website_normalise(spark, sf):
    kind = F.col("page_id") % 4
    site = (
        F.when(kind == 0, F.upper("url"))
        .when(kind == 1, F.concat(F.lit("WWW."), F.get(F.split("url", "//"), F.lit(1))))
        .when(kind == 2, F.concat(F.lit(" "), "url")).otherwise(F.concat("url", F.lit(" ")))
    )
    rows = table(spark, sf, "pages").select("page_id", site.alias("site"))
    return rows.select("page_id", F.when(contacts.is_website("site"), contacts.normalise_website("site")).alias("website"))


@query("contact_router", sql=rf"""
    WITH block AS (SELECT d.doc_id, {B.PHONES_SQL} AS phones, url, nullif(regexp_extract(text, {B.EMAIL_SQL}), '') AS email
        FROM documents d LEFT JOIN pages ON page_id = d.doc_id)
    SELECT doc_id, array_to_string(phones, ',') AS phone_numbers, lower(url) AS website, email
    FROM block WHERE url IS NULL OR length(regexp_replace(url, '\D', '', 'g')) <> 10
    UNION ALL SELECT doc_id, array_to_string(list_append(phones, regexp_replace(url, '\D', '', 'g')), ','), NULL, email
    FROM block WHERE length(regexp_replace(url, '\D', '', 'g')) = 10""")
def contact_router(spark, sf):
    """Blocks of one entity: the phones of its text as written, then its page's address."""
    texts, sites = table(spark, sf, "documents"), table(spark, sf, "pages").select("page_id", "url")
    rows = texts.join(sites, F.col("doc_id") == F.col("page_id"), "left")
    phones = F.regexp_extract_all("text", F.lit(f"({B.PHONE})"), F.lit(1))
    blocks = F.concat(phones, F.when(F.col("url").isNull(), F.array().cast("array<string>")).otherwise(F.array("url")))
    hrefs = F.array_compact(F.array(F.concat(F.lit(V.MAILTO), contacts.first_email("text"))))
    routed = rows.select("doc_id", contacts.route_blocks(blocks, hrefs).alias("r"))
    return routed.select(
        "doc_id", F.array_join("r.phone_numbers", ",").alias("phone_numbers"), "r.website", "r.email"
    )


# --- links --------------------------------------------------------------------------
@query("search_url", sql="""
    SELECT c_custkey AS key, 'https://directory.example/s/'
        || replace(url_encode(c_name || ' & ' || c_mktsegment || '* ~é/' || c_custkey), '%20', '+') || '?page=1' AS url
    FROM customer
    UNION ALL SELECT p_partkey, 'https://directory.example/s/' || replace(url_encode(p_name), '%20', '+') || '?page=1'
    FROM part""")
def search_url(spark, sf):
    name = F.concat("c_name", F.lit(" & "), "c_mktsegment", F.lit("* ~é/"), "c_custkey")
    base, suffix = "https://directory.example/s/", "?page=1"
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), links.search_url(name, base, suffix).alias("url")
    )
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), links.search_url("p_name", base, suffix).alias("url")
    )
    return customers.unionByName(parts)


LINKS_SQL = """regexp_extract_all(html, '<a\\s[^>]*href="([^"]*)"', 1)"""


@query("resolve_links", sql=rf"""
    SELECT page_id, place, href, CASE WHEN href = '' THEN NULL WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN href
        WHEN starts_with(href, '//') THEN regexp_extract(base, '^([a-z]+:)//', 1) || href
        WHEN regexp_matches(href, '^[/?#]') THEN base || href
        ELSE base || '/' || regexp_replace(href, '^(\.{{1,2}}/)+', '') END AS url
    FROM (SELECT page_id, base, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS place
        FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS base, {LINKS_SQL} AS hrefs FROM pages))""")
def resolve_links(spark, sf):
    found = table(spark, sf, "pages").select(
        "page_id", links.origin("url").alias("base"), F.posexplode(pages.page_links("html")).alias("place", "href")
    )
    return found.select(
        "page_id", (F.col("place") + 1).cast("bigint").alias("place"), "href", links.resolve("base", "href").alias("url")
    )


# --- cleaning -----------------------------------------------------------------------
@query("clean_text", sql=f"SELECT doc_id, array_to_string({words_sql('text')}, ' ') AS cleaned FROM documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.clean_text("text").alias("cleaned"))


@query("clean_token_counts", sql=f"""
    SELECT word, count(*) AS n FROM (SELECT unnest({words_sql('text')}) AS word FROM documents) GROUP BY 1""")
def clean_token_counts(spark, sf):
    found = table(spark, sf, "documents").select(F.explode(text.words("text")).alias("word"))
    return value_counts(found, "word")


@query("extract_title_fields", sql=f"""
    WITH line AS (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations)
    SELECT conv_id, turn, {', '.join(
        f"CASE WHEN len(parts) >= 3 THEN {B.strip_sql(f'parts[{i}]')} END AS {name}"
        for i, name in ((1, 'first_line'), (2, 'second_line'), (3, 'third_line')))},
        replace({B.strip_sql('array_to_string(parts, chr(10))')}, chr(10), ', ') AS folded
    FROM line""")
def extract_title_fields(spark, sf):
    names = ["first_line", "second_line", "third_line"]
    rows = table(spark, sf, "conversations").select(
        "conv_id", "turn", text.title_fields("text", names).alias("fields"), text.fold_newlines("text", ", ").alias("folded")
    )
    return rows.select("conv_id", "turn", *(F.col("fields")[name].alias(name) for name in names), "folded")


@query("list_text", sql="""
    SELECT c_custkey, len(parts) AS parts, array_to_string(parts, ',') AS joined
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN [] ELSE string_split(c_name || ',' || c_mktsegment, ',') END AS parts
        FROM customer)""")
def list_text(spark, sf):
    written = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.concat_ws(",", "c_name", "c_mktsegment"))
    rows = table(spark, sf, "customer").select("c_custkey", text.split_list(written).alias("items"))
    return rows.select(
        "c_custkey", F.size("items").cast("bigint").alias("parts"), text.text_or_empty(text.join_list("items")).alias("joined")
    )


@query("email_as_phone", sql="""
    SELECT doc_id, concat_ws('@', lpad(CAST(doc_id AS varchar), 10, '0'), 'mail.example.com') AS email FROM documents""")
def email_as_phone(spark, sf):
    """An address of ten digits before the at sign, filed as a phone, is recognised as an address."""
    address = F.concat(F.lpad(F.col("doc_id").cast("string"), 10, "0"), F.lit("@mail.example.com"))
    rows = table(spark, sf, "documents").select("doc_id", F.array(address).alias("blocks"), F.array().cast("array<string>").alias("hrefs"))
    return rows.select("doc_id", contacts.route_blocks("blocks", "hrefs").alias("r")).select("doc_id", F.col("r.email").alias("email"))


@query("percent_texts", sql="""
    SELECT c_nationkey AS nation, printf('%.1f%%', 100.0 * count(*) FILTER (c_mktsegment = 'BUILDING') / count(*)) AS share
    FROM customer GROUP BY 1""")
def percent_texts(spark, sf):
    rows = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation"))
    some = rows.agg(F.count_if(F.col("c_mktsegment") == "BUILDING").alias("part"), F.count("*").alias("whole"))
    return some.select("nation", text.percent_text(F.col("part"), F.col("whole")).alias("share"))
