"""Joins, overlays, dedup, model tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontor.functions import sql as sql_functions
from kontor.functions.links import search_url
from kontor.operators import constraints, dedup, joins
from kontor.operators.filters import pending
from kontor.operators.reports import contact_coverage
from kontor.plans import enrichment, normalised
from kontor.session import scratch_path
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table

@query("category_contact_stats", views=("v_classified", "v_contact"), sql="""
    SELECT c."Category" AS category, count(*) AS total, count(phone_numbers) AS has_phone,
        count(email) AS has_email, count(website) AS has_website
    FROM v_classified c JOIN v_contact k ON c."IDI" = k."IDI"
    WHERE phone_numbers IS NOT NULL OR email IS NOT NULL OR website IS NOT NULL
    GROUP BY 1""")
def category_contact_stats(spark, sf):
    rows = enrichment.enriched(B.register(spark, sf), B.contact(spark, sf), B.classified(spark, sf))
    return contact_coverage(rows, "Category", "Phone Numbers", "Email", "Website").withColumnRenamed(
        "Category", "category"
    )


@query("companies_with_contacts", views=("v_contact",), sql=f"""
    SELECT c_name AS ditta, k."IDI" AS idi, phone_numbers, email, website
    FROM customer JOIN v_contact k ON k."IDI" = {B.idi_sql('c_custkey')}
    WHERE phone_numbers IS NOT NULL OR email IS NOT NULL OR website IS NOT NULL""")
def companies_with_contacts(spark, sf):
    rows = enrichment.reachable(B.register(spark, sf), B.contact(spark, sf))
    return rows.select(
        F.col("Ditta").alias("ditta"), F.col("IDI").alias("idi"), F.col("Phone Numbers").alias("phone_numbers"),
        F.col("Email").alias("email"), F.col("Website").alias("website"),
    )


@query("register_contact_left_join", sql="""
    SELECT c_custkey, l.idi, n_chars, lang
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS idi FROM customer) l
    LEFT JOIN (SELECT CASE WHEN doc_id <> 0 THEN doc_id END AS idi, n_chars, lang FROM documents) r
        ON l.idi IS NOT DISTINCT FROM r.idi""")
def register_contact_left_join(spark, sf):
    left = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("idi")
    )
    right = table(spark, sf, "documents").select(
        F.when(F.col("doc_id") != 0, F.col("doc_id")).alias("idi"), "n_chars", "lang"
    )
    return joins.left_join_null_safe(left, right, "idi")


@query("spread_contact_join", sql="""
    SELECT o_orderkey, l.idi, n_chars
    FROM (SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END AS idi FROM orders) l
    LEFT JOIN (SELECT CASE WHEN doc_id <> 0 THEN doc_id END AS idi, n_chars FROM documents) r
        ON l.idi IS NOT DISTINCT FROM r.idi""")
def spread_contact_join(spark, sf):
    """A third of the left rows lack the id: that hot key is dealt out over many tasks."""
    left = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("idi")
    )
    right = table(spark, sf, "documents").select(F.when(F.col("doc_id") != 0, F.col("doc_id")).alias("idi"), "n_chars")
    return joins.spread_join(left, right, "idi", F.col("idi").isNull())


@query("classified_left_join", views=("v_classified",), sql=f"""
    SELECT {B.idi_sql('o_custkey')} AS "IDI", o_orderkey, "Category" AS category, "Subcategory" AS subcategory
    FROM orders LEFT JOIN (SELECT * FROM v_classified JOIN documents ON doc_id = c_custkey) k
        ON k.c_custkey = o_custkey""")
def classified_left_join(spark, sf):
    """Only companies with a text were classified; the others keep NULL labels."""
    rows = table(spark, sf, "orders").select("o_orderkey", B.idi("o_custkey").alias("IDI"))
    with_text = table(spark, sf, "documents").select(B.idi("doc_id").alias("IDI"))
    done = B.classified(spark, sf).join(with_text, "IDI", "left_semi")
    return joins.merge_classes(rows, done).withColumnsRenamed({"Category": "category", "Subcategory": "subcategory"})


@query("pending_anti_join", sql="""
    SELECT doc_id, lang, source FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id) AND text IS NOT NULL""")
def pending_anti_join(spark, sf):
    rows = table(spark, sf, "documents").withColumn("label", F.lit(None).cast("string"))
    left = joins.not_done(rows, table(spark, sf, "labels"), "doc_id").filter(pending("label", "text"))
    return left.select("doc_id", "lang", "source")


@query("progress_overlay", sql="""
    SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN lang ELSE 'quality ' || quality END AS category,
        CASE WHEN l.doc_id IS NULL THEN source ELSE 'toxic ' || toxic END AS subcategory
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def progress_overlay(spark, sf):
    base = table(spark, sf, "documents").select(
        "doc_id", F.col("lang").alias("category"), F.col("source").alias("subcategory")
    )
    newer = table(spark, sf, "labels").select(
        "doc_id", F.concat(F.lit("quality "), "quality").alias("category"),
        F.concat(F.lit("toxic "), "toxic").alias("subcategory"),
    )
    return joins.overlay(base, newer, "doc_id", ["category", "subcategory"])


@query("progress_by_key", sql="""
    SELECT d.doc_id, CAST(quality AS varchar) AS category, CAST(toxic AS varchar) AS subcategory,
        l.doc_id IS NULL OR (quality = 0 AND toxic = 0) AS still_open
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def progress_by_key(spark, sf):
    from kontor.operators.filters import sentinel_pending

    done = table(spark, sf, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("category"), F.col("toxic").cast("string").alias("subcategory")
    )
    rows = joins.merge_progress(table(spark, sf, "documents").select("doc_id"), done, "doc_id", ("category", "subcategory"))
    return rows.withColumn("still_open", sentinel_pending("category", "subcategory", "0"))


@query("lookup_fanout", sql="""
    SELECT p_partkey, 'https://directory.example/s/' || replace(url_encode(p_name), '%20', '+') || '?page=1' AS search_url
    FROM part""")
def lookup_fanout(spark, sf):
    """Few names on many rows: one lookup per name, the result to every row."""
    def look_up(names):
        return names.withColumn("search_url", search_url("p_name", "https://directory.example/s/", "?page=1"))

    return joins.by_distinct_name(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", look_up).drop("p_name")


@query("lookup_fanout_texts", sql="""
    SELECT doc_id, length(text) AS chars FROM documents""")
def lookup_fanout_texts(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text")
    found = joins.by_distinct_name(rows, "text", lambda names: names.withColumn("chars", F.length("text").cast("bigint")))
    return found.select("doc_id", "chars")


LABEL_IDS = """
    v_pair AS (SELECT "Category", "Subcategory", min(ordinal) AS seen FROM v_company GROUP BY 1, 2),
    v_category AS (SELECT row_number() OVER (ORDER BY seen, "Category") AS category_id, "Category"
        FROM (SELECT "Category", min(seen) AS seen FROM v_pair GROUP BY 1)),
    v_subcategory AS (SELECT row_number() OVER (ORDER BY seen, "Category", "Subcategory") AS subcategory_id,
        category_id, "Category", "Subcategory" FROM v_pair JOIN v_category USING ("Category"))
"""


def _with_label_ids(body: str) -> str:
    heads = ",\n".join(f"{view} AS ({B.VIEWS[view]})" for view in ("v_registered", "v_company"))
    return f"WITH {heads},\n{LABEL_IDS}\n{body}"


@query("taxonomy_surrogate_ids", sql=_with_label_ids("""
    SELECT subcategory_id, category_id, "Category" AS category, "Subcategory" AS subcategory FROM v_subcategory"""))
def taxonomy_surrogate_ids(spark, sf):
    categories, subcategories = normalised.label_tables(B.company(spark, sf), "ordinal")
    return subcategories.join(categories, "category_id").select(
        "subcategory_id", "category_id", F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory")
    )


@query("company_categories", sql=_with_label_ids("""
    SELECT "IDI" AS idi, category_id, subcategory_id
    FROM v_company JOIN v_subcategory USING ("Category", "Subcategory")"""))
def company_categories(spark, sf):
    return normalised.normalise(B.company(spark, sf), "ordinal").links.withColumnRenamed("IDI", "idi")


@query("constraint_report", sql=_with_label_ids("""
    , link AS (SELECT "IDI", category_id, subcategory_id FROM v_company JOIN v_subcategory USING ("Category", "Subcategory"))
    SELECT 'pk_companies' AS "constraint", count(*) - count(DISTINCT "IDI") AS violations FROM v_company
    UNION ALL SELECT 'pk_categories', count(*) - count(DISTINCT category_id) FROM v_category
    UNION ALL SELECT 'uq_category', count(*) - count(DISTINCT "Category") FROM v_category
    UNION ALL SELECT 'pk_subcategories', count(*) - count(DISTINCT subcategory_id) FROM v_subcategory
    UNION ALL SELECT 'uq_subcategory', count(*) - count(DISTINCT (category_id, "Subcategory")) FROM v_subcategory
    UNION ALL SELECT 'pk_company_categories', count(*) - count(DISTINCT "IDI") FROM link
    UNION ALL SELECT 'fk_subcategory_category', count(*) FROM v_subcategory
        WHERE category_id NOT IN (SELECT category_id FROM v_category)
    UNION ALL SELECT 'fk_link_company', count(*) FROM link WHERE "IDI" NOT IN (SELECT "IDI" FROM v_company)
    UNION ALL SELECT 'fk_link_category', count(*) FROM link WHERE category_id NOT IN (SELECT category_id FROM v_category)
    UNION ALL SELECT 'fk_link_subcategory', count(*) FROM link
        WHERE subcategory_id NOT IN (SELECT subcategory_id FROM v_subcategory)""".strip()))
def constraint_report(spark, sf):
    """The stored model made from the register keeps all its constraints."""
    model = normalised.normalise(B.company(spark, sf), "ordinal")
    return model.stored(scratch_path(spark, "model")).report()


@query("constraint_violations", sql="""
    WITH link AS (SELECT o_custkey AS idi, o_orderkey % 7 AS category_id, o_orderkey % 30 AS subcategory_id FROM orders)
    SELECT 'pk_companies' AS "constraint", count(*) AS violations
        FROM (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'pk_categories', count(*) - count(DISTINCT r_regionkey) FROM region
    UNION ALL SELECT 'uq_category', count(*) - count(DISTINCT r_name) FROM region
    UNION ALL SELECT 'pk_subcategories', count(*) - count(DISTINCT n_nationkey) FROM nation
    UNION ALL SELECT 'uq_subcategory', count(*) FROM (SELECT n_regionkey FROM nation GROUP BY n_regionkey, n_name HAVING count(*) > 1)
    UNION ALL SELECT 'pk_company_categories', count(*) FROM (SELECT idi FROM link GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'fk_subcategory_category', count(*) FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'fk_link_company', count(*) FROM link WHERE idi NOT IN (SELECT c_nationkey FROM customer)
    UNION ALL SELECT 'fk_link_category', count(*) FROM link WHERE category_id NOT IN (SELECT r_regionkey FROM region)
    UNION ALL SELECT 'fk_link_subcategory', count(*) FROM link WHERE subcategory_id NOT IN (SELECT n_nationkey FROM nation)""")
def constraint_violations(spark, sf):
    """The same checks over tables that break them."""
    companies = table(spark, sf, "customer").select(F.col("c_nationkey").cast("bigint").alias("IDI"))
    categories = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("bigint").alias("category_id"), F.col("r_name").alias("Category")
    )
    subcategories = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("subcategory_id"), F.col("n_regionkey").cast("bigint").alias("category_id"),
        F.col("n_name").alias("Subcategory"),
    )
    links = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("IDI"), (F.col("o_orderkey") % 7).alias("category_id"),
        (F.col("o_orderkey") % 30).alias("subcategory_id"),
    )
    return constraints.model_report(companies, categories, subcategories, links)


@query("main_metadata_split", views=("v_registered", "v_company", "v_contact"), sql=r"""
    SELECT "IDI" AS idi, "Ditta" AS ditta, "Category" AS category, website, ordinal,
        CASE WHEN year(day) BETWEEN 1800 AND 2030 THEN day END AS registration_date
    FROM (SELECT c.*, k.website, CAST(try_strptime(nullif(regexp_extract("Registration_date",
            'Registered on (\d{2}\.\d{2}\.\d{4})', 1), ''), '%d.%m.%Y') AS date) AS day
        FROM v_company c LEFT JOIN v_contact k ON k."IDI" = c."IDI")""")
def main_metadata_split(spark, sf):
    """The flat model written as two tables, read back and joined on the id."""
    rows = joins.merge_contacts(B.company(spark, sf), B.contact(spark, sf)).withColumn("Address", F.lit(None).cast("string"))
    path = scratch_path(spark, "flat-model")
    enrichment.flat_model(rows).write(path)
    main, rest = spark.read.parquet(f"{path}/companies"), spark.read.parquet(f"{path}/company_metadata")
    return joins.rejoin(main, rest).select("idi", "ditta", "category", "website", "ordinal", "registration_date")


REACHABLE = """
    FROM v_company c JOIN v_contact k ON k."IDI" = c."IDI"
    WHERE phone_numbers IS NOT NULL OR email IS NOT NULL OR website IS NOT NULL"""


def _built(spark, sf):
    rows = B.company(spark, sf).drop("Category", "Subcategory")
    contacts = B.contact(spark, sf).withColumn("Address", F.lit(None).cast("string"))
    return enrichment.build(rows, contacts, B.classified(spark, sf), scratch_path(spark, "directory"))


@query("enrichment_pipeline", views=("v_registered", "v_company", "v_contact"), sql=f"""
    SELECT "Category" AS category, count(*) AS total, count(phone_numbers) AS has_phone, count(email) AS has_email,
        count(website) AS has_website {REACHABLE} GROUP BY 1""")
def enrichment_pipeline(spark, sf):
    """Register, contacts and classes to stored tables; the coverage view over them."""
    _built(spark, sf)
    return spark.table(enrichment.STATS_VIEW)


@query("load_report", views=("v_registered", "v_company", "v_contact"), sql=f"""
    SELECT unnest(['companies', 'company_metadata']) AS "table", n FROM (SELECT count(*) AS n {REACHABLE})""")
def load_report(spark, sf):
    return enrichment.load_report(_built(spark, sf))


@query("normalised_counts", views=("v_registered", "v_company"), sql="""
    SELECT 'companies' AS "table", count(DISTINCT "IDI") AS n FROM v_company
    UNION ALL SELECT 'categories', count(DISTINCT "Category") FROM v_company
    UNION ALL SELECT 'subcategories', count(DISTINCT ("Category", "Subcategory")) FROM v_company""")
def normalised_counts(spark, sf):
    """Every company twice in the flat table: the first one stays."""
    rows = B.company(spark, sf)
    later = rows.withColumns({"ordinal": F.col("ordinal") + 1_000_000_000_000, "Category": F.lit("LATER")})
    return normalised.normalise(rows.unionByName(later), "ordinal").counts()


LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query("dedup_keep_first", sql=f"""
    SELECT * FROM lineitem QUALIFY row_number() OVER (
        PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_ORDER)}) = 1""")
def dedup_keep_first(spark, sf):
    return dedup.first_per_key(table(spark, sf, "lineitem"), LINE_KEY, LINE_ORDER)


@query("dedup_report", sql="""
    SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS unique_rows,
        count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""")
def dedup_report(spark, sf):
    return dedup.dedup_report(table(spark, sf, "lineitem"), LINE_KEY)


@query("repeated_keys", sql="""
    SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def repeated_keys(spark, sf):
    return dedup.repeated_keys(table(spark, sf, "lineitem"), LINE_KEY)


@query("first_current_row", sql="""
    SELECT l_orderkey, l_shipdate AS current_date_value FROM lineitem WHERE l_returnflag <> 'R'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate) = 1""")
def first_current_row(spark, sf):
    return dedup.first_current(
        table(spark, sf, "lineitem"), "l_orderkey", ["l_linenumber", "l_shipdate"], F.col("l_returnflag") == "R",
        F.col("l_shipdate"), "current_date_value",
    )


@query("contact_report_sql", views=("v_place", "v_registered", "v_contact"), sql=f"""
    SELECT r_name AS category, year(CASE WHEN phrase LIKE 'Registered on%' AND year(day) BETWEEN 1800 AND 2030 THEN day END) AS year,
        count(*) AS total, count(phone_numbers) AS has_phone, count(email) AS has_email, count(website) AS has_website
    FROM (SELECT *, try_strptime(right(phrase, 10), '%d.%m.%Y')::DATE AS day FROM v_registered)
        JOIN customer USING (c_custkey) JOIN v_place ON n_nationkey = c_nationkey JOIN v_contact k ON k.key = c_custkey
    WHERE coalesce(phone_numbers, email, website) IS NOT NULL GROUP BY 1, 2""")
def contact_report_sql(spark, sf):
    """The report on companies with contacts as plain SQL over functions that are themselves SQL."""
    sql_functions.register(spark)
    for name, rows in {
        "report_register": B.with_phrase(B.placed(table(spark, sf, "customer"), spark, sf), spark, sf),
        "report_texts": table(spark, sf, "documents"), "report_pages": table(spark, sf, "pages"),
    }.items():
        rows.createOrReplaceTempView(name)
    return spark.sql(f"""
        WITH contact AS (
            SELECT coalesce(doc_id, page_id) AS key, join_list(phones_in_text(text, r'{B.PHONE}')) AS phone_numbers,
                first_email(text) AS email, CASE WHEN is_website(url) THEN normalise_website(url) END AS website
            FROM report_texts FULL JOIN report_pages ON page_id = doc_id
        )
        SELECT r_name AS category, year(registration_date(phrase)) AS year, count(*) AS total, count(phone_numbers) AS has_phone,
            count(email) AS has_email, count(website) AS has_website
        FROM report_register JOIN contact ON key = c_custkey
        WHERE phone_numbers IS NOT NULL OR email IS NOT NULL OR website IS NOT NULL
        GROUP BY ALL""")
