"""Counts, shares, coverage and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from kontor.operators import reports
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table


@query("value_counts_top10", sql="""
    SELECT source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY n DESC, source LIMIT 10""")
def value_counts_top10(spark, sf):
    return reports.top_values(table(spark, sf, "documents"), "source", 10)


@query("value_counts", sql="SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf):
    return reports.value_counts(table(spark, sf, "orders"), "o_custkey")


@query("category_distribution", sql="""
    SELECT quality, count(*) AS n, count(*) / sum(count(*)) OVER () * 100 AS percent
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1""")
def category_distribution(spark, sf):
    """The missing label is a group of its own here, unlike in `value_counts`."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return reports.by_count(reports.distribution(rows, "quality"), "quality")


@query("two_level_distribution", views=("v_place",), sql="""
    WITH pair AS (SELECT r_name AS category, CASE WHEN doc_id IS NULL THEN NULL ELSE n_name END AS subcategory, count(*) AS n
        FROM customer JOIN v_place ON n_nationkey = c_nationkey LEFT JOIN labels ON doc_id = c_custkey GROUP BY 1, 2)
    SELECT 1 AS level, category, NULL AS subcategory, CAST(sum(n) AS bigint) AS n, sum(n) / sum(sum(n)) OVER () * 100 AS percent
    FROM pair GROUP BY category
    UNION ALL SELECT 2, category, subcategory, n, n / whole * 100
    FROM (SELECT *, sum(n) OVER (PARTITION BY category) AS whole FROM pair) WHERE subcategory IS NOT NULL""")
def two_level_distribution(spark, sf):
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    rows = rows.join(table(spark, sf, "labels"), F.col("doc_id") == F.col("c_custkey"), "left")
    labelled = rows.select(
        F.col("r_name").alias("category"), F.when(F.col("doc_id").isNotNull(), F.col("n_name")).alias("subcategory")
    )
    return reports.two_level_distribution(labelled, "category", "subcategory")


@query("distribution_subtotals", views=("v_place",), sql="""
    SELECT r_name AS category, n_name AS subcategory, count(*) AS n, CAST(grouping(r_name, n_name) AS integer) AS grouping
    FROM customer JOIN v_place ON n_nationkey = c_nationkey GROUP BY ROLLUP (r_name, n_name)""")
def distribution_subtotals(spark, sf):
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    return reports.subtotals(
        rows.select(F.col("r_name").alias("category"), F.col("n_name").alias("subcategory")), "category", "subcategory"
    )


@query("null_profile", sql="""
    WITH one AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id) LEFT JOIN pages ON page_id = doc_id)
    SELECT 'text' AS "column", count(*) AS total, count(text) AS present, count(*) - count(text) AS missing FROM one
    UNION ALL SELECT 'quality', count(*), count(quality), count(*) - count(quality) FROM one
    UNION ALL SELECT 'url', count(*), count(url), count(*) - count(url) FROM one""")
def null_profile(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").join(
        table(spark, sf, "pages"), F.col("page_id") == F.col("doc_id"), "left"
    )
    return reports.null_profile(rows, ["text", "quality", "url"])


@query("progress_counts", sql="""
    SELECT count(*) AS total_rows, count(quality) AS processed, count(*) - count(quality) AS remaining
    FROM documents LEFT JOIN labels USING (doc_id)""")
def progress_counts(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return reports.progress_counts(rows, F.col("quality").isNull())


@query("first_n_by_order", sql="SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def first_n_by_order(spark, sf):
    return reports.first_rows(table(spark, sf, "orders"), ["o_orderdate", "o_orderkey"], 100)


@query("contact_coverage", views=("v_contact",), sql="""
    SELECT c_mktsegment AS segment, count(*) AS total, count(phone_numbers) AS has_phone, count(email) AS has_email,
        count(website) AS has_website
    FROM customer LEFT JOIN v_contact ON key = c_custkey GROUP BY 1""")
def contact_coverage(spark, sf):
    """Coverage over all companies, those without any contact included."""
    from kontor.operators.joins import merge_contacts

    rows = merge_contacts(B.register(spark, sf), B.contact(spark, sf)).withColumnRenamed("Forma giuridica", "segment")
    return reports.contact_coverage(rows, "segment", "Phone Numbers", "Email", "Website")


@query("distinct_pairs", sql="SELECT DISTINCT source, lang FROM documents")
def distinct_pairs(spark, sf):
    return table(spark, sf, "documents").select("source", "lang").distinct()


@query("record_keys", sql="""SELECT DISTINCT unnest(json_keys(props)) AS key FROM events""")
def record_keys(spark, sf):
    """All keys that occur in a map column."""
    rows = table(spark, sf, "events").select(F.from_json("props", "map<string,string>").alias("record"))
    return reports.key_set(rows, "record")
