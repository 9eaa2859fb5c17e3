"""Views that give the test tables the shape of register, directory and model data.

Every view exists twice: as a DataFrame function and as SQL text for the oracle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kontor.functions.contacts import first_email, phones_in_text
from kontor.functions.text import join_list
from kontor.sources.taxonomy import Taxonomy

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def with_views(sql: str, views: tuple[str, ...]) -> str:
    if not views:
        return sql
    heads = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in views)
    body = sql.strip()
    return f"WITH {heads},\n{body[4:]}" if body.startswith("WITH") else f"WITH {heads}\n{body}"


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()):
    """Register a query; `views` are put before the SQL as common table expressions."""

    def add(run: Run) -> Run:
        REGISTRY[name] = Query(run, None if sql is None else with_views(sql, views))
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# --- keys -----------------------------------------------------------------------
def idi(key: Column | str) -> Column:
    digits = F.lpad((F.col(key) if isinstance(key, str) else key).cast("string"), 9, "0")
    return F.concat(
        F.lit("CHE-"), F.substring(digits, 1, 3), F.lit("."), F.substring(digits, 4, 3), F.lit("."),
        F.substring(digits, 7, 3),
    )


def idi_sql(key: str) -> str:
    digits = f"lpad(cast({key} as varchar), 9, '0')"
    return f"'CHE-' || substr({digits}, 1, 3) || '.' || substr({digits}, 4, 3) || '.' || substr({digits}, 7, 3)"


# --- register -------------------------------------------------------------------
def placed(rows: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Rows with `c_nationkey`, plus their nation and region.

    One dimension after the other: Spark then sees each by its own file size, not
    by the estimated product of both.
    """
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    named = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return named.join(region, F.col("n_regionkey") == F.col("r_regionkey")).drop("n_nationkey", "n_regionkey", "r_regionkey")


def classified(spark: SparkSession, sf: str) -> DataFrame:
    """Id and labels of every company."""
    return placed(table(spark, sf, "customer"), spark, sf).select(
        idi("c_custkey").alias("IDI"), F.col("r_name").alias("Category"), F.col("n_name").alias("Subcategory")
    )


def with_phrase(rows: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a registration phrase: the first order's day, broken ones mixed in by key."""
    first = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("day"))
    key = F.col("c_custkey")
    phrase = (
        F.when(key % 50 == 0, "Registered on 31.02.2020").when(key % 50 == 10, "Registered on 01.01.1799")
        .when(key % 50 == 20, "Registered on 01.01.2031").when(key % 50 == 30, "Registered 5.3.1999")
        .otherwise(F.concat(F.lit("Registered on "), F.date_format("day", "dd.MM.yyyy")))
    )
    dated = rows.join(first, F.col("c_custkey") == F.col("o_custkey"), "left")
    return dated.withColumn("phrase", phrase).drop("day", "o_custkey")


def registered(spark: SparkSession, sf: str) -> DataFrame:
    return with_phrase(table(spark, sf, "customer").select("c_custkey"), spark, sf)


def company(spark: SparkSession, sf: str) -> DataFrame:
    """Register rows in the layout of the flat model, with an ordinal."""
    texts = table(spark, sf, "documents").select("doc_id", "text")
    rows = with_phrase(placed(table(spark, sf, "customer"), spark, sf), spark, sf).join(
        texts, F.col("c_custkey") == F.col("doc_id"), "left"
    )
    return rows.select(
        F.col("c_custkey").alias("ordinal"), idi("c_custkey").alias("IDI"), F.col("c_name").alias("Ditta"),
        F.col("c_mktsegment").alias("Forma giuridica"), F.col("n_name").alias("Sede"),
        F.col("phrase").alias("Registration_date"),
        F.concat("n_name", F.lit(", "), "r_name").alias("Registered_address"), F.col("text").alias("Purpose"),
        F.col("r_name").alias("Category"), F.col("n_name").alias("Subcategory"),
    )


def register(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        idi("c_custkey").alias("IDI"), F.col("c_name").alias("Ditta"), F.col("c_mktsegment").alias("Forma giuridica")
    )


# --- contacts -------------------------------------------------------------------
PHONE = r"\(\d{3}\) \d{3}-\d{4}"


def contact(spark: SparkSession, sf: str) -> DataFrame:
    """E-mail and phones from the texts, websites from the pages, by id."""
    texts = table(spark, sf, "documents").select(
        F.col("doc_id").alias("key"), join_list(phones_in_text("text", PHONE)).alias("Phone Numbers"),
        first_email("text").alias("Email"),
    )
    sites = table(spark, sf, "pages").select(F.col("page_id").alias("key"), F.col("url").alias("Website"))
    return texts.join(sites, "key", "full").select(idi("key").alias("IDI"), "Phone Numbers", "Email", "Website")


# --- taxonomy and model data ----------------------------------------------------
def nested_taxonomy(spark: SparkSession, sf: str) -> DataFrame:
    """Regions with their nations as one nested document; its size is that of a fixed dimension."""
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    lists = places.groupBy("r_name").agg(F.array_sort(F.collect_list("n_name")).alias("names"))
    entry = F.struct(F.col("r_name").alias("category"), F.col("names").alias("subcategories"))
    return lists.agg(F.array_sort(F.collect_list(entry)).alias("categories"))


def taxonomy(spark: SparkSession, sf: str) -> Taxonomy:
    return Taxonomy.from_nested(nested_taxonomy(spark, sf))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """A model reply per company, good and bad ones mixed by key."""
    rows = placed(table(spark, sf, "customer"), spark, sf)
    kind = F.col("c_custkey") % 7
    good = F.concat(F.lit("Category: "), "r_name", F.lit("\nSubcategory: "), "n_name")
    text = (
        F.when(kind == 0, good)
        .when(kind == 1, F.concat(F.lit("Category: "), "r_name"))
        .when(kind == 2, F.concat(F.lit("Category: ATLANTIS\nSubcategory: "), "n_name"))
        .when(kind == 3, F.concat(F.lit("Category: "), "r_name", F.lit("\nSubcategory: NOWHERE")))
        .when(kind == 4, F.concat(F.lit("Category: "), "r_name", F.lit(": rest\nSubcategory: "), "n_name"))
        .when(kind == 5, F.concat(F.lit("Category: "), "r_name", F.lit("\n \nSubcategory: "), "n_name"))
        .otherwise(F.concat(F.lit(" \n Category:  "), "r_name", F.lit("  \n  Subcategory:  "), "n_name", F.lit(" \n")))
    )
    return rows.select(F.col("c_custkey").alias("entity"), F.col("r_name"), F.col("n_name"), text.alias("text"))


def event_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Score table in long form: each user's share of events by type, an exact ratio."""
    events = table(spark, sf, "events")
    per_type = events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("user_id"))
    return per_type.select(
        F.col("user_id").alias("entity"), F.col("event_type").alias("label"), (F.col("n") / whole).alias("score")
    )


# --- the same in SQL --------------------------------------------------------------
EMAIL_SQL = r"'[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}'"
PHONES_SQL = (
    r"list_transform(regexp_extract_all(text, '\(\d{3}\) \d{3}-\d{4}'), "
    r"lambda p: regexp_replace(p, '\D', '', 'g'))"
)
SPACE_SQL = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"


def strip_sql(text: str) -> str:
    return rf"regexp_replace(regexp_replace({text}, '^[{SPACE_SQL}]+', ''), '[{SPACE_SQL}]+$', '')"


VIEWS = {
    "v_place": "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey",
    "v_classified": f"""
        SELECT {idi_sql('c_custkey')} AS "IDI", r_name AS "Category", n_name AS "Subcategory", c_custkey
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "v_registered": """
        SELECT c_custkey,
            CASE c_custkey % 50 WHEN 0 THEN 'Registered on 31.02.2020' WHEN 10 THEN 'Registered on 01.01.1799'
                WHEN 20 THEN 'Registered on 01.01.2031' WHEN 30 THEN 'Registered 5.3.1999'
                ELSE 'Registered on ' || strftime(day, '%d.%m.%Y') END AS phrase
        FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS day FROM orders GROUP BY 1)
            ON o_custkey = c_custkey""",
    "v_company": f"""
        SELECT c_custkey AS ordinal, {idi_sql('c_custkey')} AS "IDI", c_name AS "Ditta",
            c_mktsegment AS "Forma giuridica", n_name AS "Sede", phrase AS "Registration_date",
            n_name || ', ' || r_name AS "Registered_address", text AS "Purpose",
            r_name AS "Category", n_name AS "Subcategory"
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            JOIN v_registered USING (c_custkey) LEFT JOIN documents ON doc_id = c_custkey""",
    "v_contact": f"""
        SELECT {idi_sql('coalesce(doc_id, page_id)')} AS "IDI", coalesce(doc_id, page_id) AS key,
            nullif(array_to_string({PHONES_SQL}, ','), '') AS phone_numbers,
            nullif(regexp_extract(text, {EMAIL_SQL}), '') AS email, url AS website
        FROM documents FULL JOIN pages ON page_id = doc_id""",
    "v_response": r"""
        SELECT c_custkey AS entity, r_name, n_name,
            CASE c_custkey % 7
                WHEN 0 THEN 'Category: ' || r_name || chr(10) || 'Subcategory: ' || n_name
                WHEN 1 THEN 'Category: ' || r_name
                WHEN 2 THEN 'Category: ATLANTIS' || chr(10) || 'Subcategory: ' || n_name
                WHEN 3 THEN 'Category: ' || r_name || chr(10) || 'Subcategory: NOWHERE'
                WHEN 4 THEN 'Category: ' || r_name || ': rest' || chr(10) || 'Subcategory: ' || n_name
                WHEN 5 THEN 'Category: ' || r_name || chr(10) || ' ' || chr(10) || 'Subcategory: ' || n_name
                ELSE ' ' || chr(10) || ' Category:  ' || r_name || '  ' || chr(10) || '  Subcategory:  ' || n_name
                    || ' ' || chr(10) END AS text
        FROM customer JOIN v_place ON c_nationkey = n_nationkey""",
    "v_share": """
        SELECT user_id AS entity, event_type AS label, n / sum(n) OVER (PARTITION BY user_id) AS score
        FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)""",
    "v_taxonomy_text": """
        SELECT string_agg(chr(10) || r_name || ':' || chr(10) || subs || chr(10), '' ORDER BY r_name) AS taxonomy,
            string_agg(r_name, ', ' ORDER BY r_name) AS categories
        FROM (SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS subs FROM v_place GROUP BY 1)""",
}
