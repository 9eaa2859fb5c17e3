"""Sinks, rewrites, and incremental runs; each returns what a reader finds afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.operators.projection import pick
from kontor.plans import cleanup, enrichment, normalised
from kontor.plans.coverage import MaintainedCoverage
from kontor.session import scratch_path
from kontor.sources import store, tabular
from kontor.sources.taxonomy import Taxonomy
from kontor.sources.versions import VersionedTable
from kontor.streaming import incremental
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table


@query("csv_roundtrip", views=("v_registered", "v_company"), sql="""
    SELECT "IDI" AS idi, "Ditta" AS ditta, "Registration_date" AS registered, "Purpose" AS purpose,
        CASE WHEN ordinal % 4 = 0 THEN NULL ELSE "Sede" END AS sede
    FROM v_company""")
def csv_roundtrip(spark, sf):
    """Every row written twice with two more columns, then both clean-ups in place, then a scan."""
    rows = B.company(spark, sf).select(
        B.idi("ordinal").alias("idi_source"), F.col("Ditta").alias("company_name"), "IDI", "Ditta",
        F.when(F.col("ordinal") % 4 == 0, "NA").otherwise(F.col("Sede")).alias("Sede"), "Registration_date", "Purpose",
    )
    path = scratch_path(spark, "register")
    tabular.write_csv(rows.unionByName(rows), path)
    cleanup.remove_duplicates(spark, path)
    cleanup.drop_columns(spark, path, columns=("idi_source", "company_name"))
    return tabular.scan_csv(spark, path).select(
        F.col("IDI").alias("idi"), F.col("Ditta").alias("ditta"), F.col("Registration_date").alias("registered"),
        F.col("Purpose").alias("purpose"), F.col("Sede").alias("sede"),
    )


@query("append_reconcile", sql="""
    SELECT c_name AS name, CAST(c_custkey AS varchar) AS key, c_mktsegment AS segment FROM customer
    UNION ALL SELECT p_name, CAST(p_partkey AS varchar), NULL FROM part""")
def append_reconcile(spark, sf):
    """Map records written with the union of their keys, then rows with other columns under the same header."""
    path = scratch_path(spark, "results")
    entries = F.create_map(F.lit("name"), "c_name", F.lit("key"), F.col("c_custkey").cast("string"), F.lit("segment"), "c_mktsegment")
    records = table(spark, sf, "customer").select(entries.alias("record"))
    tabular.append_reconciled(tabular.records_to_columns(records, "record"), path)
    more = table(spark, sf, "part").select(
        F.col("p_brand").alias("extra"), F.col("p_partkey").cast("string").alias("key"), F.col("p_name").alias("name")
    )
    tabular.append_reconciled(more, path)
    return tabular.scan_csv(spark, path)


@query("table_layout", views=("v_registered", "v_company", "v_contact"), sql="""
    SELECT "Category" AS category, c."IDI" AS idi, phone_numbers, email, website FROM v_company c JOIN v_contact k ON k."IDI" = c."IDI"
    WHERE phone_numbers IS NOT NULL OR email IS NOT NULL OR website IS NOT NULL""")
def table_layout(spark, sf):
    """A company table split by category and sorted by id, read through the contact view."""
    from kontor.operators.joins import merge_contacts

    rows = merge_contacts(B.company(spark, sf), B.contact(spark, sf)).withColumn("Address", F.lit(None).cast("string"))
    path = scratch_path(spark, "companies")
    main = enrichment.flat_model(rows).companies
    store.write_table(main, path, partition_by=["category"], sort_by=["idi"])
    stored = enrichment.Directory(spark.read.schema(main.schema).parquet(path), main)
    stored.register_views()
    return spark.table(enrichment.CONTACTS_VIEW).select("category", "idi", "phone_numbers", "email", "website")


def _events(spark, sf):
    # A glob, so that one file and a folder of files are both found.
    schema = table(spark, sf, "events").schema
    return incremental.file_stream(spark, f"{sf}/events.parquet*", schema)


@query("incremental_append", sql="SELECT event_id, user_id, event_type FROM events")
def incremental_append(spark, sf):
    """A stream appended to a table; the second start finds nothing new."""
    target, checkpoint = scratch_path(spark, "appended"), scratch_path(spark, "progress")
    for _ in range(2):
        incremental.append(_events(spark, sf).select("event_id", "user_id", "event_type"), target, checkpoint)
    return spark.read.parquet(target)


@query("incremental_upsert", sql="""
    SELECT user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def incremental_upsert(spark, sf):
    """The latest event per user; the same batch replayed and the fold change nothing."""
    target, checkpoint = scratch_path(spark, "latest"), scratch_path(spark, "progress")
    kept = incremental.upsert(_events(spark, sf), target, checkpoint, ["user_id"], ["ts", "event_id"])
    kept.upsert(table(spark, sf, "events"), 0)
    kept.compact()
    kept.upsert(table(spark, sf, "events").filter(F.col("event_type") == "click"), 0)
    return kept.current().select("user_id", "event_id", "event_type", "value")


@query("insert_absent", sql="""
    SELECT event_type, user_id, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id) = 1""")
def insert_absent(spark, sf):
    path = scratch_path(spark, "firsts")
    rows = table(spark, sf, "events").select("event_type", "user_id", "event_id")
    for _ in range(2):
        store.insert_absent(rows, path, ["event_type", "user_id"], ["event_id"])
    return spark.read.parquet(path)


@query("stream_first_of_key", sql="SELECT DISTINCT user_id FROM events")
def stream_first_of_key(spark, sf):
    target, checkpoint = scratch_path(spark, "names"), scratch_path(spark, "progress")
    names = incremental.first_of_key(_events(spark, sf).select("user_id"), ["user_id"])
    incremental.append(names, target, checkpoint)
    return spark.read.parquet(target)


@query("table_replace", sql="""
    SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey + 1000000000, c_name FROM customer""")
def table_replace(spark, sf):
    """A table rewritten from itself."""
    path = scratch_path(spark, "names")
    store.replace_parquet(table(spark, sf, "customer").select("c_custkey", "c_name"), path)
    old = spark.read.parquet(path)
    store.replace_parquet(old.unionByName(old.withColumn("c_custkey", F.col("c_custkey") + 1_000_000_000)), path)
    return spark.read.parquet(path)


@query("upsert_two_sources", sql="""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_two_sources(spark, sf):
    """Clicks from one run, folded, then the other events from a run that counts from 0 again, folded once more."""
    events = table(spark, sf, "events")
    kept = VersionedTable(spark, scratch_path(spark, "latest"), ["user_id"], ["ts", "event_id"], events.schema)
    for run, rows in (("clicks", events.filter("event_type = 'click'")), ("rest", events.filter("event_type <> 'click'"))):
        for batch in range(2):
            kept.upsert(rows.filter(F.col("event_id") % 2 == batch), batch, run)
        kept.compact()
    return kept.current().select("user_id", "event_id", "event_type")


@query("upsert_broken_off", sql="""
    SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def upsert_broken_off(spark, sf):
    """The second of three batches breaks off, everything is folded, then the batch comes again."""
    events = table(spark, sf, "events")
    kept = VersionedTable(spark, scratch_path(spark, "latest"), ["user_id"], ["ts", "event_id"], events.schema)
    parts = [events.filter(F.col("event_id") % 3 == part) for part in range(3)]
    kept.upsert(parts[0], 0)
    store.make_folder(spark, f"{kept.path}/version=000000000002.run.1/_temporary")
    kept.upsert(parts[2], 2)
    kept.compact()
    kept.upsert(parts[1], 1, "run")
    return kept.current().select("user_id", "event_id", "event_type")


@query("stream_in_batches", sql="""
    SELECT user_id, max(event_id) AS event_id FROM events GROUP BY user_id""")
def stream_in_batches(spark, sf):
    """A stream in two starts of three micro-batches each, whose files all tasks have written."""
    source, target, checkpoint = (scratch_path(spark, name) for name in ("arriving", "latest", "progress"))
    events = table(spark, sf, "events").select("event_id", "user_id")
    for start in range(2):
        for part in range(3):
            events.filter(F.col("event_id") % 6 == 3 * start + part).write.mode("append").parquet(source)
        files = sum(1 for _ in store.data_files(spark, source))
        stream = incremental.file_stream(spark, source, events.schema, files_per_batch=-(-files // (3 * (start + 1))))
        kept = incremental.upsert(stream, target, checkpoint, ["user_id"], ["event_id"])
    return kept.current()


@query("dedup_after_appends", sql="SELECT c_custkey AS key, 'old' AS value FROM customer")
def dedup_after_appends(spark, sf):
    """Of a row appended twice the one written first stays, whatever the files are called."""
    path = scratch_path(spark, "appended")
    keys = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("IDI"))
    tabular.append_csv(keys.withColumn("value", F.lit("old")), path)
    tabular.append_csv(keys.select(F.lit("new").alias("value"), "IDI"), path)
    cleanup.remove_duplicates(spark, path)
    return tabular.scan_csv(spark, path).select(F.col("IDI").cast("bigint").alias("key"), "value")


@query("csv_rejects", sql="""
    SELECT CASE c_custkey % 10 WHEN 3 THEN 'rejected' WHEN 7 THEN 'rejected' ELSE 'kept' END AS kind,
        CASE c_custkey % 10 WHEN 3 THEN c_custkey || ',' || c_name || ',"' || c_mktsegment || ', more"' WHEN 7 THEN c_custkey::varchar
            ELSE c_custkey || '|' || c_name END AS text
    FROM customer""")
def csv_rejects(spark, sf):
    """Files in which every tenth row has a cell too many and every tenth one too few; both sinks read back."""
    source, kept, rejected = (scratch_path(spark, name) for name in ("written", "kept", "rejected"))
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    more = F.concat(key, F.lit(","), name, F.lit(',"'), F.col("c_mktsegment"), F.lit(', more"'))
    line = F.when(F.col("c_custkey") % 10 == 3, more).when(F.col("c_custkey") % 10 == 7, key).otherwise(F.concat_ws(",", key, name))
    lines = table(spark, sf, "customer").groupBy(F.expr("c_custkey div 500")).agg(F.collect_list(line).alias("lines"))
    lines.select(F.concat(F.lit("key,name\n"), F.array_join("lines", "\n"))).write.text(source)
    good, bad = tabular.split_malformed(tabular.scan_csv(spark, source, keep_malformed=True))
    tabular.write_csv(good, kept)
    tabular.write_csv(bad, rejected)
    good = tabular.scan_csv(spark, kept).select(F.lit("kept").alias("kind"), F.concat_ws("|", "key", "name").alias("text"))
    return good.unionByName(tabular.scan_csv(spark, rejected).select(F.lit("rejected").alias("kind"), F.col("line").alias("text")))


@query("promote_temporary", sql="SELECT p_partkey, p_name FROM part")
def promote_temporary(spark, sf):
    """An old table with other names, and a finished temporary one that takes its place."""
    final, temporary = scratch_path(spark, "final"), scratch_path(spark, "temporary")
    rows = table(spark, sf, "part").select("p_partkey", "p_name")
    store.replace_parquet(rows.withColumn("p_name", F.lit("old")), final)
    rows.write.parquet(temporary)
    store.promote(spark, temporary, final)
    return spark.read.parquet(final)


@query("create_and_insert", views=("v_place", "v_registered", "v_company"), sql="""
    SELECT "IDI" AS idi, "Ditta" AS ditta, n_nationkey::BIGINT AS subcategory_id, "Subcategory" AS subcategory
    FROM v_place JOIN v_company ON "Subcategory" = n_name""")
def create_and_insert(spark, sf):
    """The normalised tables made if missing, twice, filled with companies, subcategories and links, and joined."""
    database = "made_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {database}")
    for _ in range(2):
        normalised.create_schema(spark, database)
    nations = table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint"), F.col("n_regionkey").cast("bigint"), "n_name"
    )
    nations.write.insertInto(f"{database}.subcategories")
    companies = B.company(spark, sf)
    pick(companies, V.COMPANY_COLUMNS).write.insertInto(f"{database}.companies")
    links = companies.join(nations, F.col("Subcategory") == F.col("n_name")).select("IDI", "n_regionkey", "n_nationkey")
    links.write.insertInto(f"{database}.company_categories")
    named = spark.table(f"{database}.company_categories").join(spark.table(f"{database}.subcategories"), "subcategory_id")
    return named.join(spark.table(f"{database}.companies"), "IDI").select(
        F.col("IDI").alias("idi"), F.col("Ditta").alias("ditta"), "subcategory_id", F.col("Subcategory").alias("subcategory")
    )


@query("taxonomy_from_json", sql="SELECT p_brand AS category, p_type AS subcategory, p_name AS item FROM part")
def taxonomy_from_json(spark, sf):
    """Nested documents, one a brand and type with the names of its parts, written as JSON files and read from there."""
    path = scratch_path(spark, "taxonomy")
    parts = table(spark, sf, "part").withColumn("category", F.concat_ws("|", "p_brand", "p_type"))
    lists = parts.groupBy("category").agg(F.array_sort(F.collect_list("p_name")).alias("subcategories"))
    lists.select(F.array(F.struct("category", "subcategories")).alias("categories")).write.json(path)
    found = Taxonomy.read_json(spark, path, multi_line=False).pairs()
    both = F.split("category", "\\|")
    return found.select(both[0].alias("category"), both[1].alias("subcategory"), F.col("subcategory").alias("item"))


@query("surrogate_ids_resume", sql="""
    WITH pair AS (
        SELECT p_brand AS category, p_name AS subcategory, min(p_partkey) AS place, min(p_partkey) FILTER (p_partkey % 2 = 0) AS early
        FROM part GROUP BY 1, 2
    ), category AS (
        SELECT category, row_number() OVER (ORDER BY min(early) IS NULL, coalesce(min(early), min(place))) AS category_id
        FROM pair GROUP BY 1
    )
    SELECT category, subcategory, category_id,
        row_number() OVER (ORDER BY early IS NULL, coalesce(early, place)) AS subcategory_id
    FROM pair JOIN category USING (category)""")
def surrogate_ids_resume(spark, sf):
    """Ids from two loads, the even parts, then all of them, and the second once more: no id of the first changes."""
    path = scratch_path(spark, "ids")
    parts = table(spark, sf, "part").select(
        F.col("p_partkey").alias("ordinal"), F.col("p_brand").alias("Category"), F.col("p_name").alias("Subcategory")
    )
    for load, rows in (("even", parts.filter("ordinal % 2 = 0")), ("all", parts), ("all", parts)):
        categories, subcategories = normalised.lasting_label_tables(rows, "ordinal", path, load)
    return subcategories.join(categories, "category_id").select(
        F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory"), "category_id", "subcategory_id"
    )


@query("coverage_maintained", sql="""
    WITH latest AS (
        SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    )
    SELECT event_type AS category, count(*) AS total, count(*) FILTER (value >= 50) AS has_phone,
        count(*) FILTER (event_id % 3 > 0) AS has_email, count(*) FILTER (event_id % 7 = 0) AS has_website
    FROM latest GROUP BY 1""")
def coverage_maintained(spark, sf):
    """Counts of the latest row of each user after three upserts, one of them twice; never counted as a whole."""
    text = F.col("event_id").cast("string")
    rows = table(spark, sf, "events").select(
        "user_id", "ts", "event_id", F.col("event_type").alias("category"), F.when(F.col("value") >= 50, text).alias("phone_numbers"),
        F.when(F.col("event_id") % 3 > 0, text).alias("email"), F.when(F.col("event_id") % 7 == 0, text).alias("website"),
    )
    kept = MaintainedCoverage(spark, scratch_path(spark, "coverage"), "user_id", "category", ["ts", "event_id"], rows.schema)
    for batch, part in enumerate((0, 1, 1, 2)):
        kept.apply(rows.filter(F.col("event_id") % 3 == part), min(batch, part))
    return kept.coverage()


@query("partition_replace", views=("v_place",), sql="""
    SELECT n_name AS place, c_custkey AS key, CASE WHEN r_name = 'ASIA' THEN 2 * c_acctbal ELSE c_acctbal END AS balance
    FROM customer JOIN v_place ON n_nationkey = c_nationkey WHERE r_name < 'B'""")
def partition_replace(spark, sf):
    """A table by nation, one region's partitions replaced, then read through a filtered dimension that prunes the others."""
    path = scratch_path(spark, "balances")
    places = B.placed(table(spark, sf, "customer"), spark, sf)
    rows = places.select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("balance"), "r_name", F.col("n_name").alias("place"))
    store.replace_partitions(rows.drop("r_name"), path, ["place"], ["key"])
    changed = rows.filter("r_name = 'ASIA'").drop("r_name").withColumn("balance", 2 * F.col("balance"))
    store.replace_partitions(changed, path, ["place"], ["key"])
    return pruned_balances(spark, sf, path)


def pruned_balances(spark, sf, path):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    wanted = table(spark, sf, "nation").join(region, "n_regionkey").filter("r_name < 'B'")
    stored = spark.read.schema("key bigint, balance double, place string").parquet(path)
    return stored.join(wanted.select(F.col("n_name").alias("place")), "place")


@query("bucketed_rejoin", sql="""
    SELECT o_orderkey AS key, o_orderpriority AS priority, o_totalprice AS price, o_custkey AS customer FROM orders""")
def bucketed_rejoin(spark, sf):
    """Both halves of a split table, bucketed and sorted by the key, put together again without an exchange."""
    from kontor.operators.joins import rejoin

    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "key")
    halves = []
    for columns in (("o_orderpriority", "o_custkey"), ("o_totalprice",)):
        name = "half_" + uuid.uuid4().hex
        store.save_bucketed(orders.select("key", *columns), name, "key", 8, scratch_path(spark, "half"))
        halves.append(spark.table(name))
    return rejoin(*halves, key="key").select(
        "key", F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer")
    )


@query("stream_name_cache", sql="""
    SELECT event_id, user_id, CASE WHEN event_id % 2 = 1 THEN coalesce(known, own) ELSE own END AS record
    FROM (SELECT event_id, user_id, CASE WHEN event_type = 'purchase' THEN props END AS own FROM events)
    LEFT JOIN (SELECT user_id, min_by(props, event_id) AS known FROM events
        WHERE event_type = 'purchase' AND event_id % 2 = 0 GROUP BY 1) USING (user_id)""")
def stream_name_cache(spark, sf):
    """Look-ups by user, of which purchases find a record; a second start gives later rows what the first one found."""
    source, target, checkpoint = (scratch_path(spark, name) for name in ("lookups", "found", "progress"))
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") == "purchase", F.col("props")).alias("record")
    )
    for part in range(2):
        rows.filter(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        stream = incremental.file_stream(spark, source, rows.schema, files_per_batch=100_000)
        found = incremental.cached_records(stream, "user_id", ["record"], "event_id", 86_400_000)
        incremental.append(found, target, checkpoint, empty_batches=False)
    return spark.read.schema(rows.schema).parquet(target)


@query("stream_contact_join", sql="""
    SELECT r.event_id, r.user_id, c.event_id AS contact_id
    FROM events r LEFT JOIN events c ON c.user_id = r.user_id AND c.event_type = 'purchase'
        AND c.ts BETWEEN r.ts AND r.ts + INTERVAL 12 HOUR
    WHERE r.event_type = 'click'""")
def stream_contact_join(spark, sf):
    """Clicks with the purchases of the next 12 hours, which arrive one start later; joined as two streams."""
    early, late, target, checkpoint = (scratch_path(spark, name) for name in ("early", "late", "joined", "progress"))
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    third = F.least(F.floor((F.unix_micros("ts") - F.unix_micros(F.lit(first))) * 3 / (F.unix_micros(F.lit(last)) - F.unix_micros(F.lit(first)) + 1)), F.lit(2))
    rows = events.select(third.alias("third"), "event_type", "event_id", "user_id", "ts")
    left = rows.filter("event_type = 'click'").select("third", "event_id", "user_id", "ts")
    right = rows.filter("event_type = 'purchase'").select("third", F.col("event_id").alias("contact_id"), "user_id", F.col("ts").alias("bought"))
    # A row far ahead on both sides lets the watermark pass all others.
    ahead = F.lit(last) + F.expr("INTERVAL 30 DAY")
    end = spark.range(1).select(F.lit(3).cast("bigint").alias("third"), F.lit(-1).cast("bigint").alias("id"), F.lit(-1).cast("bigint").alias("user_id"), ahead.alias("time"))
    left = left.unionByName(end.withColumnsRenamed({"id": "event_id", "time": "ts"}))
    right = right.unionByName(end.withColumnsRenamed({"id": "contact_id", "time": "bought"}))
    for step in range(4):
        left.filter(F.col("third") == step).drop("third").write.mode("append").parquet(early)
        behind = F.col("third") == step - 1 if step < 3 else F.col("third") >= 2
        right.filter(behind).drop("third").write.mode("append").parquet(late)
        streams = [incremental.file_stream(spark, path, df.drop("third").schema, files_per_batch=100_000) for path, df in ((early, left), (late, right))]
        joined = incremental.left_join(*streams, "user_id", "ts", "bought", "12 HOUR")
        incremental.append(joined.select("event_id", "user_id", "contact_id"), target, checkpoint)
    return spark.read.parquet(target).filter("event_id >= 0")
