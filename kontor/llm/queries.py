"""The operators over the test tables, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kontor.llm import (
    decontamination, langid, maintext, mixing, negatives, pieces, pii, quality, secretscan, simhash, tokenfiles, topk, whitening,
)
from kontor.llm.frames import learn_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS unit
    FROM documents
), totals AS (
    SELECT source, sum(size)::BIGINT AS total,
        [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, (1.5 * sum(total) OVER ()
            - coalesce(sum(2 * total) OVER (fill ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
        / sum(weight) OVER (fill ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM totals WINDOW fill AS (ORDER BY 2 * total / weight, source NULLS LAST)
), goals AS (
    SELECT source, total, least((2 * total)::DOUBLE, max(level) OVER () * weight) AS target FROM levels
), budgets AS (
    SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS passes FROM goals
), placed AS (
    SELECT d.*, b.total, b.target, b.passes, b.target - b.passes * b.total AS rest,
        sum(size) OVER (PARTITION BY d.source ORDER BY unit) AS upto,
        sum(size) OVER (PARTITION BY d.source, unit) AS here,
        row_number() OVER (PARTITION BY d.source, unit) AS place
    FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, total AS source_size, target,
    (size * (passes + CASE WHEN upto <= rest THEN 1
        WHEN upto - here <= rest AND place <= floor((rest - (upto - here)) / size + 0.5) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""


@query("op1_mixing", MIX_SQL)
def op1_mixing(spark, sf):
    rows = mixing.mixed_sizes(_table(spark, sf, "documents"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", "taken")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op9_token_files")
def op9_token_files(spark, sf):
    files = tokenfiles.write_tokens(_table(spark, sf, "documents"), tokenizer_path())
    return tokenfiles.read_back(spark, files).withColumnRenamed("key", "doc_id")


@query("op10_simhash_dedup")
def op10_simhash_dedup(spark, sf):
    found = simhash.groups(_table(spark, sf, "documents"))
    return found.select(
        F.col("key").alias("doc_id"), simhash.hexadecimal(F.col("f")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op2_language_id")
def op2_language_id(spark, sf):
    docs = _table(spark, sf, "documents")
    model = langid.train(docs.filter(learn_rows(F.col("doc_id"))))
    found = docs.select("doc_id", langid.predicted(spark, model, F.col("text")).alias("found"))
    return found.select(
        "doc_id", (~learn_rows(F.col("doc_id"))).alias("held_out"), F.col("found.lang").alias("lang_pred"), "found.score",
    )


@query("op8_quality")
def op8_quality(spark, sf):
    rows = quality.quality(_table(spark, sf, "documents"), _table(spark, sf, "labels"))
    return rows.withColumnRenamed("key", "doc_id")


LEAK_SQL = r"""
WITH cut AS (
    SELECT doc_id, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) AS part
    FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words FROM documents)
), known AS (
    SELECT item, item_id, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) AS part
    FROM (SELECT row_number() OVER () AS item, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS words
          FROM (SELECT DISTINCT item_id, text FROM benchmark))
), ours AS (
    SELECT doc_id, unnest(part) AS h, unnest(range(len(part))) AS p FROM cut
), theirs AS (
    SELECT item, len(part) AS m, unnest(part) AS h, unnest(range(len(part))) AS q FROM known
), windows AS (
    SELECT DISTINCT doc_id, item, m, p - q AS at FROM ours JOIN theirs USING (h)
), inside AS (
    SELECT w.doc_id, w.item, w.m, w.at, o.h, count(*) AS a
    FROM windows w JOIN ours o ON o.doc_id = w.doc_id AND o.p >= w.at AND o.p < w.at + w.m GROUP BY ALL
), weights AS (
    SELECT item, h, count(*) AS b FROM theirs GROUP BY ALL
), sums AS (
    SELECT i.doc_id, i.item, i.m, i.at, sum(i.a) AS length, sum(least(i.a, coalesce(b, 0))) AS common
    FROM inside i LEFT JOIN weights t ON t.item = i.item AND t.h = i.h GROUP BY ALL
)
SELECT doc_id, array_to_string(list_sort(list(DISTINCT item_id)), ',') AS item_ids, count(DISTINCT item) AS n_items,
    max(common::BIGINT / (length::BIGINT + m - common::BIGINT)) AS similarity
FROM sums JOIN known USING (item) WHERE common::BIGINT / (length::BIGINT + m - common::BIGINT) >= 0.8 GROUP BY doc_id
"""


@query("op6_decontamination", LEAK_SQL)
def op6_decontamination(spark, sf):
    rows = decontamination.leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return rows.select(F.col("key").alias("doc_id"), F.array_join("item_ids", ",").alias("item_ids"), "n_items", "similarity")


TOPK_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
    FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query("op7_top_k", TOPK_SQL)
def op7_top_k(spark, sf):
    vectors = _table(spark, sf, "embeddings")
    found = topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("key").alias("vec_id"), "score")


@query("op4_secrets")
def op4_secrets(spark, sf):
    found = secretscan.scan(_table(spark, sf, "documents"))
    spans = F.transform("spans", lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"]))
    return found.select(
        F.col("key").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(spans, ",").alias("spans"),
    )


@query("op5_main_text")
def op5_main_text(spark, sf):
    rows = maintext.extract(_table(spark, sf, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# A key of the tests' own; in use it comes from the caller's key store.
PII_KEY = b"kontor example key"


@query("op3_pii_surrogates")
def op3_pii_surrogates(spark, sf):
    rows = pii.pseudonymise(_table(spark, sf, "documents").select("doc_id", "text"), PII_KEY)
    spans = F.transform("entities", lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"]))
    return rows.select("doc_id", "text", F.size("entities").alias("n_entities"), F.array_join(spans, ",").alias("spans"))


@query("op11_sentencepiece")
def op11_sentencepiece(spark, sf):
    model = tokenizer_path("piece_bpe_32k.model")
    rows = pieces.encode(_table(spark, sf, "documents"), model)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        F.col("key").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(pieces.decoded(F.col("ids"), model), 256).alias("decoded_sha256"),
    )


@query("op12_whitening")
def op12_whitening(spark, sf):
    return whitening.whiten(_table(spark, sf, "embeddings")).withColumnRenamed("key", "vec_id")


NEGATIVES_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, v.label = a.label AS same, list_inner_product(a.x, v.x)::BIGINT AS score
    FROM v a JOIN v ON v.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
        row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark, sf):
    rows = _table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    return negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0))
