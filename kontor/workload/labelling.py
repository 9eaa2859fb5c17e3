"""Taxonomy, prompts, replies, scores and the classification driver."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions import prompts, scores
from kontor.functions.text import hypothesis, model_text
from kontor.operators import attempts, joins, numbering, reports, scoring
from kontor.operators.filters import pending
from kontor.plans import classification
from kontor.session import scratch_path
from kontor.sources.taxonomy import SCHEMA, Taxonomy
from kontor.workload import bindings as B
from kontor.workload.bindings import query, table
from kontor.workload.texts import words_sql


def filled_sql(template: str, **places: str) -> str:
    text = "'" + template.replace("'", "''") + "'"
    for name, value in places.items():
        text = f"replace({text}, '{{{name}}}', {value})"
    return text


# --- taxonomy -----------------------------------------------------------------------
@query("nested_taxonomy_explode", views=("v_place",), sql="""
    SELECT c_mktsegment AS category, 0 AS position, unnest([0, 1]) AS sub_position, unnest([c_name, n_name]) AS subcategory
    FROM customer JOIN v_place ON n_nationkey = c_nationkey
    UNION ALL SELECT r_name, 2, 0, n_name FROM customer JOIN v_place ON n_nationkey = c_nationkey""")
def nested_taxonomy_explode(spark, sf):
    """Nested documents as JSON text, read with their schema and exploded; an empty list gives no pairs."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    entries = F.array(*(
        F.struct(F.col(category).alias("category"), F.array(*names).cast("array<string>").alias("subcategories"))
        for category, names in (("c_mktsegment", ["c_name", "n_name"]), ("c_name", []), ("r_name", ["n_name"]))
    ))
    document = rows.select(F.to_json(F.struct(entries.alias("categories"))).alias("json"))
    return Taxonomy.from_nested(document.select(F.from_json("json", SCHEMA).alias("d")).select("d.categories")).pairs()


@query("taxonomy_membership", views=("v_place",), sql="""
    SELECT o_orderkey, coalesce(r_name IS NOT NULL, false) AS known FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN v_place ON n_nationkey = c_nationkey AND r_name = CASE WHEN o_orderkey % 3 = 0 THEN 'asia' ELSE 'ASIA' END""")
def taxonomy_membership(spark, sf):
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    claimed = rows.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "asia").otherwise("ASIA").alias("category"),
        F.concat(F.lit("NATION_"), "c_nationkey").alias("subcategory"),
    )
    return B.taxonomy(spark, sf).known(claimed, "category", "subcategory").select("o_orderkey", "known")


# --- prompts ------------------------------------------------------------------------
@query("prompt_single", views=("v_place", "v_taxonomy_text"), sql=f"""
    SELECT c_custkey, {filled_sql(V.SINGLE_PROMPT, taxonomy='taxonomy', name='c_name', purpose="coalesce(text, '')")} AS prompt
    FROM v_taxonomy_text, customer LEFT JOIN documents ON doc_id = c_custkey""")
def prompt_single(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "documents"), F.col("c_custkey") == F.col("doc_id"), "left"
    )
    return classification.single_requests(rows, "c_custkey", "c_name", "text", B.taxonomy(spark, sf))


@query("prompt_two_stage", views=("v_place", "v_taxonomy_text"), sql=f"""
    SELECT c_custkey, 1 AS stage,
        {filled_sql(V.CATEGORY_PROMPT, categories='categories', name='c_name', purpose='c_mktsegment')} AS prompt
    FROM v_taxonomy_text, customer
    UNION ALL SELECT c_custkey, 2, {filled_sql(V.SUBCATEGORY_PROMPT, subcategories='subs', name='c_name',
                                               purpose='c_mktsegment', category='r_name')}
    FROM customer JOIN v_place USING (n_nationkey)
    JOIN (SELECT r_name, string_agg(n_name, ', ' ORDER BY n_name) AS subs FROM v_place GROUP BY 1) USING (r_name)
    WHERE c_custkey % 5 <> 0""".replace("USING (n_nationkey)", "ON n_nationkey = c_nationkey"))
def prompt_two_stage(spark, sf):
    taxonomy = B.taxonomy(spark, sf)
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    reply = F.when(F.col("c_custkey") % 5 == 0, "ATLANTIS").otherwise(F.concat(F.lit(" "), "r_name", F.lit("\n")))
    rows = rows.withColumn("reply", reply)
    first = classification.category_requests(rows, "c_custkey", "c_name", "c_mktsegment", taxonomy)
    second = classification.subcategory_requests(rows, "c_custkey", "c_name", "c_mktsegment", "reply", taxonomy)
    return first.unionByName(second)


TEXT_SQL = "'Company: ' || c_name || '. Purpose: ' || coalesce(text, '')"


@query("model_text", sql=f"""
    SELECT c_custkey, array_to_string({words_sql(TEXT_SQL)}, ' ') AS text
    FROM customer LEFT JOIN documents ON doc_id = c_custkey""")
def model_texts(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "documents"), F.col("c_custkey") == F.col("doc_id"), "left"
    )
    return rows.select("c_custkey", model_text("c_name", "text").alias("text"))


@query("label_hypotheses", views=("v_place",), sql="""
    SELECT c_custkey, n.n_name AS candidate, 'This company is a ' || n.n_name || '.' AS hypothesis
    FROM customer JOIN v_place p ON p.n_nationkey = c_nationkey JOIN v_place n ON n.r_name = p.r_name""")
def label_hypotheses(spark, sf):
    """Second-stage candidates: only the subcategories of the row's own category."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    listed = B.taxonomy(spark, sf).add_labels(rows.select("c_custkey", "r_name"), "r_name")
    pairs = joins.candidates(listed, F.col("labels"))
    return pairs.select("c_custkey", "candidate", hypothesis("candidate", V.SUBCATEGORY_HYPOTHESIS).alias("hypothesis"))


# --- replies ------------------------------------------------------------------------
@query("response_parse", views=("v_place", "v_response"), sql="""
    SELECT entity, CASE entity % 7 WHEN 1 THEN 'Other' WHEN 2 THEN 'Other' ELSE r_name END AS category,
        CASE entity % 7 WHEN 1 THEN 'Other' WHEN 2 THEN 'Other' WHEN 3 THEN r_name WHEN 5 THEN r_name ELSE n_name END
            AS subcategory
    FROM v_response""")
def response_parse(spark, sf):
    replies = B.responses(spark, sf).select("entity", "text")
    return classification.parse_replies(replies, B.taxonomy(spark, sf)).drop("text")


def _tries(rows, key: str):
    return rows.withColumn("attempt", F.explode(F.sequence(F.lit(1), F.lit(4))))


@query("attempt_resolution", views=("v_place",), sql="""
    WITH one AS (SELECT c_custkey, r_name, n_name, attempt, (c_custkey + attempt * (c_custkey % 3)) % 4 AS kind
        FROM customer JOIN v_place ON n_nationkey = c_nationkey, range(1, 4) t(attempt)),
    chosen AS (SELECT c_custkey, min(attempt) AS attempt FROM one WHERE kind > 1 GROUP BY 1)
    SELECT c.c_custkey, CASE WHEN o.kind IS NULL THEN NULL WHEN o.kind = 2 THEN 'Other' ELSE o.r_name END AS category,
        CASE WHEN o.kind IS NULL THEN NULL WHEN o.kind = 2 THEN 'Other' ELSE o.n_name END AS subcategory
    FROM customer c LEFT JOIN chosen USING (c_custkey) LEFT JOIN one o USING (c_custkey, attempt)""")
def attempt_resolution(spark, sf):
    """Single prompt: rate-limit errors are retried, other errors end in the unknown labels."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    kind = (F.col("c_custkey") + F.col("attempt") * (F.col("c_custkey") % 3)) % 4
    log = _tries(rows, "c_custkey").select(
        "c_custkey", "attempt",
        F.when(kind == 3, F.concat(F.lit("Category: "), "r_name", F.lit("\nSubcategory: "), "n_name")).alias("text"),
        F.when(kind <= 1, "429 too many requests").when(kind == 2, "500 server error").alias("error"),
    )
    return classification.single_outcome(log, "c_custkey", B.taxonomy(spark, sf))


@query("two_stage_attempts", views=("v_place",), sql="""
    WITH one AS (SELECT c_custkey, n_name, attempt, (c_custkey + attempt * 2) % 3 = 0 AS fail1,
            (c_custkey + attempt * 5) % 4 = 0 AS fail2,
            CASE WHEN (c_custkey + attempt) % 5 = 0 THEN 'ATLANTIS' ELSE r_name END AS cat,
            CASE WHEN (c_custkey + attempt) % 7 = 0 THEN 'NOWHERE' ELSE n_name END AS sub
        FROM customer JOIN v_place ON n_nationkey = c_nationkey, range(1, 4) t(attempt)),
    ended AS (SELECT *, NOT fail1 AND (cat = 'ATLANTIS' OR NOT fail2) AS final FROM one),
    chosen AS (SELECT c_custkey, coalesce(min(attempt) FILTER (WHERE final), 3) AS attempt FROM ended GROUP BY 1)
    SELECT c_custkey, CASE WHEN fail1 OR cat = 'ATLANTIS' THEN 'Other' ELSE cat END AS category,
        CASE WHEN fail1 OR cat = 'ATLANTIS' THEN 'Other' WHEN fail2 OR sub = 'NOWHERE' THEN cat ELSE sub END AS subcategory
    FROM chosen JOIN ended USING (c_custkey, attempt)""")
def two_stage_attempts(spark, sf):
    """Two prompts: an error in either stage starts the next attempt, the last one decides."""
    rows = B.placed(table(spark, sf, "customer"), spark, sf)
    key, attempt = F.col("c_custkey"), F.col("attempt")
    tried = _tries(rows, "c_custkey").withColumn("stage", F.explode(F.array(F.lit(1), F.lit(2))))
    fails = F.when(F.col("stage") == 1, (key + attempt * 2) % 3 == 0).otherwise((key + attempt * 5) % 4 == 0)
    category = F.when((key + attempt) % 5 == 0, "ATLANTIS").otherwise(F.concat(F.lit(" "), "r_name", F.lit("\n")))
    subcategory = F.when((key + attempt) % 7 == 0, "NOWHERE").otherwise(F.col("n_name"))
    log = tried.select(
        "c_custkey", "attempt", "stage",
        F.when(~fails, F.when(F.col("stage") == 1, category).otherwise(subcategory)).alias("text"),
        F.when(fails, "timeout").alias("error"),
    )
    return classification.two_prompt_outcome(log, "c_custkey", B.taxonomy(spark, sf))


@query("request_tally", sql=f"""
    SELECT count(*) AS requests, CAST(sum(length(prompt) // 4 + CASE WHEN valid THEN 50 ELSE 0 END) AS bigint) AS total_tokens,
        sum(length(prompt) // 4 + CASE WHEN valid THEN 50 ELSE 0 END) / 1000000 * 0.15 AS cost
    FROM (SELECT text AS prompt, quality = 1 AS valid FROM documents LEFT JOIN labels USING (doc_id))""")
def request_tally(spark, sf):
    log = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return attempts.tally(log.select(F.col("text").alias("prompt"), (F.col("quality") == 1).alias("valid")))


# --- scores -------------------------------------------------------------------------
@query("best_label", views=("v_share",), sql="""
    SELECT entity, label, score FROM v_share
    QUALIFY row_number() OVER (PARTITION BY entity ORDER BY score DESC, label) = 1""")
def best_label(spark, sf):
    return scoring.best_label(B.event_shares(spark, sf), "entity")


@query("softmax_scores", views=("v_share",), sql="""
    SELECT entity, label, round(exp(score) / sum(exp(score)) OVER (PARTITION BY entity), 9) AS score FROM v_share""")
def softmax_scores(spark, sf):
    found = scoring.softmax_scores(B.event_shares(spark, sf), "entity")
    return found.withColumn("score", F.round("score", 9))


CASCADE_SCORE = 0.25


@query("score_cascade", views=("v_share",), sql=f"""
    WITH first AS (SELECT entity, label, score FROM v_share
        QUALIFY row_number() OVER (PARTITION BY entity ORDER BY score DESC, label) = 1),
    part AS (SELECT user_id, event_type, event_type || event_id % 5 AS label, count(*) AS n FROM events GROUP BY ALL),
    second AS (SELECT user_id, label, n / sum(n) OVER (PARTITION BY user_id) AS score
        FROM part JOIN first ON entity = user_id AND event_type = first.label
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, part.label) = 1)
    SELECT entity, CASE WHEN first.score < {CASCADE_SCORE} THEN 'Other' ELSE first.label END AS category,
        CASE WHEN first.score < {CASCADE_SCORE} THEN 'Other' WHEN second.score < {CASCADE_SCORE} THEN first.label
            ELSE second.label END AS subcategory
    FROM first JOIN second ON user_id = entity""".replace("SELECT user_id, label, n /", "SELECT user_id, part.label, n /"))
def score_cascade(spark, sf):
    """Long-form scores of two stages; the second holds only the labels of the first's winner."""
    first = scoring.best_label(B.event_shares(spark, sf), "entity")
    events = table(spark, sf, "events")
    parts = events.groupBy(
        F.col("user_id").alias("entity"), F.col("event_type").alias("category"),
        F.concat("event_type", (F.col("event_id") % 5).cast("string")).alias("label"),
    ).agg(F.count("*").alias("n"))
    won = first.select("entity", F.col("label").alias("category"))
    asked = parts.join(won, ["entity", "category"])
    whole = F.sum("n").over(Window.partitionBy("entity"))
    second = scoring.best_label(
        asked.select("entity", "label", (F.col("n") / whole).alias("score")), "entity"
    ).withColumnsRenamed({"label": "sub", "score": "sub_score"})
    both = first.join(second, "entity")
    outcome = scores.cascade("label", "score", "sub", "sub_score", CASCADE_SCORE)
    return both.select("entity", outcome.alias("o")).select("entity", "o.category", "o.subcategory")


def letter_model():
    """A stand-in model: how much of the text is the label's letter."""
    letters = "abcdefghijklmnopqrstuvwxyz"

    def letter(label: str) -> str:
        return letters[int(label[7:])] if label.startswith("NATION_") else label[1].lower()

    def score(texts: list[str], labels: list[list[str]]) -> list[list[float]]:
        return [[60.0 * text.count(letter(one)) / (len(text) + 1) for one in names] for text, names in zip(texts, labels)]

    return score


def letter_score_sql(text: str, letter: str) -> str:
    return f"60.0 * CAST(length({text}) - length(replace({text}, {letter}, '')) AS double) / (length({text}) + 1)"


ZERO_SHOT_SQL = f"""
    WITH t AS (SELECT c_custkey, array_to_string({words_sql(TEXT_SQL)}, ' ') AS t
        FROM customer LEFT JOIN documents ON doc_id = c_custkey),
    s1 AS (SELECT c_custkey, t, r_name, {letter_score_sql('t', 'lower(substr(r_name, 2, 1))')} AS s
        FROM t, (SELECT DISTINCT r_name FROM v_place)),
    b1 AS (SELECT c_custkey, t, r_name, exp(s) / sum(exp(s)) OVER (PARTITION BY c_custkey) AS p FROM s1
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY s DESC, r_name) = 1),
    s2 AS (SELECT c_custkey, p, b1.r_name, n_name,
            {letter_score_sql('t', "chr(CAST(97 + CAST(substr(n_name, 8) AS integer) AS integer))")} AS s
        FROM b1 JOIN v_place ON v_place.r_name = b1.r_name),
    b2 AS (SELECT *, exp(s) / sum(exp(s)) OVER (PARTITION BY c_custkey) AS q FROM s2
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY s DESC, n_name) = 1)
    SELECT c_custkey, CASE WHEN p < 0.5 THEN 'Other' ELSE r_name END AS category,
        CASE WHEN p < 0.5 THEN 'Other' WHEN q < 0.5 THEN r_name ELSE n_name END AS subcategory FROM b2"""


@query("zero_shot_classify", views=("v_place",), sql=ZERO_SHOT_SQL)
def zero_shot_classify(spark, sf):
    """The two-stage cascade through the scorer hook, default threshold."""
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "documents"), F.col("c_custkey") == F.col("doc_id"), "left"
    ).select("c_custkey", "c_name", "text")
    found = classification.by_scores(rows, "c_name", "text", B.taxonomy(spark, sf), scoring.scorer(letter_model))
    return found.select("c_custkey", F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory"))


# --- estimates ----------------------------------------------------------------------
BASE_SQL = f"(SELECT length({filled_sql(V.ESTIMATE_PROMPT, taxonomy='taxonomy')}) // 4 FROM v_taxonomy_text)"
ESTIMATE_SQL = f"""
    SELECT base AS base_prompt_tokens, names AS company_name_tokens, texts AS purpose_tokens,
        rows * 20 AS estimated_response_tokens, base * rows + names + texts + rows * 20 AS total_estimated_tokens,
        rows AS number_of_companies, (base * rows + names + texts + rows * 20) / rows AS average_tokens_per_company
    FROM (SELECT {BASE_SQL} AS base, count(*) AS rows, CAST(sum(length(c_name) // 4) AS bigint) AS names,
        CAST(sum(coalesce(length(text) // 4, 0)) AS bigint) AS texts
        FROM customer LEFT JOIN documents ON doc_id = c_custkey)"""


def _estimate(spark, sf):
    rows = table(spark, sf, "customer").join(
        table(spark, sf, "documents"), F.col("c_custkey") == F.col("doc_id"), "left"
    )
    base = prompts.tokens(prompts.fill(V.ESTIMATE_PROMPT, taxonomy=B.taxonomy(spark, sf).text()))
    return reports.token_estimate(rows, "c_name", "text", base)


@query("token_estimate", views=("v_place", "v_taxonomy_text"), sql=ESTIMATE_SQL)
def token_estimate(spark, sf):
    return _estimate(spark, sf)


@query("cost_estimate", views=("v_place", "v_taxonomy_text"), sql=f"""
    SELECT number_of_companies, round(i, 9) AS input_cost, round(o, 9) AS output_cost, round(i + o, 9) AS total_cost
    FROM (SELECT number_of_companies, (base_prompt_tokens * number_of_companies + company_name_tokens + purpose_tokens)
        / 1000 * 0.000075 AS i, estimated_response_tokens / 1000 * 0.0005 AS o FROM ({ESTIMATE_SQL}))""")
def cost_estimate(spark, sf):
    costs = reports.cost_estimate(_estimate(spark, sf))
    return costs.select(
        "number_of_companies", *(F.round(name, 9).alias(name) for name in ("input_cost", "output_cost", "total_cost"))
    )


@query("flat_cost_estimate", sql="""
    SELECT count(*) AS remaining, count(*) * 300 AS estimated_tokens, round(count(*) * 300 / 1000000 * 0.15, 9) AS estimated_cost
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def flat_cost_estimate(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    found = reports.flat_cost_estimate(rows, F.col("quality").isNull())
    return found.withColumn("estimated_cost", F.round("estimated_cost", 9))


# --- the driver ---------------------------------------------------------------------
def _driver(spark, sf):
    rows = B.company(spark, sf).drop("Category", "Subcategory")
    done = B.classified(spark, sf).join(
        table(spark, sf, "labels").select(B.idi("doc_id").alias("IDI")), "IDI", "left_semi"
    )
    prepared = classification.prepare(rows, done, "IDI")
    planned = classification.request_batches(prepared, ["ordinal"], V.SINGLE_PROMPT_BATCH, keep=["IDI"])
    replies = planned.join(B.responses(spark, sf), F.col("ordinal") == F.col("entity")).select("IDI", "batch_no", "text")
    labels = classification.parse_replies(replies, B.taxonomy(spark, sf))
    return classification.apply_labels(prepared, labels, "IDI")


DRIVER_SQL = """
    SELECT "IDI" AS idi,
        CASE WHEN l.doc_id IS NOT NULL THEN "Category" WHEN "Purpose" IS NULL THEN NULL
            WHEN ordinal % 7 IN (1, 2) THEN 'Other' ELSE "Category" END AS category,
        CASE WHEN l.doc_id IS NOT NULL THEN "Subcategory" WHEN "Purpose" IS NULL THEN NULL
            WHEN ordinal % 7 IN (1, 2) THEN 'Other' WHEN ordinal % 7 IN (3, 5) THEN "Category"
            ELSE "Subcategory" END AS subcategory
    FROM v_company LEFT JOIN labels l ON l.doc_id = ordinal"""


@query("classify_driver", views=("v_registered", "v_company"), sql=DRIVER_SQL)
def classify_driver(spark, sf):
    """Progress filled in by key, pending rows batched, replies parsed, labels laid over the rows."""
    return _driver(spark, sf).select(
        F.col("IDI").alias("idi"), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory")
    )


@query("single_prompt_round", views=("v_registered", "v_company"), sql=DRIVER_SQL)
def single_prompt_round(spark, sf):
    """The same as one call, the outside model being a function between tables."""
    rows = B.company(spark, sf).drop("Category", "Subcategory")
    done = B.classified(spark, sf).join(
        table(spark, sf, "labels").select(B.idi("doc_id").alias("IDI")), "IDI", "left_semi"
    )
    replies = B.responses(spark, sf).select(B.idi("entity").alias("IDI"), "text")

    def answer(requests):
        return requests.select("IDI").join(replies, "IDI").select(
            "IDI", F.lit(1).alias("attempt"), "text", F.lit(None).cast("string").alias("error")
        )

    found = classification.run_single_prompt(rows, done, "IDI", "Ditta", "Purpose", B.taxonomy(spark, sf), answer)
    return found.select(
        F.col("IDI").alias("idi"), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory")
    )


@query("classification_resume", views=("v_registered", "v_company"), sql=DRIVER_SQL)
def classification_resume(spark, sf):
    """The round saved batch by batch, broken off after the first of about three and started again."""
    rows = B.company(spark, sf).drop("Category", "Subcategory")
    done = B.classified(spark, sf).join(
        table(spark, sf, "labels").select(B.idi("doc_id").alias("IDI")), "IDI", "left_semi"
    )
    replies = B.responses(spark, sf).select(B.idi("entity").alias("IDI"), "text")

    def answer(requests):
        return requests.select("IDI").join(replies, "IDI").select(
            "IDI", F.lit(1).alias("attempt"), "text", F.lit(None).cast("string").alias("error")
        )

    output, errors = scratch_path(spark, "labels"), scratch_path(spark, "errors")
    size = -(-table(spark, sf, "documents").count() // 3)
    for rounds in (1, None):
        found = classification.run_saved(
            rows, done, "IDI", "Ditta", "Purpose", B.taxonomy(spark, sf), answer, output, errors, size, rounds
        )
    return found.select(
        F.col("IDI").alias("idi"), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory")
    )


TWO_PROMPT_SQL = """
    SELECT "IDI" AS idi,
        CASE WHEN quality = 1 THEN "Category" WHEN c_custkey % 5 = 0 THEN 'Other' ELSE "Category" END AS category,
        CASE WHEN quality = 1 THEN "Subcategory" WHEN c_custkey % 5 = 0 THEN 'Other' WHEN c_custkey % 7 = 0 THEN "Category"
            ELSE "Subcategory" END AS subcategory
    FROM v_classified LEFT JOIN labels ON doc_id = c_custkey"""


def _two_prompts(spark, sf):
    """Rows, earlier labels, of which unknown ones are asked again, and the outside model."""
    places = B.placed(table(spark, sf, "customer"), spark, sf)
    rows = places.select(B.idi("c_custkey").alias("IDI"), "c_custkey", "r_name", "n_name")
    labels = table(spark, sf, "labels").join(rows, F.col("doc_id") == F.col("c_custkey"))
    good = F.col("quality") == 1
    done = labels.select(
        "IDI", F.when(good, F.col("r_name")).otherwise(V.UNKNOWN).alias("Category"),
        F.when(good, F.col("n_name")).otherwise(V.UNKNOWN).alias("Subcategory"),
    )

    def answer(asked):
        tried = asked.withColumn("stage", F.explode(F.array(F.lit(1), F.lit(2))))
        category = F.when(F.col("c_custkey") % 5 == 0, "ATLANTIS").otherwise(F.col("r_name"))
        subcategory = F.when(F.col("c_custkey") % 7 == 0, "NOWHERE").otherwise(F.col("n_name"))
        return tried.select(
            "IDI", F.lit(1).alias("attempt"), "stage",
            F.when(F.col("stage") == 1, category).otherwise(subcategory).alias("text"),
            F.lit(None).cast("string").alias("error"),
        )

    return rows, done, answer


def _labelled(rows):
    return rows.select(F.col("IDI").alias("idi"), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory"))


@query("two_prompt_round", views=("v_classified",), sql=TWO_PROMPT_SQL)
def two_prompt_round(spark, sf):
    """Earlier (unknown, unknown) rows are asked again, labelled ones are not."""
    rows, done, answer = _two_prompts(spark, sf)
    return _labelled(classification.run_two_prompts(rows, done, "IDI", B.taxonomy(spark, sf), answer))


@query("two_prompt_resume", views=("v_classified",), sql=TWO_PROMPT_SQL)
def two_prompt_resume(spark, sf):
    """The same saved batch by batch, broken off after the first of about three and started again."""
    rows, done, answer = _two_prompts(spark, sf)
    output, errors = scratch_path(spark, "labels"), scratch_path(spark, "errors")
    size = -(-rows.count() // 3)
    for rounds in (1, None):
        found = classification.run_two_prompts_saved(
            rows, done, "IDI", B.taxonomy(spark, sf), answer, output, errors, size, rounds
        )
    return _labelled(found)


@query("score_resume", views=("v_place",), sql=f"""
    WITH zero_shot AS ({ZERO_SHOT_SQL})
    SELECT {B.idi_sql('c_custkey')} AS idi, CASE WHEN text IS NOT NULL THEN category END AS category,
        CASE WHEN text IS NOT NULL THEN subcategory END AS subcategory
    FROM zero_shot LEFT JOIN documents ON doc_id = c_custkey""")
def score_resume(spark, sf):
    """The score-based round over the companies with a text, saved batch by batch, broken off and started again."""
    rows = table(spark, sf, "customer").join(table(spark, sf, "documents"), F.col("c_custkey") == F.col("doc_id"), "left")
    rows = rows.select(B.idi("c_custkey").alias("IDI"), "c_name", "text")
    output, size = scratch_path(spark, "labels"), -(-table(spark, sf, "documents").count() // 3)
    for rounds in (1, None):
        found = classification.run_by_scores_saved(
            rows, None, "IDI", "c_name", "text", B.taxonomy(spark, sf), scoring.scorer(letter_model), output, size=size, rounds=rounds
        )
    return _labelled(found)


@query("batch_plan", sql="""
    SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS row_no, (row_number() OVER (ORDER BY doc_id) - 1) // 20 AS batch_no
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def batch_plan(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.col("text").alias("Purpose")).join(
        table(spark, sf, "labels").select("doc_id", F.col("quality").alias("Category")), "doc_id", "left"
    )
    planned = numbering.batches(rows.filter(pending()).select("doc_id"), ["doc_id"], V.TWO_PROMPT_BATCH)
    return planned


@query("rate_plan", sql="""
    SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_no,
        (row_number() OVER (ORDER BY ts, event_id) - 1) // 10 AS minute_no FROM events""")
def rate_plan(spark, sf):
    planned = numbering.rate_slots(
        table(spark, sf, "events").select("ts", "event_id"), ["ts", "event_id"], V.SINGLE_PROMPT_RATE
    )
    return planned.drop("ts")


@query("rate_audit", sql="""
    SELECT date_trunc('minute', ts) AS minute, count(*) AS requests FROM events GROUP BY 1 HAVING count(*) > 1""")
def rate_audit(spark, sf):
    return numbering.rate_audit(table(spark, sf, "events"), "ts", 1)


@query("progress_share", sql="""
    SELECT doc_id, CAST(sum(done) OVER w AS bigint) AS done_so_far, sum(done) OVER w / count(*) OVER () AS done_share
    FROM (SELECT d.doc_id, CASE WHEN quality IS NULL THEN 0 ELSE 1 END AS done
        FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    WINDOW w AS (ORDER BY doc_id)""")
def progress_share(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return numbering.progress(rows.select("doc_id", "quality"), ["doc_id"], F.col("quality").isNotNull()).drop("quality")


@query("rate_audit_sliding", sql="""
    SELECT ts, max(requests) AS requests
    FROM (SELECT ts, count(*) OVER (ORDER BY ts RANGE BETWEEN INTERVAL 59.999999 SECONDS PRECEDING AND CURRENT ROW) AS requests FROM events)
    WHERE requests > 1 GROUP BY ts""")
def rate_audit_sliding(spark, sf):
    """Times with more than one event in the last 60 seconds, also across a full minute or hour."""
    return numbering.rate_audit_sliding(table(spark, sf, "events"), "ts", 1)
