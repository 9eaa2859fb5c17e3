"""Classification as dataflow.

The model stays outside: these functions make request tables and read reply or
score tables.  Only `by_scores` calls a model itself, through the scorer hook.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions.prompts import category_prompt, single_prompt, subcategory_prompt
from kontor.functions.replies import checked_pair, two_lines
from kontor.functions.scores import best, cascade, pair_up, softmax
from kontor.functions.text import model_text, strip
from kontor.operators.attempts import first_decisive, two_stage_outcome
from kontor.operators.filters import pending, sentinel_pending
from kontor.operators.joins import left_join_null_safe, merge_progress, not_done
from kontor.operators.numbering import batches
from kontor.operators.projection import ensure_columns, quoted
from kontor.operators.reports import two_level_distribution
from kontor.operators.sizing import written
from kontor.sources.tabular import append_csv, as_text, scan_or_empty
from kontor.sources.taxonomy import Taxonomy

LABELS = ("Category", "Subcategory")
# The original saves after a handful of rows, one after the other; here many are asked at once.
ROWS_AT_ONCE = V.SINGLE_PROMPT_BATCH * 2_000


# --- score based --------------------------------------------------------------
def by_scores(
    df: DataFrame, name: str, purpose: str, taxonomy: Taxonomy, score, min_score: float = V.MIN_SCORE
) -> DataFrame:
    """Two-stage zero-shot classification with a scorer from `operators.scoring.scorer`.

    The candidates of a row travel in the row: all categories first, then only the
    subcategories of the category it got.  Rows below the threshold are not scored
    again.
    """
    first = df.withColumn("__text", model_text(name, purpose)).withColumn("__labels", taxonomy.labels())
    first = first.withColumn("__scores", score(F.col("__text"), F.col("__labels")))
    first = first.withColumn("__one", best(softmax(pair_up("__labels", "__scores"))))
    first = first.withColumns({"__category": F.col("__one.label"), "__score": F.col("__one.score")})
    second = taxonomy.add_labels(first.drop("__labels", "__scores"), "__category", "__subs")
    second = second.withColumn("__asked", F.when(F.col("__score") >= min_score, F.col("__subs")))
    second = second.withColumn("__scores", score(F.col("__text"), F.col("__asked")))
    second = second.withColumn("__two", best(softmax(pair_up("__asked", "__scores"))))
    outcome = cascade("__category", "__score", F.col("__two.label"), F.col("__two.score"), min_score)
    kept = [quoted(c) for c in df.columns if c not in LABELS]
    return second.withColumn("__o", outcome).select(
        *kept, F.col("__o.category").alias("Category"), F.col("__o.subcategory").alias("Subcategory")
    )


# --- single prompt --------------------------------------------------------------
def single_requests(df: DataFrame, key: str, name: str, purpose: str, taxonomy: Taxonomy) -> DataFrame:
    return df.select(
        quoted(key), single_prompt(quoted(name), quoted(purpose), taxonomy.text()).alias("prompt")
    )


def parse_replies(replies: DataFrame, taxonomy: Taxonomy, text: str = "text") -> DataFrame:
    """Adds `category, subcategory` of two-line replies, checked against the taxonomy.

    A reply without a second line, or no reply, gives (unknown, unknown).
    """
    parsed = replies.withColumn("__pair", two_lines(text)).withColumn("__category", F.col("__pair.category"))
    listed = taxonomy.add_labels(parsed, "__category", "__labels")
    checked = checked_pair("__category", F.col("__pair.subcategory"), F.col("__labels"))
    return listed.withColumn("__o", checked).select(
        *(quoted(c) for c in replies.columns),
        F.col("__o.category").alias("category"), F.col("__o.subcategory").alias("subcategory"),
    )


def single_outcome(attempts: DataFrame, entity: str, taxonomy: Taxonomy, tries: int = V.MAX_ATTEMPTS) -> DataFrame:
    """Labels of each entity from its attempts; NULL labels if all tries hit the rate limit."""
    decided = parse_replies(first_decisive(attempts, entity, tries), taxonomy)
    settled = F.col("attempt").isNotNull()
    return decided.select(
        quoted(entity), F.when(settled, F.col("category")).alias("category"),
        F.when(settled, F.col("subcategory")).alias("subcategory"),
    )


# --- two prompts ----------------------------------------------------------------
def category_requests(df: DataFrame, key: str, name: str, purpose: str, taxonomy: Taxonomy) -> DataFrame:
    prompt = category_prompt(quoted(name), quoted(purpose), taxonomy.categories_text())
    return df.select(quoted(key), F.lit(1).alias("stage"), prompt.alias("prompt"))


def subcategory_requests(
    df: DataFrame, key: str, name: str, purpose: str, reply: str, taxonomy: Taxonomy
) -> DataFrame:
    """Second requests, only for valid first replies whose category has subcategories."""
    answered = taxonomy.add_labels(df.withColumn("__category", strip(quoted(reply))), "__category", "__labels")
    asked = answered.filter(F.size("__labels") > 0)
    prompt = subcategory_prompt(quoted(name), quoted(purpose), F.col("__category"), F.col("__labels"))
    return asked.select(quoted(key), F.lit(2).alias("stage"), prompt.alias("prompt"))


def two_prompt_outcome(attempts: DataFrame, entity: str, taxonomy: Taxonomy, tries: int = V.MAX_ATTEMPTS) -> DataFrame:
    return two_stage_outcome(attempts, entity, taxonomy, tries)


# --- the driver -----------------------------------------------------------------
def prepare(df: DataFrame, progress: DataFrame | None, key: str) -> DataFrame:
    """Label columns present, earlier labels filled in by key."""
    rows = ensure_columns(df, dict.fromkeys(LABELS))
    return rows if progress is None else merge_progress(rows, progress, key, LABELS)


def request_batches(
    rows: DataFrame, order: Sequence[str], size: int, is_pending: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Pending rows cut into numbered batches: the order's columns and those to `keep`, no others are written."""
    open_rows = rows.filter(pending() if is_pending is None else is_pending)
    return batches(open_rows.select(*(quoted(name) for name in dict.fromkeys([*order, *keep]))), order, size)


def apply_labels(rows: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """New labels written over the rows they belong to; the rest stays as it was."""
    new = labels.select(quoted(key), F.col("category").alias("__c"), F.col("subcategory").alias("__s"))
    joined = left_join_null_safe(rows, new, key)
    fresh = F.col("__c").isNotNull()
    return joined.withColumns({
        "Category": F.when(fresh, F.col("__c")).otherwise(F.col("Category")),
        "Subcategory": F.when(fresh, F.col("__s")).otherwise(F.col("Subcategory")),
    }).drop("__c", "__s")


def run_single_prompt(
    rows: DataFrame, progress: DataFrame | None, key: str, name: str, purpose: str, taxonomy: Taxonomy,
    answer: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """One whole round: earlier labels, requests for the pending rows, replies, labels.

    `answer` stands for the outside model: from `key, prompt` to an attempts table
    `key, attempt, text, error`.  Its result is written once, so no request goes out
    twice.  Rows that were only rate-limited stay pending for the next round.
    """
    prepared = prepare(rows, progress, key)
    requests = single_requests(prepared.filter(pending(needed=purpose)), key, name, purpose, taxonomy)
    replies = written(answer(requests), "replies")
    return apply_labels(prepared, single_outcome(replies, key, taxonomy), key)


def _saved(
    rows: DataFrame, progress: DataFrame | None, key: str, is_pending: Column,
    ask: Callable[[DataFrame], tuple[DataFrame, DataFrame | None]], output: str, errors: str | None, size: int,
    rounds: int | None, report: Callable[[dict], None] | None,
) -> DataFrame:
    """A round batch by batch: the labels `ask` gives for the rows of a batch are saved before the next one begins.

    `ask` gives labels (key, category, subcategory) and failed attempts (key, attempt, error) or None.  A
    failure that `errors` holds already, as its batch broke off before its labels were saved, is not
    added again.  `report` is told the number of each batch and what was written, counted on the way.
    """
    spark = rows.sparkSession
    known = prepare(rows, progress, key)
    if not known.filter(quoted(key).isNull()).isEmpty():
        raise ValueError(f"rows without {key} cannot be saved batch by batch: their labels would find no way back")

    def with_saved() -> DataFrame:
        return prepare(known, scan_or_empty(spark, output, [key, *LABELS]), key)

    prepared = with_saved()
    open_keys = prepared.filter(is_pending).select(quoted(key)).distinct()
    numbered = written(batches(open_keys, [key], size), "open-rows")
    last = numbered.agg(F.max("batch_no")).first()[0]
    found = 0 if last is None else last + 1
    for number in range(found if rounds is None else min(found, rounds)):
        asked = prepared.join(numbered.filter(F.col("batch_no") == number).select(quoted(key)), key)
        labels, failed = ask(asked)
        done = {"batch": number, "failed": 0}
        if failed is not None:
            before = scan_or_empty(spark, errors, [key, "attempt", "error"])
            done["failed"] = append_csv(not_done(as_text(failed.select(quoted(key), "attempt", "error")), before, [key, "attempt"]), errors)
        done["labelled"] = append_csv(labels.select(quoted(key), "category", "subcategory").toDF(key, *LABELS), output)
        if report is not None:
            report(done)
    return with_saved()


def run_saved(
    rows: DataFrame, progress: DataFrame | None, key: str, name: str, purpose: str, taxonomy: Taxonomy,
    answer: Callable[[DataFrame], DataFrame], output: str, errors: str, size: int = ROWS_AT_ONCE,
    rounds: int | None = None, report: Callable[[dict], None] | None = None,
) -> DataFrame:
    """The single-prompt round batch by batch, each one's labels saved before the next is asked.

    Labels go to the CSV folder `output`, failed attempts to `errors`.  A run that breaks off,
    or stops after `rounds` batches, goes on with the rows that have no label yet; rows that
    were only rate-limited are asked again.  Only keys are numbered; a row without a key
    raises.  Returns all rows.
    """
    def ask(asked: DataFrame):
        replies = written(answer(single_requests(asked, key, name, purpose, taxonomy)), "replies")
        labels = single_outcome(replies, key, taxonomy).filter(F.col("category").isNotNull())
        return labels, replies.filter(F.col("error").isNotNull())

    return _saved(rows, progress, key, pending(needed=purpose), ask, output, errors, size, rounds, report)


def run_two_prompts_saved(
    rows: DataFrame, progress: DataFrame | None, key: str, taxonomy: Taxonomy, answer: Callable[[DataFrame], DataFrame],
    output: str, errors: str, size: int = ROWS_AT_ONCE, rounds: int | None = None,
    report: Callable[[dict], None] | None = None,
) -> DataFrame:
    """The two-prompt round batch by batch, as `run_saved`; a later run asks (unknown, unknown) rows again, too.

    `attempt` of a failure names its stage as well, as each stage counts its own.
    """
    def ask(asked: DataFrame):
        replies = written(answer(asked), "replies")
        labels = two_prompt_outcome(replies, key, taxonomy).filter(F.col("category").isNotNull())
        place = F.concat_ws(".", "stage", "attempt").alias("attempt")
        return labels, replies.filter(F.col("error").isNotNull()).select(quoted(key), place, "error")

    return _saved(rows, progress, key, sentinel_pending(*LABELS), ask, output, errors, size, rounds, report)


def run_by_scores_saved(
    rows: DataFrame, progress: DataFrame | None, key: str, name: str, purpose: str, taxonomy: Taxonomy, score, output: str,
    min_score: float = V.MIN_SCORE, size: int = ROWS_AT_ONCE, rounds: int | None = None,
    report: Callable[[dict], None] | None = None,
) -> DataFrame:
    """The score-based round batch by batch, as `run_saved`; the scorer answers always, so there are no failures."""
    def ask(asked: DataFrame):
        scored = by_scores(asked.select(quoted(key), quoted(name), quoted(purpose)), name, purpose, taxonomy, score, min_score)
        labels = scored.select(quoted(key), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory"))
        return written(labels, "labels"), None

    return _saved(rows, progress, key, pending(needed=purpose), ask, output, None, size, rounds, report)


def run_two_prompts(
    rows: DataFrame, progress: DataFrame | None, key: str, taxonomy: Taxonomy,
    answer: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The same with two prompts; pending are rows with unknown or missing labels, with or without a text.

    `answer` takes the pending rows and gives `key, attempt, stage, text, error`.
    """
    prepared = prepare(rows, progress, key)
    replies = written(answer(prepared.filter(sentinel_pending(*LABELS))), "replies")
    return apply_labels(prepared, two_prompt_outcome(replies, key, taxonomy), key)


def run_by_scores(
    rows: DataFrame, progress: DataFrame | None, key: str, name: str, purpose: str, taxonomy: Taxonomy, score,
    min_score: float = V.MIN_SCORE,
) -> DataFrame:
    """The same with a scorer; the labels are written once, so no text is scored twice."""
    prepared = prepare(rows, progress, key)
    asked = prepared.filter(pending(needed=purpose)).select(quoted(key), quoted(name), quoted(purpose))
    scored = by_scores(asked, name, purpose, taxonomy, score, min_score)
    labels = scored.select(quoted(key), F.col("Category").alias("category"), F.col("Subcategory").alias("subcategory"))
    return apply_labels(prepared, written(labels, "labels"), key)


def statistics(rows: DataFrame) -> DataFrame:
    return two_level_distribution(rows, *LABELS)
