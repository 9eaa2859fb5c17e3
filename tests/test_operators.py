import random

import pytest
from pyspark.sql import functions as F

from kontor.operators import attempts, constraints, dedup, filters, joins, numbering, projection, reports, scoring, sizing
from kontor.sources.taxonomy import Taxonomy


def rows(df, *names):
    return sorted((tuple(row[name] for name in names) for row in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- joins ------------------------------------------------------------------------
def test_left_join_matches_missing_keys_and_multiplies(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20), ("a", 21), ("z", 30)], "k string, y int")
    expected = [(None, 1, 10), (None, 2, 10), ("a", 3, 20), ("a", 3, 21), ("b", 4, None)]
    assert rows(joins.left_join_null_safe(left, right, "k"), "k", "x", "y") == sorted(expected, key=repr)


def test_left_join_rejects_clashing_columns(spark):
    frame = spark.createDataFrame([("a", 1)], "k string, x int")
    with pytest.raises(ValueError, match="x"):
        joins.left_join_null_safe(frame, frame, "k")


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    """A third of the left rows hold one key; nothing is lost or doubled."""
    rng = random.Random(1)
    left = spark.createDataFrame(
        [("hot" if rng.random() < 0.33 else f"k{rng.randrange(40)}", i) for i in range(3000)] + [(None, -1)], "k string, x int"
    ).repartition(5)
    right = spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(0, 40, 2)], "k string, y int")
    spread = joins.spread_join(left, right, "k", F.coalesce(F.col("k") == "hot", F.lit(False)), pieces=7, how=how)
    plain = left.join(right.withColumnRenamed("k", "k2"), left.k.eqNullSafe(F.col("k2")), how).drop("k2")
    assert rows(spread, *spread.columns) == rows(plain, *spread.columns)
    if how == "left":
        dealt = left.withColumn("p", F.pmod(F.monotonically_increasing_id(), F.lit(7))).filter("k = 'hot'")
        assert dealt.groupBy("p").count().agg(F.max("count")).first()[0] < 300


@pytest.mark.parametrize("how", ["full", "right", "full_outer", "cross"])
def test_spread_join_rejects_kinds_it_would_double(spark, how):
    frame = spark.createDataFrame([("a", 1)], "k string, x int")
    with pytest.raises(ValueError, match=how):
        joins.spread_join(frame, frame.toDF("k", "y"), "k", F.col("k") == "a", how=how)


def test_last_progress_row_wins(spark):
    frame = spark.createDataFrame([("1", None), ("2", "own")], "IDI string, Category string")
    progress = spark.createDataFrame([("1", "Z", 1), ("1", "A", 2)], "IDI string, Category string, row int")
    merged = joins.merge_progress(frame, progress, labels=["Category"], order=["row"])
    assert rows(merged, "IDI", "Category") == [("1", "A"), ("2", "own")]


def test_softmax_is_one_exchange(spark):
    from kontor.operators.scoring import softmax_scores

    frame = spark.createDataFrame([("a", "x", 1000.0), ("a", "y", 1000.0), ("b", "x", 1.0)], "e string, label string, score double")
    found = softmax_scores(frame, "e")
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert rows(found, "e", "label", "score") == [("a", "x", 0.5), ("a", "y", 0.5), ("b", "x", 1.0)]


def test_anti_join_keeps_missing_right_harmless(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert rows(joins.not_done(left, spark.createDataFrame([("a",), ("a",)], "k string"), "k"), "k") == [("b",), (None,)]
    assert rows(joins.not_done(left, spark.createDataFrame([(None,)], "k string"), "k"), "k") == [("a",), ("b",)]


def test_overlay(spark):
    base = spark.createDataFrame([("a", "1", "x"), ("a", "2", "y"), ("b", "1", "z")], "k string, o string, v string")
    newer = spark.createDataFrame([("a", "0", None)], "k string, o string, v string")
    assert rows(joins.overlay(base, newer, "k", ["o"]), "k", "v") == [("a", None), ("b", "z")]
    assert rows(joins.overlay(base, newer.limit(0), "k", ["o"]), "k", "v") == [("a", "y"), ("b", "z")]


def test_progress_is_matched_by_key_not_position(spark):
    current = spark.createDataFrame([("b",), ("a",), ("c",)], "IDI string")
    done = spark.createDataFrame([("a", "A", "a1"), ("c", None, None)], "IDI string, Category string, Subcategory string")
    assert rows(joins.merge_progress(current, done), "IDI", "Category") == [("a", "A"), ("b", None), ("c", None)]


def test_lookup_keeps_own_id(spark):
    frame = spark.createDataFrame([("n", 1), ("n", 2), ("m", 3), (None, 4)], "name string, id int")
    found = joins.by_distinct_name(frame, "name", lambda names: names.withColumn("len", F.length("name")))
    assert rows(found, "id", "len") == [(1, 1), (2, 1), (3, 1), (4, None)]


def test_reachable_becomes_an_inner_join(spark):
    left = spark.createDataFrame([("a", 1)], "IDI string, x int")
    right = spark.createDataFrame([("a", "p", None, None)], "IDI string, `Phone Numbers` string, Email string, Website string")
    optimised = filters.with_any(joins.merge_contacts(left, right))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in optimised and "LeftOuter" not in optimised


# --- dedup ------------------------------------------------------------------------
def test_keep_first(spark):
    frame = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), (None, 5, "q"), (None, 4, "p")], "k string, o int, v string")
    assert rows(dedup.first_per_key(frame, "k", "o"), "k", "v") == [("a", "x"), (None, "p")]
    assert tuple(dedup.dedup_report(frame, "k").first()) == (4, 2, 2)
    assert dedup.has_duplicates(frame, "k") and not dedup.has_duplicates(frame, ["k", "o"])
    assert tuple(dedup.dedup_report(frame.limit(0), "k").first()) == (0, 0, 0)


def test_hot_key_is_cut_before_the_exchange(spark):
    hot = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id")
    found = dedup.first_per_key(hot, "k", "id")
    text = plan(found)
    assert text.count("WindowGroupLimit") == 2
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")
    assert found.filter("k = -1").first()["id"] == 0


def test_first_current(spark):
    frame = spark.createDataFrame(
        [("a", 1, True, 3, "old"), ("a", 2, False, 2, "narrow"), ("a", 3, None, 3, "now"), ("a", 4, False, 3, "later"), ("b", 1, True, 3, "x")],
        "e string, pos int, struck boolean, width int, v string",
    )
    found = dedup.first_current(frame, "e", "pos", F.col("struck"), F.col("v"), "current", F.col("width") == 3)
    assert rows(found, "e", "current") == [("a", "now")]


# --- numbering --------------------------------------------------------------------
def shuffled(spark, n, partitions):
    """A third of the rows share one order value, told apart by the second column."""
    values = [(0 if i % 3 == 0 else i, i, i % 7) for i in range(n)]
    random.Random(2).shuffle(values)
    return spark.createDataFrame(values, "a int, b int, v int").repartition(partitions)


def test_numbers_are_dense_and_ordered(spark):
    frame = shuffled(spark, 5000, 6)
    found = {(r["a"], r["b"]): r["row_no"] for r in numbering.number_rows(frame, ["a", "b"]).collect()}
    assert found == {key: i + 1 for i, key in enumerate(sorted(found))}


def test_numbers_over_many_slices(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = shuffled(spark, 3000, 3)
        total = numbering.running_total(frame, ["a", "b"], "v", "t").collect()
        batched = numbering.batches(frame, ["a", "b"], 50)
        assert batched.groupBy("batch_no").count().filter("count <> 50").isEmpty()
        assert sizing.written(frame.repartition(4)).rdd.getNumPartitions() >= 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    so_far = 0
    for row in sorted(total, key=lambda r: (r["a"], r["b"])):
        so_far += row["v"]
        assert row["t"] == so_far


def test_numbering_has_no_window_over_all_rows(spark):
    text = plan(numbering.number_rows(shuffled(spark, 300, 3), ["a", "b"]))
    assert "Window [row_number" not in text


def test_empty_numbering(spark):
    assert numbering.number_rows(spark.createDataFrame([], "a int"), ["a"]).count() == 0


def test_surrogate_ids_by_first_appearance(spark):
    frame = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3), (None, 0), ("c", 4)], "k string, o int")
    assert rows(numbering.surrogate_ids(frame, ["k"], "o", "id"), "k", "id") == [("a", 2), ("b", 1), ("c", 3)]


def test_rate_audit(spark):
    log = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:10' + make_interval(0,0,0,0,0,0,30*id) AS ts FROM range(5)")
    assert [row["requests"] for row in numbering.rate_audit(log, "ts", 1).collect()] == [2, 2]


# --- reports ----------------------------------------------------------------------
def test_distribution_counts_unlabelled_rows_in_the_total(spark):
    frame = spark.createDataFrame([("A", "a"), ("A", None), (None, None), ("B", "b")], "c string, s string")
    assert rows(reports.value_counts(frame, "c"), "c", "n") == [("A", 2), ("B", 1)]
    assert rows(reports.distribution(frame, "c"), "c", "percent") == [("A", 50.0), ("B", 25.0), (None, 25.0)]
    assert rows(reports.two_level_distribution(frame, "c", "s"), "level", "c", "s", "n", "percent") == [
        (1, "A", None, 2, 50.0), (1, "B", None, 1, 25.0), (2, "A", "a", 1, 50.0), (2, "B", "b", 1, 100.0)]


def test_top_values_take_only_k(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    top = reports.top_values(frame, "v", 2)
    assert [tuple(row) for row in top.collect()] == [("c", 2), ("a", 1)]
    assert "TakeOrderedAndProject" in plan(top)


def test_token_estimate_of_nothing(spark):
    empty = spark.createDataFrame([], "n string, p string")
    row = reports.token_estimate(empty, "n", "p", 7).first()
    assert row["average_tokens_per_company"] == 0 and row["total_estimated_tokens"] == 0
    some = reports.token_estimate(spark.createDataFrame([("abcd", None)], "n string, p string"), "n", "p", 7).first()
    assert some["total_estimated_tokens"] == 7 + 1 + 0 + 20


def test_null_profile(spark):
    frame = spark.createDataFrame([("x", None), (None, None)], "a string, b string")
    assert rows(reports.null_profile(frame, ["a", "b"]), "column", "present", "missing") == [("a", 1, 1), ("b", 0, 2)]


# --- projection and filters -------------------------------------------------------
def test_names(spark):
    frame = spark.createDataFrame([("x", "y")], "`Phone Numbers` string, IDI string")
    assert projection.normalise_names(frame).columns == ["phone_numbers", "idi"]
    with pytest.raises(ValueError, match="idi"):
        projection.require_distinct_names(["idi", "IDI"])
    assert projection.drop_if_present(frame, ["idi", "nothing"]).columns == ["Phone Numbers", "IDI"]
    assert projection.all_but(frame, ["IDI", "x"], "IDI").columns == ["Phone Numbers", "IDI"]
    assert projection.ensure_columns(frame, {"IDI": "z", "Category": None}).columns == ["Phone Numbers", "IDI", "Category"]


def test_pending(spark):
    frame = spark.createDataFrame(
        [("Other", "Other"), (None, None), ("Other", None), ("A", "Other"), ("Other", "a")], "Category string, Subcategory string"
    )
    is_open = filters.sentinel_pending()
    assert frame.filter(is_open).count() == 3 and frame.filter(~is_open).count() == 2
    valid, rejected = filters.split_by(frame, F.col("Category") == "A")
    assert (valid.count(), rejected.count()) == (1, 4)


def test_drop_failed(spark):
    frame = spark.sql("SELECT 1 id, named_struct('a', 'x', 'b', cast(null as string)) r UNION ALL "
                      "SELECT 2, named_struct('a', cast(null as string), 'b', cast(null as string)) UNION ALL SELECT 3, null")
    assert rows(filters.drop_failed(frame, "r"), "id") == [(1,)]


# --- constraints, sizes -----------------------------------------------------------
def test_constraints_find_breaches(spark):
    companies = spark.createDataFrame([("a",), ("a",), (None,)], "IDI string")
    categories = spark.createDataFrame([(1, "A"), (2, "A"), (3, None), (4, None)], "category_id bigint, Category string")
    subcategories = spark.createDataFrame([(1, 1, "x"), (2, 1, "x"), (3, 9, "y")], "subcategory_id bigint, category_id bigint, Subcategory string")
    links = spark.createDataFrame([("a", 1, 1), ("z", 8, None)], "IDI string, category_id bigint, subcategory_id bigint")
    found = {r["constraint"]: r["violations"] for r in constraints.model_report(companies, categories, subcategories, links).collect()}
    assert found == {
        "pk_companies": 2, "pk_categories": 0, "uq_category": 1, "pk_subcategories": 0, "uq_subcategory": 1,
        "pk_company_categories": 0, "fk_subcategory_category": 1, "fk_link_company": 1, "fk_link_category": 1,
        "fk_link_subcategory": 0,
    }


# --- scores and attempts ----------------------------------------------------------
def test_best_label_ties(spark):
    frame = spark.createDataFrame([(1, "b", 0.5), (1, "a", 0.5), (2, "z", 0.9), (2, "y", 0.1)], "e int, label string, score double")
    assert rows(scoring.best_label(frame, "e"), "e", "label", "score") == [(1, "a", 0.5), (2, "z", 0.9)]
    found = scoring.softmax_scores(frame.withColumn("score", F.col("score") * 1000), "e")
    assert [round(row[0], 9) for row in found.groupBy("e").agg(F.sum("score")).select("sum(score)").collect()] == [1, 1]


def two_level(spark):
    nested = spark.sql(
        "SELECT array(named_struct('category','A','subcategories',array('a1','a2')), "
        "named_struct('category','B','subcategories',cast(array() as array<string>))) AS categories"
    )
    return Taxonomy.from_nested(nested)


def outcome_by_hand(log, tries=3):
    """The retry rule, call by call."""
    labels = {"A": ["a1", "a2"], "B": []}
    for attempt in range(1, tries + 1):
        last = attempt == tries
        if (1, attempt) not in log:
            return (None, None)
        text, error = log[1, attempt]
        if error:
            if last:
                return ("Other", "Other")
            continue
        category = text.strip()
        if category not in labels:
            return ("Other", "Other")
        if not labels[category]:
            return (category, category)
        if (2, attempt) not in log:
            return (None, None)
        text, error = log[2, attempt]
        if error:
            if last:
                return (category, category)
            continue
        sub = text.strip()
        return (category, sub if sub in labels[category] else category)


def test_two_stage_attempts_against_the_rule(spark):
    rng = random.Random(3)
    logs = {}
    for entity in range(300):
        log = {}
        for attempt in range(1, rng.choice([2, 3, 3, 3, 4]) + 1):
            for stage, replies in ((1, ["A", " A\n", "B", "X", ""]), (2, ["a1", "a2 ", "x"])):
                log[stage, attempt] = (None, "timeout") if rng.random() < 0.5 else (rng.choice(replies), None)
        logs[entity] = log
    table = spark.createDataFrame(
        [(e, a, s, text, error) for e, log in logs.items() for (s, a), (text, error) in log.items()],
        "entity int, attempt int, stage int, text string, error string",
    ).repartition(4)
    found = {r["entity"]: (r["category"], r["subcategory"]) for r in attempts.two_stage_outcome(table, "entity", two_level(spark)).collect()}
    assert found == {entity: outcome_by_hand(log) for entity, log in logs.items()}


def test_single_prompt_attempts(spark):
    log = spark.createDataFrame([
        (1, 1, None, "429 slow"), (1, 2, "Category: A\nSubcategory: a1", None),
        (2, 1, None, "429"), (2, 2, None, "429"), (2, 3, None, "429"), (2, 4, "Category: A\nSubcategory: a1", None),
        (3, 1, None, "500"), (3, 2, "Category: A\nSubcategory: a1", None), (4, 1, "", None),
    ], "e int, attempt int, text string, error string")
    from kontor.plans.classification import single_outcome

    assert rows(single_outcome(log, "e", two_level(spark)), "e", "category", "subcategory") == [
        (1, "A", "a1"), (2, None, None), (3, "Other", "Other"), (4, "Other", "Other")]


def test_scorer_loads_once_and_skips_unasked_rows(spark):
    def load():
        def model(texts, labels):
            assert all(texts) and all(labels)
            return [[float(len(text) + i) for i, _ in enumerate(names)] for text, names in zip(texts, labels)]
        return model

    frame = spark.createDataFrame([("ab", ["x", "y"]), (None, ["x"]), ("c", None), ("d", [])], "t string, l array<string>")
    found = [row[0] for row in frame.select(scoring.scorer(load)(F.col("t"), F.col("l"))).collect()]
    assert found == [[2.0, 3.0], None, None, None]


# --- taxonomy ---------------------------------------------------------------------
def test_taxonomy(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{\n"categories": [{"category": "Z & Y", "subcategories": ["b", "a"]},\n {"category": "A", "subcategories": ["b"]}]}')
    taxonomy = Taxonomy.read_json(spark, str(path))
    assert rows(taxonomy.pairs(), "position", "category", "sub_position", "subcategory") == [
        (0, "Z & Y", 0, "b"), (0, "Z & Y", 1, "a"), (1, "A", 0, "b")]
    one = spark.range(1).select(taxonomy.text().alias("t"), taxonomy.categories_text().alias("c"), taxonomy.labels().alias("l")).first()
    assert tuple(one) == ("\nZ & Y:\nb, a\n\nA:\nb\n", "Z & Y, A", ["Z & Y", "A"])
    claimed = spark.createDataFrame([("Z & Y", "a"), ("A", "a"), ("z & y", "a"), (None, None)], "c string, s string")
    assert rows(taxonomy.known(claimed, "c", "s"), "c", "known") == [("A", False), ("Z & Y", True), ("z & y", False), (None, False)]


def test_taxonomy_join_has_no_hint(spark):
    nested = spark.sql("SELECT transform(sequence(1, 50), i -> named_struct('category', string(i), 'subcategories', array('x'))) AS categories")
    taxonomy = Taxonomy.from_nested(nested)
    assert taxonomy.known(spark.createDataFrame([("7", "x")], "c string, s string"), "c", "s").first()["known"]


# --- skew -------------------------------------------------------------------------
def test_hot_join_key_is_split_by_size(spark):
    """A third of the rows hold one id: the null-safe join is planned as a skew join."""
    low = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in low}
    for key, value in low.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 != 0, F.concat(F.lit("k"), F.col("id"))).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"))
        right = spark.range(0, 50_000, 1, 8).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") * 2).alias("y")).union(
            spark.sql("SELECT cast(null AS string), -1L"))
        joined = joins.left_join_null_safe(left, right, "k")
        # Two joins on one key: the exchange the split costs is accepted.
        twice = joins.left_join_null_safe(joined, right.withColumnRenamed("y", "z"), "k")
        assert twice.filter("k IS NULL AND y = -1 AND z = -1").count() == 66_667
        for frame in (joined, twice):
            result = frame.groupBy("y").agg(F.max("pad"))
            result.collect()
            assert plan(result).split("Initial Plan")[0].count("skew=true") >= 1
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_spread_join_deals_the_same_after_a_new_fetch_order(spark):
    """The pieces do not depend on the order in which a task gets its rows."""
    frame = spark.createDataFrame([(None, i // 4) for i in range(400)], "k string, x int").coalesce(1)
    right = spark.createDataFrame([(None, 1)], "k string, y int")

    def pieces(rows):
        joined = joins.spread_join(rows, right, "k", F.col("k").isNull(), pieces=5)
        dealt = joined._jdf.queryExecution().analyzed().toString()
        assert "xxhash64" in dealt
        return joined.count()

    assert pieces(frame) == pieces(frame.orderBy(F.desc("x")).coalesce(1)) == 400


def test_counts_come_along(spark):
    frame, seen = reports.observed(spark.range(7))
    frame.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 7
