from pyspark.sql import functions as F

from kontor.functions.text import percent_text
from kontor.operators.scoring import scorer
from kontor.plans import classification, normalised, register
from kontor.sources import tabular
from kontor.sources.taxonomy import Taxonomy


def rows(df, *names):
    return sorted((tuple(row[name] for name in names) for row in df.collect()), key=repr)


def two_level(spark):
    return Taxonomy.from_nested(spark.sql(
        "SELECT array(named_struct('category','A','subcategories',array('a1','a2')), "
        "named_struct('category','B','subcategories',array('b1'))) AS categories"))


def companies(spark):
    return spark.createDataFrame(
        [("1", "n1", "p"), ("2", "n2", "p"), ("3", "n3", None), ("4", "n4", "p"), ("5", "n5", "p")], "IDI string, Ditta string, Purpose string")


LABELLED = "IDI string, Category string, Subcategory string"


def test_single_prompt_round_and_resume(spark):
    def answer(requests):
        good = "Category: B\nSubcategory: b1"
        return requests.select(
            "IDI", F.lit(1).alias("attempt"), F.when(F.col("IDI") != "5", good).alias("text"),
            F.when(F.col("IDI") == "5", "429").alias("error"))

    done = spark.createDataFrame([("2", "A", "a1"), ("9", "A", "a1")], LABELLED)
    first = classification.run_single_prompt(companies(spark), done, "IDI", "Ditta", "Purpose", two_level(spark), answer)
    expected = [("1", "B", "b1"), ("2", "A", "a1"), ("3", None, None), ("4", "B", "b1"), ("5", None, None)]
    assert rows(first, "IDI", "Category", "Subcategory") == expected
    asked = []

    def second_answer(requests):
        asked.extend(row["IDI"] for row in requests.collect())
        return answer(requests)

    again = classification.run_single_prompt(companies(spark), first, "IDI", "Ditta", "Purpose", two_level(spark), second_answer)
    assert rows(again, "IDI", "Category", "Subcategory") == expected and asked == ["5"]


def test_two_prompt_round_asks_unknown_rows_again(spark):
    asked = []

    def answer(pending):
        asked.extend(sorted(row["IDI"] for row in pending.collect()))
        one = pending.select("IDI", F.lit(1).alias("attempt"), F.lit(1).alias("stage"), F.lit("A").alias("text"), F.lit(None).cast("string").alias("error"))
        return one.unionByName(one.withColumn("stage", F.lit(2)).withColumn("text", F.lit("a2")))

    done = spark.createDataFrame([("1", "Other", "Other"), ("2", "B", "b1")], LABELLED)
    found = classification.run_two_prompts(companies(spark), done, "IDI", two_level(spark), answer)
    assert asked == ["1", "3", "4", "5"]
    assert rows(found, "IDI", "Subcategory") == [("1", "a2"), ("2", "b1"), ("3", "a2"), ("4", "a2"), ("5", "a2")]


def test_score_round(spark):
    def load():
        return lambda texts, labels: [[9.0 if name in ("B", "b1") else 0.0 for name in names] for names in labels]

    found = classification.run_by_scores(companies(spark), None, "IDI", "Ditta", "Purpose", two_level(spark), scorer(load))
    assert rows(found, "IDI", "Category", "Subcategory")[:3] == [("1", "B", "b1"), ("2", "B", "b1"), ("3", None, None)]
    stats = classification.statistics(found)
    assert rows(stats, "level", "Category", "n") == [(1, "B", 4), (2, "B", 4)]


def test_low_scores_are_not_asked_again(spark):
    def load():
        def model(texts, labels):
            assert all(names == ["A", "B"] for names in labels), labels
            return [[0.0, 0.0] for _ in labels]
        return model

    # 0.5 passes the threshold, so ask for more
    found = classification.by_scores(companies(spark), "Ditta", "Purpose", two_level(spark), scorer(load), 0.6)
    assert {row["Category"] for row in found.collect()} == {"Other"}


RESULT = "<table><thead><tr><th>Ditta</th><th>IDI</th><th>Estratto cantonale</th></tr></thead><tbody><tr><td>{0}</td><td>CHE-000.000.00{1}</td><td><a href='u{1}'>x</a></td></tr></tbody></table>"
EXTRACT = "<div id='idAuszugForm:auszugContentPanel'><table><tr><th>1</th><th>2</th><th>Purpose</th></tr><tr><td></td><td></td><td>does {0}</td></tr></table>"


def test_register_collection_is_incremental(spark, tmp_path):
    listing, output = str(tmp_path / "list"), str(tmp_path / "extracts")
    first = spark.createDataFrame([(1, RESULT.format("A", 1)), (2, "<p>no table</p>")], "page_id int, html string")
    second = spark.createDataFrame([(3, RESULT.format("B", 2))], "page_id int, html string")
    extracts = spark.createDataFrame([("u1", EXTRACT.format("one")), ("u2", EXTRACT.format("two"))], "url string, html string")
    found = register.collect_results(spark, first, listing)
    assert rows(register.collect_extracts(spark, found, extracts, output), "source_idi", "Purpose") == [("CHE-000.000.001", "does one")]
    found = register.collect_results(spark, second, listing)
    assert found.columns == ["Ditta", "Estratto cantonale", "IDI", "page", "position"] and found.count() == 2
    found = register.collect_results(spark, first.unionByName(second), listing)
    assert found.count() == 2
    for _ in range(2):
        all_rows = register.collect_extracts(spark, found, extracts, output)
    assert rows(all_rows, "source_idi", "Purpose") == [("CHE-000.000.001", "does one"), ("CHE-000.000.002", "does two")]
    assert all_rows.columns == register.EXTRACT_COLUMNS


def test_schema_is_created_once(spark):
    for _ in range(2):
        normalised.create_schema(spark)
    assert spark.table("company_categories").columns == ["IDI", "category_id", "subcategory_id"]
    assert spark.table("companies").columns[2] == "Forma giuridica"


def test_rejects_go_to_their_own_sink(spark, tmp_path):
    frame = spark.createDataFrame([("1", "x"), ("2", None)], "k string, v string")
    tabular.write_with_rejects(frame, F.col("v") == "x", str(tmp_path / "ok"), str(tmp_path / "error_ok"))
    assert rows(tabular.scan_csv(spark, str(tmp_path / "error_ok")), "k") == [("2",)]


def test_percent_text(spark):
    assert spark.range(1).select(percent_text(F.lit(1), F.lit(8))).first()[0] == "12.5%"
