import datetime
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.functions import contacts, dates, links, prompts, replies, scores, text


def values(spark, rows, expression, schema="v string"):
    frame = spark.createDataFrame([(row,) for row in rows], schema)
    return [row[0] for row in frame.select(expression(F.col("v"))).collect()]


def test_register_id(spark):
    rows = ["CHE-123.456.789", "CHE-123.456.789 (x)", "CHE-12.456.789", "", None]
    assert values(spark, rows, contacts.register_id) == ["CHE-123.456.789", "CHE-123.456.789", None, None, None]


def test_registration_date(spark):
    rows = [
        "Registered on 05.03.1999", "x Registered on 05.03.1999, y", "Registered on 31.02.2020",
        "Registered on 01.01.1799", "Registered on 01.01.1800", "Registered on 31.12.2030",
        "Registered on 01.01.2031", "Registered on 5.3.1999", "05.03.1999", None,
    ]
    day = datetime.date
    assert values(spark, rows, dates.registration_date) == [
        day(1999, 3, 5), day(1999, 3, 5), None, None, day(1800, 1, 1), day(2030, 12, 31), None, None, None, None,
    ]


def test_phone(spark):
    rows = ["091 123 45 67", "+41 91 123 45 67", "www.a1234567890.ch", ""]
    assert values(spark, rows, contacts.is_phone) == [True, False, True, False]
    assert values(spark, rows[:1], contacts.digits) == ["0911234567"]


def test_email_link(spark):
    rows = ["mailto:a@b.ch", "mailto: a@b.ch \n", "mailto:a@b.ch?subject=x", "mailto:a@b", "mailto:a@b.c", None]
    assert values(spark, rows, contacts.email_from_link) == ["a@b.ch", "a@b.ch", None, None, None, None]
    assert values(spark, ["a@b.ch\n"], contacts.is_email) == [False]


def test_website(spark):
    rows = ["www.A.ch", "HTTP://A.ch", " www.a.ch", "ftp://a.ch"]
    assert values(spark, rows, contacts.is_website) == [True, True, False, False]
    assert values(spark, rows[:2], contacts.normalise_website) == ["https://www.a.ch", "http://a.ch"]


def route(spark, blocks, hrefs):
    frame = spark.createDataFrame([(blocks, hrefs)], "b array<string>, h array<string>")
    row = frame.select(contacts.route_blocks("b", "h").alias("r")).first()["r"]
    return row["phone_numbers"], row["email"], row["website"]


def test_router(spark):
    blocks = ["091 123 45 67", "www.one.ch", "091 765 43 21", "091 123 45 67", "HTTPS://two.ch", "free text"]
    assert route(spark, blocks, ["/x", "mailto:a@b.ch", "mailto:c@d.ch"]) == (
        ["0911234567", "0917654321", "0911234567"], "a@b.ch", "https://two.ch")
    assert route(spark, [], []) == ([], None, None)
    # a phone by its ten digits, an address as written
    misfiled = ["x1234567890@b.ch", "091 123 45 67", "x1234567890@b.ch"]
    assert route(spark, misfiled, []) == (["0911234567", "1234567890"], "x1234567890@b.ch", None)
    assert route(spark, misfiled, ["mailto:broken"]) == (["1234567890", "0911234567", "1234567890"], None, None)
    assert route(spark, ["www.a1234567890.ch"], []) == (["1234567890"], None, None)


def test_links(spark):
    base = "https://h.ch"
    cases = {
        "/p": "https://h.ch/p", "p": "https://h.ch/p", "//o.ch/x": "https://o.ch/x", "http://o.ch/x": "http://o.ch/x",
        "?q=1": "https://h.ch?q=1", "": None, "mailto:a@b.ch": "mailto:a@b.ch", "./p": "https://h.ch/p",
    }
    assert values(spark, list(cases), lambda c: links.resolve(F.lit(base), c)) == list(cases.values())


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_categories=["Cs", "Co", "Cn"]), max_size=20), min_size=1, max_size=20))
def test_form_encoding_is_quote_plus(spark, rows):
    from urllib.parse import quote_plus

    assert values(spark, rows, links.form_encode) == [quote_plus(row) for row in rows]


def plain_clean(line):
    """The cleaning rule, character by character."""
    kept = "".join(
        c if c.isspace() or c == "_" or unicodedata.category(c)[0] in "LN" else " " for c in line.lower()
    )
    kept = "".join(c for c in kept if unicodedata.category(c) != "Nd")
    return " ".join(word for word in kept.split() if word not in V.STOP_WORDS)


@pytest.mark.parametrize("line", [
    "The Cafe\u0301 of Milano", "a‿b", "x² ٣ 12", "no\u00a0break", "Straße İstanbul", "a\x1cb", "für für the und",
    "", "12.5% AG & Co.", "snake_case  x\n\ty",
])
def test_clean_text(spark, line):
    assert values(spark, [line], text.clean_text) == [plain_clean(line)]


def test_clean_text_of_nothing(spark):
    assert values(spark, [None], text.clean_text) == [""]


def test_lists(spark):
    assert values(spark, ["a,b", "", None, "a"], text.split_list) == [["a", "b"], [], [], ["a"]]
    assert values(spark, [["a", "b"], [], None], text.join_list, "v array<string>") == ["a,b", None, None]


def test_title_fields(spark):
    rows = [" A \nAG\nLugano\nCHE-1\nRegistered\nextra", "A\nAG", ""]
    found = values(spark, rows, text.title_fields)
    assert tuple(found[0]) == ("A", "AG", "Lugano", "CHE-1", "Registered")
    assert found[1:] == [None, None]


def test_fill_escapes_nothing(spark):
    assert values(spark, ["{name} $1"], lambda c: text.fill("<{name}> {other}", name=c)) == ["<{name} $1> {other}"]
    assert values(spark, [None], lambda c: text.fill("<{name}>", name=c)) == ["<>"]


def test_prompt_places(spark):
    row = spark.createDataFrame([("N", None, "T")], "n string, p string, t string").select(
        prompts.single_prompt("n", "p", F.col("t"))
    ).first()[0]
    assert '"N"' in row and 'Purpose: ""' in row and "\n            T\n" in row


def test_tokens(spark):
    assert values(spark, ["", "abc", "abcd", "ééééé", None], prompts.tokens) == [0, 0, 1, 1, 0]


REPLIES = {
    "Category: A\nSubcategory: a1": ("A", "a1"),
    "Category: A": ("Other", "Other"),
    "Category: A\nSubcategory: a1\nmore": ("A", "a1"),
    "Category: A\n\nSubcategory: a1": ("A", "A"),
    "Category: X\nSubcategory: a1": ("Other", "Other"),
    "Category: A\nSubcategory: x": ("A", "A"),
    "Category: A: b\nSubcategory: a1": ("A", "a1"),
    "category: A\nSubcategory: a1": ("Other", "Other"),
    "Category: a\nSubcategory: a1": ("Other", "Other"),
    "": ("Other", "Other"),
    " \n Category:  A \n  Subcategory:\ta1 ": ("A", "a1"),
}


@pytest.mark.parametrize("reply", REPLIES)
def test_reply(spark, reply):
    labels = F.when(F.col("p.category") == "A", F.array(F.lit("a1"), F.lit("a2")))
    frame = spark.createDataFrame([(reply,)], "v string").select(replies.two_lines("v").alias("p"))
    row = frame.select(replies.checked_pair(F.col("p.category"), F.col("p.subcategory"), labels).alias("o")).first()["o"]
    assert tuple(row) == REPLIES[reply]


@pytest.mark.parametrize("score,sub,expected", [
    (0.5, 0.5, ("A", "a1")), (0.49, 0.9, ("Other", "Other")), (0.9, 0.49, ("A", "A")), (0.9, None, ("A", "A")),
    (None, None, ("Other", "Other")),
])
def test_cascade(spark, score, sub, expected):
    frame = spark.createDataFrame([("A", score, "a1", sub)], "c string, s double, d string, t double")
    assert tuple(frame.select(scores.cascade("c", "s", "d", "t").alias("o")).first()["o"]) == expected


def test_softmax_and_best(spark):
    frame = spark.createDataFrame([(["b", "a", "c"], [1000.0, 1000.0, 0.0]), ([], [])], "l array<string>, s array<double>")
    rows = frame.select(scores.softmax(scores.pair_up("l", "s")).alias("x")).select("x", scores.best("x").alias("b")).collect()
    assert sum(one["score"] for one in rows[0]["x"]) == pytest.approx(1)
    assert rows[0]["b"]["label"] == "a" and rows[0]["b"]["score"] == pytest.approx(0.5)
    assert rows[1]["b"] is None


def test_patterns_hold_in_python_too():
    assert re.fullmatch(V.EMAIL, "a@b.ch") and not re.fullmatch(V.EMAIL, "a@b.c")


def test_long_runs_are_passed_once(spark):
    """A megabyte without a break must not cost its square."""
    blob = "QWxh" * 250_000
    texts = [f"{blob} a@b {blob}@ x.y@c.de end", f"a@b@c.de{blob}", f"x {' ' * 1_000_000} y "]
    assert values(spark, texts[:2], contacts.first_email) == ["x.y@c.de", f"b@c.de{blob}"]
    assert values(spark, texts[2:], text.strip) == [texts[2].strip()]
    assert values(spark, ["\n a \x1c\u00a0\n", " ", ""], text.strip) == ["a", "", ""]


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab1.@-_% é", max_size=25), min_size=1, max_size=40))
def test_first_email_is_the_plain_pattern(spark, rows):
    plain = [re.search(V.EMAIL, row) for row in rows]
    assert values(spark, rows, contacts.first_email) == [found and found.group(0) for found in plain]
