import random
import time
from html import unescape

import pytest
from pyspark.sql import functions as F

from kontor import fixed_values as V
from kontor.operators.filters import drop_failed
from kontor.operators.joins import not_done
from kontor.plans import directory, register
from kontor.sources import markup, pages, tabular
from kontor.sources.markup import elements, table_rows


def page_table(spark, *htmls):
    return spark.createDataFrame([(i, f"u{i}", html) for i, html in enumerate(htmls)], "page_id int, url string, html string")


def records(spark, html):
    found = pages.table_records(page_table(spark, html)).orderBy("position").collect()
    return [row["record"] for row in found]


HEAD = "<table><thead><tr><th> Ditta </th><th>IDI</th><th>Estratto cantonale</th></tr></thead><tbody>"


def test_table_records(spark):
    html = (
        "<script>'<table>'</script>" + HEAD
        + "<tr><td> A &amp; <b> B</b> </td><td>nr CHE-123.456.789 x</td><td><span><a href='/e?1&amp;2'>x</a><a href='/f'>y</a></span></td></tr>"
        + "<tr></tr><tr><td>C<td>none<td>no link<td>beyond</tr></tbody></table>"
        + "<table><thead><tr><th>Z</th></tr></thead><tbody><tr><td>second</td></tr></tbody></table>"
    )
    assert records(spark, html) == [
        {"Ditta": "A &B", "IDI": "CHE-123.456.789", "Estratto cantonale": "/e?1&2"},
        {"Ditta": "C", "IDI": "", "Estratto cantonale": ""},
    ]


def test_markup_is_read_by_many_tasks(spark):
    """Pages in one split, as a small file of many pages has them, and requests small enough to be broadcast."""
    row = "<tr><td>A</td><td>CHE-123.456.789</td><td><a href='/e'>x</a></td></tr>"
    one = page_table(spark, *[HEAD + row + "</tbody></table>"] * 40).coalesce(1)
    read = pages.table_records(one).select("page_id", F.spark_partition_id().alias("task"))
    assert sorted(r["page_id"] for r in read.collect()) == list(range(40))
    assert read.select("task").distinct().count() == 4
    asked = one.select(F.col("url").alias("link")).filter("link <> 'u7'").unionByName(spark.createDataFrame([("gone",)], "link string"))
    linked = pages.with_page(F.broadcast(asked), "link", one, lambda some: some.select("url", F.spark_partition_id().alias("task")))
    found = {r["link"]: r["task"] for r in linked.collect()}
    assert set(found) == {f"u{i}" for i in range(40) if i != 7} | {"gone"} and found.pop("gone") is None
    assert len(set(found.values())) == 4


@pytest.mark.parametrize("html", ["", "<p>no table</p>", HEAD + "</tbody></table>", "<table><tr><td>x</td></tr></table>", None])
def test_pages_without_records(spark, html):
    assert records(spark, html) == []


def test_short_rows_and_equal_headers(spark):
    html = "<table><thead><tr><th>a</th><th>b</th><th>a</th></tr></thead><tbody><tr><td>1<td>2<td>3</tr><tr><td>4<td>5</tr></tbody></table>"
    assert records(spark, html) == [{"a": "3", "b": "2"}, {"a": "4", "b": "5"}]


def section(header, *rows):
    lines = "".join("<tr>" + "".join(f"<td class='{c}'>{t}</td>" for t, c in row) + "</tr>" for row in rows)
    return f"<div id='{V.PANEL_ID}'><table><tr><th>In</th><th>Out</th><th>{header}</th></tr>{lines}</table></div>"


def row(value, cls="", width=3):
    return [("x", "")] * (width - 1) + [(value, cls)]


def extract(spark, html):
    return pages.extract_records(page_table(spark, html)).first()["record"]


def test_extract(spark):
    html = (
        "<div id='Titel'>Firm <b>AG</b><br>AG\n</div>"
        + "<div id='Titel'>later</div>"
        + section("Registered address:", row("old", "a strike b"), row("narrow", width=2), row(" Way 1 <br> 6900  Lugano "), row("next"))
        + section("Purpose", row("first<p>part</p>"), row("second"))
        + section("Other", row("no"))
    )
    found = extract(spark, html)
    assert found["Ditta"] is None
    assert found["Registered_address"] == "Way 1, 6900 Lugano" and found["Purpose"] == "first part"


def test_extract_title_and_last_table(spark):
    html = (
        "<h1 id='Titel'><div>Firm AG</div><div>AG</div><div>Lugano</div>CHE-1<br>Registered on x</h1>"
        + section("Purpose", row("one")) + section("Purpose", row("two")) + section("Purpose", row("gone", "strike"))
    )
    found = extract(spark, html)
    assert (found["Ditta"], found["Sede"], found["Registration_date"]) == ("Firm AG", "Lugano", "Registered on x")
    assert found["Purpose"] == "two" and found["Registered_address"] is None


def test_long_sections_are_searched_once(spark):
    """The work for a page grows with its rows, not with their cube: 500 rows took 78 s before."""
    lines = [row("gone", "strike")] * 100 + [row(f"t{i}") for i in range(400)]
    html = section("Purpose", row("early")) * 20 + section("Purpose", *lines) + section("Purpose", row("struck", "strike"))
    extract(spark, html)
    start = time.perf_counter()
    assert extract(spark, html)["Purpose"] == "t0"
    assert time.perf_counter() - start < 8


def test_unreadable_extracts_are_dropped(spark):
    found = pages.extract_records(page_table(spark, "", None, section("Purpose", row("p"))))
    assert [r["page_id"] for r in drop_failed(found, "record").collect()] == [2]


def test_headers_outside_the_panel_do_not_count(spark):
    table = "<table><tr><th>In</th><th>Out</th><th>Purpose</th></tr><tr><td>1</td><td>2</td><td>advert</td></tr></table>"
    assert extract(spark, table)["Purpose"] is None
    html = table + "<div>" + section("Purpose", row("<div>real</div> text")) + table + "</div>" + table
    assert extract(spark, html)["Purpose"] == "real text"


def test_failures_keep_the_reason(spark):
    requests = spark.createDataFrame([("1", "A", "u0"), ("2", "B", "u1"), ("3", "C", "gone")], "source_idi string, company_name string, url string")
    linked = register.linked_records(requests, page_table(spark, section("Purpose", row("p")), "<p>busy</p>"))
    assert sorted((r["source_idi"], r["error"]) for r in register.failures(linked).collect()) == [("2", "unreadable page"), ("3", "no page")]


def test_lists_from_one_split_are_scanned_by_many_tasks(spark, tmp_path):
    """A CSV file is one task, so the list of results must not lie in as many files as the pages have splits."""
    from kontor.sources.store import data_files

    lines = [HEAD + f"<tr><td>A{i}</td><td>CHE-123.456.{i:03}</td><td><a href='u{i}'>x</a></td></tr></tbody></table>" for i in range(40)]
    listing, output, errors = (str(tmp_path / name) for name in ("listing", "extracts", "errors"))
    found = register.collect_results(spark, page_table(spark, *lines).coalesce(1), listing, "page_id")
    assert len(list(data_files(spark, listing))) == 4 and found.count() == 40
    sheets = page_table(spark, *[section("Purpose", row("p")), "<p>busy</p>"] * 15).coalesce(1)
    assert register.collect_extracts(spark, found, sheets, output, errors).count() == 15
    reasons = tabular.scan_csv(spark, errors).groupBy("error").count().collect()
    assert sorted(tuple(one) for one in reasons) == [("no page", 10), ("unreadable page", 15)]


def test_contact_records(spark):
    html = (
        "<div class='place x'> Way 1 <br><span> 6900 </span><span>Lugano</span></div><div class='place'>second</div>"
        "<p class='contact'>091 <b>123</b> 45 67</p><p class='contact'></p><p class='contact'>www.One.ch</p>"
        "<p class='contact'><a href='https://x'>https://TWO.ch </a></p><p class='contactless'>0911234567</p>"
        "<a>none</a><a href='tel:1'>t</a><a href='mailto:a@b.ch'>m</a><a href='mailto:c@d.ch'>m</a>"
    )
    found = pages.contact_records(page_table(spark, html, "", None), "place", "contact", ["page_id"]).orderBy("page_id").collect()
    assert tuple(found[0])[1:] == ("Way 1 6900 Lugano", ["0911234567"], "a@b.ch", "https://two.ch")
    assert [tuple(one)[1:] for one in found[1:]] == [(None, [], None, None)] * 2


def test_result_links(spark):
    htmls = ["<a class='hit' href='/d/1'>a</a><a class='hit' href='/d/2'>", "<i class='hit'>no link</i><a class='hit' href='/d'>", "<p>", None]
    found = pages.result_links(page_table(spark, *htmls), "https://h.ch", "hit", ["page_id"]).orderBy("page_id")
    assert [one["detail_url"] for one in found.collect()] == ["https://h.ch/d/1", None, None, None]


def test_reader_survives_broken_markup():
    assert [len(one["cells"]) for one in table_rows("<table><tr><td>a<td>b</table></table></td><tr><td>x")] == [2]
    assert table_rows("<table><tr><td>a<table><tr><td>inner</td></tr></table>b</td></tr></table>")[0]["cells"][0]["text"] == "ainnerb"
    assert elements("<div id=a>x<script>y</script><p>z", frozenset(["a"]), frozenset(), False)[0]["spaced"] == "x z"


def test_plain_markup_is_read_without_the_pattern(monkeypatch):
    monkeypatch.setattr(markup, "TOKEN", None)
    html = "<table><TR><td>a &amp; b</td></TR></table>z"
    assert [(kind, name) for kind, name, _ in markup.tokens(html)] == [
        ("open", "table"), ("open", "tr"), ("open", "td"), ("text", "a & b"), ("close", "td"), ("close", "tr"), ("close", "table"),
        ("text", "z"),
    ]


def test_tokens_are_those_of_the_pattern_alone():
    def by_pattern(html):
        for match in markup.TOKEN.finditer(html):
            if match["text"] is not None:
                yield "text", unescape(match["text"]), ""
            elif match["tag"] is not None:
                yield "close" if match["end"] else "open", match["tag"].lower(), match["attrs"]

    parts = ["<", ">", "</", "<td>", "</TD>", "<td", "<a x='b>'>", "<br/>", "<script>", "</script>", "<!--", "-->", "<?", "'", '"', "x y",
             "<1", "<\u017f>", "<\u212a", "\u00e9", "/", "&lt;td>", "=", "\n"]
    deal = random.Random(3)
    for _ in range(5_000):
        html = "".join(deal.choices(parts, k=deal.randint(0, 15)))
        assert list(markup.tokens(html)) == list(by_pattern(html)), html


@pytest.mark.parametrize("junk", ["<", "<b", "<b '", '<a "x <a \'y ', "<!--", "<script>", "</p", "<td>", "<i class=x>", "&amp", "<a href=x>"])
def test_reader_is_linear_on_junk(junk):
    start = time.perf_counter()
    table_rows(junk * 20_000)
    table_rows("<table><tr><td>" + junk * 20_000)
    elements(junk * 20_000, frozenset(["x"]), frozenset(["y"]), True)
    assert time.perf_counter() - start < 5


def test_visible_text(spark):
    htmls = ["a<b>b</b> 1 < 2 <SCRIPT>x</script>c", "a<style>p{}", "a<b title='x", "<!-- n -->", "<" * 200_000 + "<b" * 100_000]
    found = page_table(spark, *htmls).select(pages.visible_text("html").alias("t")).collect()
    assert [one["t"] for one in found[:4]] == ["a b 1 < 2 c", "a", "a", ""] and len(found[4]["t"]) == 200_000


def test_read_pages(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>one\ntwo</p>")
    (tmp_path / "b.html").write_text("<p>b</p>")
    found = pages.read_pages(spark, str(tmp_path)).select("html", pages.visible_text("html").alias("t")).collect()
    assert sorted(one["t"] for one in found) == ["b", "one two"]


SITE = directory.Site("https://h.ch/s/", "?r=1", "https://h.ch", "hit", "place", "contact")


def test_directory_run(spark, tmp_path):
    site_pages = spark.createDataFrame([
        ("https://h.ch/s/A+%26+B?r=1", "<a class='hit' href='/d/1'></a>"),
        ("https://h.ch/d/1", "<p class='contact'>091 123 45 67</p><p class='contact'>091 123 45 68</p>"),
        ("https://h.ch/s/C?r=1", "<p>nothing found</p>"),
    ], "url string, html string")
    companies = spark.createDataFrame(
        [("A & B", "1"), ("A & B", "2"), ("C", "3"), ("D", "4"), ("", "5"), (None, "6")], "Ditta string, IDI string"
    )
    output = str(tmp_path / "listing")
    first = sorted(tuple(one) for one in directory.run(spark, companies, site_pages, output, SITE).select("IDI", "Phone Numbers", "Detail URL").collect())
    assert first == [
        ("1", "0911234567,0911234568", "https://h.ch/d/1"), ("2", "0911234567,0911234568", "https://h.ch/d/1"),
        ("3", None, None), ("4", None, None)]
    again = directory.run(spark, companies, site_pages, output, SITE)
    assert again.count() == 4
    from kontor.sources.tabular import write_csv

    partial = again.filter("`Company Name` = 'C'").withColumn("Address", F.lit("from the interrupted run"))
    write_csv(partial, str(tmp_path / "partial"))
    merged = directory.run(spark, companies, site_pages, output, SITE, str(tmp_path / "partial"))
    assert merged.filter("Address IS NOT NULL").count() == 1
    # namesakes keep a record each
    assert sorted(row["IDI"] for row in merged.select("IDI").collect()) == ["1", "2", "3", "4"]


def test_directory_keeps_namesakes_and_new_ids(spark, tmp_path):
    from kontor.sources.tabular import write_csv

    site_pages = spark.createDataFrame([
        ("https://h.ch/s/Acme?r=1", "<a class='hit' href='/d/1'></a>"), ("https://h.ch/d/1", "<p class='contact'>091 123 45 67</p>"),
    ], "url string, html string")
    output, temporary = str(tmp_path / "listing"), str(tmp_path / "temporary")
    first = spark.createDataFrame([("Acme", "CHE-1"), ("Acme", "CHE-2"), ("Zed", "CHE-3")], "Ditta string, IDI string")
    directory.run(spark, first, site_pages, output, SITE)
    partial = directory.listing(spark, output).drop("ordinal").filter("IDI = 'CHE-3'").withColumn("Address", F.lit("late"))
    write_csv(partial, temporary)
    more = first.unionByName(spark.createDataFrame([("Acme", "CHE-9"), ("Acme", None)], "Ditta string, IDI string"))
    found = directory.run(spark, more, site_pages.limit(0), output, SITE, temporary)
    assert sorted(((row["IDI"], row["Phone Numbers"], row["Address"]) for row in found.collect()), key=repr) == sorted([
        ("CHE-1", "0911234567", None), ("CHE-2", "0911234567", None), ("CHE-3", None, "late"), ("CHE-9", "0911234567", None),
        (None, "0911234567", None)], key=repr)
    assert directory.run(spark, more, site_pages, output, SITE).count() == 5


def test_directory_goes_on_after_a_break(spark, tmp_path):
    companies = spark.createDataFrame([(f"N{i}", str(i)) for i in range(7)], "Ditta string, IDI string")
    none = spark.createDataFrame([], "url string, html string")
    output = str(tmp_path / "listing")
    assert directory.run(spark, companies, none, output, SITE, chunk=3, chunks=1).count() == 3
    assert directory.run(spark, companies, none, output, SITE, chunk=3).count() == 7


def test_register_skips_what_is_done(spark):
    rows = spark.createDataFrame(
        [("A", "1", "u0"), ("B", "2", ""), ("C", None, "u2"), ("D", "4", "u9"), ("E", "5", "u0")], "Ditta string, IDI string, `Estratto cantonale` string"
    )
    requests = register.extract_requests(rows)
    assert sorted(one["source_idi"] for one in requests.collect()) == ["1", "4", "5"]
    done = spark.createDataFrame([("5",)], "source_idi string")
    found = register.extracts(not_done(requests, done, "source_idi"), page_table(spark, section("Purpose", row("p"))))
    assert [(one["source_idi"], one["Purpose"]) for one in found.collect()] == [("1", "p")]
