import random
import re

import pytest
from pyspark.sql import functions as F

from pagequarry.operators.extract import FIELD_RULES, extract_fields, extract_records, select_pages
from pagequarry.plans import joins

PAGE = """<html><body><h1 class="primary_title">Old Harbour</h1>
<div class="site-rating" data-votes="12" data-rating="3.5" data-average="3.42"></div>
<div class="intro-text text-lead">
  <p>The <b>Old Harbour</b> is a port &amp; temple.</p>
  Second line.
</div>
<dl>
<dt class="t">Full Name</dt>
<dd class="d">
  Old Harbour of Testland <small>(id 1)</small></dd>
<dt class="t">Country</dt>
<dd class="d">
  <a href="/testland">Testland</a>
</dd>
<dt class="t">Status</dt>
<dd class="d">
  Inscribed 1999 <span>x</span></dd>
<dt class="t">Type</dt>
<dd class="d">
  Cultural <i class="c"></i></dd>
</dl></body></html>"""
TWO = PAGE.replace(
    '<a href="/testland">Testland</a>', '<a href="/aland">Aland</a>\n  <a href="/bland">Bland</a>'
)
FIELDS = {
    "name": "Old Harbour",
    "full_name": "Old Harbour of Testland",
    "votes": "12",
    "whs_rating": "3.5",
    "average_rating": "3.42",
    "description": "The Old Harbour is a port &amp; temple.\n  Second line.",
    "contry": "Testland",
    "status": "Inscribed 1999",
    "type": "Cultural",
}


def extracted(spark, *htmls):
    df = spark.createDataFrame(list(enumerate(htmls)), "id int, html string").repartition(1)
    return [{k: r[k] for k in FIELD_RULES} for r in extract_fields(df).orderBy("id").collect()]


def test_all_fields(spark):
    empty = dict.fromkeys(FIELDS, "")
    got = extracted(spark, PAGE, "<html><h1>No title class</h1></html>", TWO, PAGE.replace("\n", "\r\n"))
    assert got == [FIELDS, empty, {**FIELDS, "contry": "Bland"}, FIELDS]


BLOCK = '<dt>Country</dt>\n<dd class="c">\n{}\n</dd>\n'


@pytest.mark.parametrize(
    "html,country",
    [
        ('<dt>Country</dt>\n<dd class="c"><a href="/fr">France</a></dd>', ""),
        ('<dt>Country</dt><dd class="c"></dd>', ""),
        (
            '<dt>Countries</dt><dd class="c">\n <a href="/fr">France</a> <a href="/de">Germany</a>\n</dd>',
            'France</a> <a href="/de">Germany',
        ),
        # the first block that fits counts, whatever lies before it
        (BLOCK.format("plain") + BLOCK.format('<a href="/x">Xland</a>'), "Xland"),
        (BLOCK.format("a\nb") + "<p>x</p></dd>" + BLOCK.format('<a href="/x">Xland</a>\n<a href="/y">Y</a>'), "Y"),
        (BLOCK.format('<a href="/x">Xland</a>') + BLOCK.format('<a href="/y">Y</a>'), "Xland"),
        (BLOCK.format("") + BLOCK.format('<a href="/y">Y</a>'), ""),
        ('<dt>Country</dt>\n<dd class="c">\n text' + BLOCK.format('<a href="/x">Xland</a>'), "Xland"),
        (BLOCK.format("plain"), ""),
        ('<dt>Country</dt>\n<dd class="c">\n<a href="/x">Xland</a>\n', ""),
        ("<dd x></dd>" * 3 + '<dt class="t">\n Countries\n</dt>\n\n<dd id="1" class="c">\n<a>A</a></dd>', "A"),
    ],
)
def test_country_variants(spark, html, country):
    assert extracted(spark, html)[0]["contry"] == country


def test_countries_of_a_long_list_and_of_many_blocks(spark):
    long = "\n".join(f'<a href="/{i}">C{i}</a>' for i in range(20_000))
    assert extracted(spark, BLOCK.format(long))[0]["contry"] == "C19999"
    assert extracted(spark, BLOCK.format("plain") * 3_000 + BLOCK.format("<a>Z</a>"))[0]["contry"] == "Z"


def test_blocks_are_found_as_by_the_pattern_itself(spark):
    pattern = re.compile(FIELD_RULES["contry"])
    rng = random.Random(4)
    bits = ["<dt>Country</dt>", "<dt c>\nCountries </dt>", "\n", '<dd class="c">', "</dd>", "<a>A</a>", '<a href="/b">B</a>', " ", "text", "<p>"]
    htmls = ["".join(rng.choices(bits, k=rng.randint(3, 14))) for _ in range(600)]
    for html, got in zip(htmls, extracted(spark, *htmls), strict=True):
        found = pattern.search(html)
        assert got["contry"] == ((found and found[1]) or "").strip(), html


def test_long_description(spark):
    text = "word <b>x</b>\n" * 10_000
    got = extracted(spark, f'<div class="intro-text text-lead">{text}</div>')[0]["description"]
    assert got == text.strip().replace("<b>", "").replace("</b>", "")


def test_dot_stops_at_line_feed_only(spark):
    assert extracted(spark, '<h1 class="primary_title">a b\x85c</h1>')[0]["name"] == "a b\x85c"
    assert extracted(spark, '<h1 class="primary_title">a\nb</h1>')[0]["name"] == ""


def test_page_class(spark):
    paths = ["list/a/index.html", "tentative/index.html", "listing/x/index.html", "old/list/a/index.html", "list/a.html",
             "in-danger/a/index.htmlx", "former-tentative/a\n/index.html"]
    df = spark.createDataFrame([(p,) for p in paths], "filepath_saved string")
    assert {r[0] for r in select_pages(df).collect()} == {
        "list/a/index.html", "listing/x/index.html", "in-danger/a/index.htmlx",
    }


@pytest.mark.parametrize("hot_rows", [1, 100_000])
def test_log_rows_become_records(spark, rows, monkeypatch, hot_rows):
    monkeypatch.setattr(joins, "PART_ROWS", hot_rows)
    log = spark.createDataFrame(
        [("u1", "t", 1, "list/a/index.html")] * 3 + [("u2", "t", 1, "list/gone/index.html"), ("u3", "t", 1, "about.html")],
        "url string, downloaded_at string, filesize_bytes bigint, filepath_saved string",
    )
    pages = spark.createDataFrame([("list/a/index.html", PAGE), ("about.html", PAGE)], "filepath_saved string, html string")
    records = extract_records(log, pages)
    assert records.columns == ["url", *FIELD_RULES]
    assert rows(records) == [("u1", *FIELDS.values())] * 3
    assert extract_records(log, pages, dedupe=True).count() == 1


def test_pages_are_not_shuffled_for_extraction(spark):
    log = spark.createDataFrame([("u", "list/a/index.html")], "url string, filepath_saved string")
    pages = spark.createDataFrame([("list/a/index.html", PAGE)], "filepath_saved string, html string").where(F.col("html") != "")
    plan = extract_records(log, pages)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
