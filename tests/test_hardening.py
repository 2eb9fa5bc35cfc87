"""Long inputs, values at the edges and names that clash."""

import time

import pytest
from pyspark.sql import functions as F

from pagequarry.functions.text import SPACES, strip_space
from pagequarry.operators.extract import extract_fields
from pagequarry.operators.index import build_index
from pagequarry.operators.search import Searcher
from pagequarry.sources.index_store import load_index, save_index
from pagequarry.sources.pages import append_log, read_log
from pagequarry.sources.records import read_records, write_records


def test_space_is_what_python_calls_space():
    assert set(SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_a_megabyte_of_spaces_inside_a_text_is_no_trouble(spark):
    df = spark.createDataFrame([(1_000_000,)], "n int").select(F.concat(F.lit("a"), F.repeat(F.lit(" "), F.col("n")), F.lit("b")).alias("t"))
    start = time.time()
    assert df.select(F.length(strip_space("t"))).first()[0] == 1_000_002
    assert time.time() - start < 5


def test_a_hundred_thousand_countries_are_no_trouble(spark):
    anchors = "\n".join(f' <a href="/{i}">C{i}</a>' for i in range(100_000))
    page = f'<dt class="t">Countries</dt>\n<dd class="d">\n{anchors}\n</dd>'
    got = extract_fields(spark.createDataFrame([("u", page)], "url string, html string")).first()
    assert got["contry"] == "C99999"


def test_records_keep_edges_and_are_read_by_name(spark, tmp_path):
    rows = [("u", " hello ", "\tq\t", " , ")]
    write_records(spark.createDataFrame(rows, "url string, a string, b string, c string"), str(tmp_path / "r"))
    assert read_records(spark, str(tmp_path / "r"), ["c", "url", "a"]).collect() == [(" , ", "u", " hello ")]
    log = spark.createDataFrame([("u", "t", 1, " x ")], "url string, downloaded_at string, filesize_bytes bigint, filepath_saved string")
    append_log(log, str(tmp_path / "l"))
    assert read_log(spark, str(tmp_path / "l")).first()["filepath_saved"] == " x "


def test_metadata_may_be_called_anything(spark, tmp_path):
    docs = spark.createDataFrame([(1, "red fox", "B", "R", "S")], "doc_id long, name string, bucket string, rank string, score string")
    stored = save_index(build_index(docs, fields=["name"]), str(tmp_path / "i"), 2)
    for index in (stored, load_index(spark, str(tmp_path / "i"))):
        searcher = Searcher(index)
        row = searcher.with_metadata(searcher.search("fox")).first()
        assert (row["bucket"], row["doc_rank"], row["doc_score"], row["rank"]) == ("B", "R", "S", 1)
        assert searcher.display(searcher.search("fox")).first()["rank"] == 1


def test_only_a_missing_path_means_no_index(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_index(spark, str(tmp_path / "none"))
