import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagequarry.functions.text import strip_markup, strip_space, tokens, unix_newlines

CASES = {
    "Chichén Itzá's x² ½ test_a": ["chichén", "itzá", "test_a"],
    "naïve Straße 北京市 город-герой": ["naïve", "straße", "北京市", "город", "герой"],
    "ábc": ["ábc"],
    "ábc": [],
    "AB abc 12 123 _ab": ["abc", "123", "_ab"],
    "İstanbul": ["stanbul"],
    "ΣΑΣ": ["σας"],
    "": [],
}


def test_tokens_of_known_texts(spark):
    df = spark.createDataFrame([(t,) for t in CASES], "t string").select("t", tokens(F.col("t")).alias("w"))
    assert {r.t: r.w for r in df.collect()} == CASES


def test_null_text_has_no_tokens(spark):
    assert spark.sql("select cast(null as string) t").select(tokens(F.col("t")).alias("w")).first().w == []


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="İΣ")), min_size=40, max_size=40))
def test_tokens_match_python_word_rule(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", tokens(F.col("t")).alias("w"))
    # code points assigned after either side's Unicode version would differ; none are assigned here
    expected = {i: [w for w in re.findall(r"\w+", t.lower()) if len(w) > 2] for i, t in enumerate(texts)}
    known = {i for i, t in enumerate(texts) if all(ord(c) < 0x3000 for c in t)}
    assert {r.i: r.w for r in df.collect() if r.i in known} == {i: expected[i] for i in known}


def test_strip_and_newlines_follow_python(spark):
    texts = ["  a b \n", "\x1c\x1fa\x85", "a\r\nb\rc\n\rd", "   ", "", "x "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", strip_space(F.col("t")).alias("s"), unix_newlines(F.col("t")).alias("n")).collect()
    for r in got:
        assert r.s == r.t.strip()
        assert r.n == r.t.replace("\r\n", "\n").replace("\r", "\n")


def test_markup_is_removed_and_entities_stay(spark):
    df = spark.createDataFrame([("<p>a &amp; <b>b</b> 1 < 2 <</p>",)], "t string")
    text = "<p>a &amp; <b>b</b> 1 < 2 <</p>"
    assert df.select(strip_markup("t")).first()[0] == re.sub("<[^<]+?>", "", text)
