import itertools
from urllib.parse import urljoin, urlparse

from pagequarry.functions.url import netloc, page_rel_path, url_path, with_absolute_url

KNOWN = [
    ("http://h.com/a/b?x=1#t", "/c/d", "http://h.com/c/d"),
    ("http://h.com/a/b", "c", "http://h.com/a/c"),
    ("http://h.com/a/b/", "../c/", "http://h.com/a/c/"),
    ("http://h.com", "c", "http://h.com/c"),
    ("https://h.com/a", "//o.org/z", "https://o.org/z"),
    ("http://h.com/a", "https://q.net/x", "https://q.net/x"),
    ("http://h.com/a?y", "?p=2", "http://h.com/a?p=2"),
    ("http://h.com/a", "mailto:x@y", "mailto:x@y"),
    ("http://h.com/a/b/c", "./d/../e", "http://h.com/a/b/e"),
    ("http://h.com/", "../../up", "http://h.com/up"),
    ("http://h.com/a/b/c", "..", "http://h.com/a/"),
    ("http://h.com/a", "HTTP://H.com/X", "http://H.com/X"),
    ("http://h.com/a", "x?", "http://h.com/x"),
    ("http://h.com/a", "/p;v=1?q", "http://h.com/p;v=1?q"),
    ("http://h.com/a", "a//b", "http://h.com/a/b"),
    ("http://h.com/a", "/a//b", "http://h.com/a//b"),
    ("https://h.com/a", "HTTP://H.com/X", "HTTP://H.com/X"),
]
BASES = [
    "http://h.com", "http://h.com/", "http://h.com/a", "http://h.com/a/", "https://h.com/a/b/c?q=1#f",
    "http://u@H.com:80/x;p=1/y;q=2?z", "http://h.com/a/./b/../c/", "http://h.com//d//e", "HTTP://h.com/a;p",
    "http://h.com/..", "http://h.com/a/b/..",
]
LINKS = [
    "c", "/c", "../c", "../../c", "../../../../c", "./c", ".", "..", "../", "./", "c/", "c/..", "c/.", "/..", "/../c",
    "/a/./b/../c", "//o.org", "//o.org/p?q#f", "///x", "?p", "?p=1#f", "?", ";v", ";v=1?q", "c;v=1", "c;v/d", "/c;v",
    "c#f", "https://q.net", "http://q.net/a/../b", "http:c", "http:/c", "https:c", "HTTP://Q.net/X", "mailto:a@b#c",
    "javascript:void(0)", "tel:+1", "a//b", "/a//b", "a/b//", "..//c", "c?x=/../y", "1a:b", "a\tb", "\n/c", "/%20/é", "c;",
]


def resolved(spark, pairs):
    df = spark.createDataFrame(pairs, "base string, link string")
    return {(r.base, r.link): r.abs_url for r in with_absolute_url(df, "base", "link").collect()}


def test_known_links(spark):
    got = resolved(spark, [(b, r) for b, r, _ in KNOWN])
    assert got == {(b, r): e for b, r, e in KNOWN}


def test_all_bases_with_all_links_follow_the_standard_library(spark):
    pairs = list(itertools.product(BASES, LINKS))
    got = resolved(spark, pairs)
    wrong = {p: (got[p], urljoin(*p).split("#")[0]) for p in pairs if got[p] != urljoin(*p).split("#")[0]}
    assert wrong == {}


def test_parts_follow_the_standard_library(spark):
    urls = BASES + ["http://h/a/b;p=1?q", "http://h/a b|c?d", "/only/path;x", "http://h?q", "http://h#f", "//h/p"]
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", netloc("u").alias("n"), url_path("u").alias("p"))
    for r in df.collect():
        assert (r.n, r.p) == (urlparse(r.u).netloc, urlparse(r.u).path)


def test_file_paths(spark):
    expected = {
        "http://h": "index.html", "http://h/": "index.html", "http://h/a/": "a/index.html", "http://h/a?p=1": "a",
        "http://h/a?p=2": "a", "http://h//a/b.html": "a/b.html",
    }
    df = spark.createDataFrame([(u,) for u in expected], "u string").select("u", page_rel_path("u").alias("p"))
    assert {r.u: r.p for r in df.collect()} == expected


def test_resolution_keeps_the_parts_in_one_projection(spark):
    df = with_absolute_url(spark.createDataFrame([("a", "b")], "base string, link string").repartition(1), "base", "link")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") <= 12
    assert "Python" not in plan
