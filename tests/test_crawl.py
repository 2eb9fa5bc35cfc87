import random
from collections import deque
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from pagequarry.operators import frontier as frontier_module
from pagequarry.operators.frontier import crawl, crawl_depth, crawl_summary, next_frontier, queue_of
from pagequarry.operators.links import extract_links, resolve_links, same_site
from pagequarry.operators.robots import crawl_delays, drop_disallowed, parse_robots
from pagequarry.plans import joins, ordering

RULES_SCHEMA = "host string, pos int, kind string, value string"
NO_VISITS = "url string, seq bigint, status string"


def test_link_extraction(spark, rows):
    html = (
        """<A HREF='/one'>1</a><a class="x" href="two?p=1#f">2</a><a href="#top">no</a><a href="">no</a>"""
        """<a\nhref="/three">3</a><a href=/bare>no</a><link href="/no"><a data-href="/x" href="mailto:a@b">4</a>"""
    )
    pages = spark.createDataFrame([(7, "http://h/a/b", html), (8, "http://h/", "none")], "page_id int, url string, html string")
    links = resolve_links(extract_links(pages))
    assert rows(links.select("page_id", "pos", "abs_url")) == [
        (7, 0, "http://h/one"),
        (7, 1, "http://h/a/two?p=1"),
        (7, 2, "http://h/three"),
        (7, 3, "mailto:a@b"),
    ]
    assert same_site(links).count() == 3
    assert same_site(links, "H").count() == 0


ROBOTS = [
    ("swallow", "User-agent: *\nDisallow:\nDisallow: /x/\nAllow: /x/y\nCrawl-delay: 10\nUser-agent: bad\nDisallow: /"),
    ("end", "User-agent: *\nDisallow: /x\n"),
    ("comment", "User-agent: *\n# c\nDisallow: /x"),
    ("crlf", "User-agent: *\r\nDisallow: /a\r\nCrawl-delay: 2.9\r\nCrawl-delay: soon\r\nDisallow: /b c \r\n# end"),
    ("case", "User-agent: *\ndisallow: /x\nDisallow: /y\nUser-agent: z"),
    ("other", "User-agent: z\nDisallow: /\n"),
    ("last", "User-agent: *\nCrawl-delay: 3\nCrawl-delay: 7\n#"),
]


@pytest.mark.parametrize(
    "mode,expected,delays",
    [
        (
            "reference",
            {("swallow", "Disallow: /x/"), ("crlf", "/a"), ("crlf", "/b c"), ("case", "/y")},
            {"swallow": 10, "end": 15, "comment": 15, "crlf": 2, "case": 15, "other": 15, "last": 7},
        ),
        (
            "strict",
            {("swallow", "/x/"), ("end", "/x"), ("comment", "/x"), ("crlf", "/a"), ("crlf", "/b c"), ("case", "/y")},
            {"swallow": 10, "end": 15, "comment": 15, "crlf": 2, "case": 15, "other": 15, "last": 7},
        ),
    ],
)
def test_robots(spark, mode, expected, delays):
    robots = spark.createDataFrame(ROBOTS, "host string, text string")
    rules = parse_robots(robots, mode)
    assert {(r.host, r.value) for r in rules.where("kind = 'disallow'").collect()} == expected
    assert {r.host: r.delay for r in crawl_delays(robots, rules).collect()} == delays


def test_delay_values_follow_python(spark):
    values = ["1e1", "10d", "nan", "-3.7", " 4 ", ".5", "1_0", "abc", "99999999999"]
    robots = spark.createDataFrame([(v, f"User-agent: *\nCrawl-delay: {v}\n#") for v in values], "host string, text string")
    got = {r.host: r.delay for r in crawl_delays(robots, parse_robots(robots)).collect()}
    # "1_0" is a number in Python only
    assert got == {
        "1e1": 10, "10d": 15, "nan": 15, "-3.7": -3, " 4 ": 4, ".5": 0, "1_0": 15, "abc": 15, "99999999999": 99999999999,
    }


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, -1])
def test_prefix_rules(spark, rows, monkeypatch, limit):
    monkeypatch.setattr(joins.lookup_join, "__defaults__", ("inner", "", limit))
    monkeypatch.setattr(joins, "PART_ROWS", 2)
    rules = spark.createDataFrame(
        [("h", 0, "disallow", "/x"), ("g", 0, "disallow", "/a/"), (None, 0, "disallow", "/never"), ("h", 1, "delay", "/ok")],
        RULES_SCHEMA,
    )
    urls = ["http://h/x1", "http://h/ok", "http://h/a/b", "http://g/a/b", "http://g/a", "http://q/never", "http://q/x", "mailto:x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = drop_disallowed(df, rules, "url")
    assert {r.url for r in kept.collect()} == {"http://h/ok", "http://h/a/b", "http://g/a", "http://q/x", "mailto:x"}


def simulated(pages, seeds, prefixes, site, budget, visited=()):
    """The queue loop in plain Python: (visited order with status, remaining queue)."""
    queue, seen, order, fetched = deque(seeds), set(visited), [], 0
    while queue and fetched < budget:
        url = queue.popleft()
        if url in seen:
            continue
        seen.add(url)
        if any(urlparse(url).path.startswith(p) for p in prefixes):
            order.append((url, "disallowed"))
        elif url not in pages:
            order.append((url, "failed"))
        else:
            order.append((url, "fetched"))
            fetched += 1
            for href in pages[url]:
                link = urljoin(url, href).split("#")[0]
                if urlparse(link).netloc != site or any(urlparse(link).path.startswith(p) for p in prefixes):
                    continue
                if link not in seen and link not in queue:
                    queue.append(link)
    return order, list(queue)


def site_of(seed, n=40):
    rng = random.Random(seed)
    names = [f"/{'x' if i % 9 == 0 else 'p'}{i}" for i in range(n + 6)]
    links = names + ["p3", "./p4", "http://other/p5", "#top", "/p7#a", "mailto:a@b"]
    return {f"http://h{p}": [x for x in rng.choices(links, k=rng.randrange(6)) if x[0] != "#"] for p in names[:n]}


def tables(spark, site, seeds):
    html = {u: "".join(f'<a href="{x}">x</a>' for x in links) for u, links in site.items()}
    pages = spark.createDataFrame(list(html.items()), "url string, html string")
    frontier = spark.createDataFrame([(u, i) for i, u in enumerate(seeds)], "url string, seq bigint")
    rules = spark.createDataFrame([(None, 0, "disallow", "/x")], RULES_SCHEMA)
    return pages, frontier, rules


SEEDS = ["http://h/p1", "http://h/x0", "http://h/nosuch", "http://h/p2", "http://h/p3", "http://other/z"]


@pytest.mark.parametrize("budget", [0, 1, 2, 3, 50])
def test_one_step_equals_the_queue_loop(spark, budget):
    site = site_of(1)
    pages, frontier, rules = tables(spark, site, SEEDS)
    visited = spark.createDataFrame([("http://h/p2", 0, "fetched")], NO_VISITS)
    step = next_frontier(pages, frontier, visited, rules, budget, "h")
    # the loop, stopped once the given queue is used up
    reachable = {u: site.get(u) for u in SEEDS if u in site}
    order, queue = simulated(reachable, SEEDS, ["/x"], "h", min(budget, 2), {"http://h/p2"})
    if budget > 2:
        order, queue = simulated(reachable, SEEDS, ["/x"], "h", 3, {"http://h/p2"})
        order = [(u, s) for u, s in order if u in SEEDS]
        _, queue = simulated({**reachable}, SEEDS, ["/x"], "h", 2, {"http://h/p2"})
        queue = [u for u in queue if u not in SEEDS]
    assert [(r.url, r.status) for r in step.visited.orderBy("seq").collect()] == order
    assert [r.url for r in step.frontier.orderBy("seq").collect()] == queue
    assert [r.seq for r in step.frontier.orderBy("seq").collect()] == list(range(len(queue)))


@pytest.mark.parametrize("seed,budget", [(1, 5), (2, 12), (3, 1000)])
def test_whole_crawl_equals_the_queue_loop(spark, seed, budget):
    site = site_of(seed)
    pages, frontier, rules = tables(spark, site, SEEDS)
    result = crawl(pages, frontier, rules, budget, "h")
    order, queue = simulated(site, SEEDS, ["/x"], "h", budget)
    assert [(r.url, r.status) for r in result.visited.orderBy("seq").collect()] == order
    assert [r.url for r in result.frontier.orderBy("seq").collect()] == queue
    summary = crawl_summary(result.visited, result.frontier).first()
    assert tuple(summary) == (sum(s == "fetched" for _, s in order), len(order), len(queue))
    assert result.fetched == summary.pages_fetched


def test_a_budget_is_cut_by_counting_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(frontier_module, "fits_broadcast", lambda df, limit=0: False)
    monkeypatch.setattr(frontier_module, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(ordering, "RANGES", 2)
    site = site_of(4)
    pages, frontier, rules = tables(spark, site, SEEDS)
    result = crawl(pages, frontier, rules, 9, "h")
    order, queue = simulated(site, SEEDS, ["/x"], "h", 9)
    assert [(r.url, r.status) for r in result.visited.orderBy("seq").collect()] == order
    assert [r.url for r in result.frontier.orderBy("seq").collect()] == queue


def test_queue_keeps_the_first_of_repeats(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 0), ("c", 9), ("a", 7)], "url string, at int")
    assert [r.url for r in queue_of(df, ["at"]).orderBy("seq").collect()] == ["b", "a", "c"]


def test_depths(spark, rows):
    edges = [("a", "b"), ("a", "c#x"), ("b", "d"), ("c", "d"), ("d", "a"), ("d", "e"), ("z", "q")]
    links = spark.createDataFrame(edges, "url string, abs_url string")
    seeds = spark.createDataFrame([("a",), ("a",)], "url string")
    assert rows(crawl_depth(links, seeds, 9)) == [("a", 0), ("b", 1), ("c", 1), ("d", 2), ("e", 3)]
    assert rows(crawl_depth(links, seeds, 1)) == [("a", 0), ("b", 1), ("c", 1)]


def test_no_step_returns_a_visited_url(spark):
    site = site_of(6)
    pages, frontier, rules = tables(spark, site, SEEDS)
    first = next_frontier(pages, frontier, spark.createDataFrame([], NO_VISITS), rules, 10, "h")
    second = next_frontier(pages, first.frontier, first.visited, rules, 100, "h")
    seen = first.visited.unionByName(second.visited)
    assert second.frontier.join(seen, "url").count() == 0
    assert seen.count() == seen.select("url").distinct().count()
    assert seen.where(F.col("status") == "failed").count() > 0
