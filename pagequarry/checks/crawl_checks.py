"""Links, robots rules, frontier and depth."""

from pyspark.sql import functions as F

from ..functions.url import netloc, url_path
from ..operators.frontier import crawl, crawl_depth, crawl_summary, next_frontier
from ..operators.links import extract_links, resolve_links, same_site, site_links
from ..operators.robots import crawl_delays, drop_disallowed, parse_robots
from ..plans.ordering import number_rows
from ..plans.storage import fresh_path, written
from ..sources.pages import read_queue, read_robots, write_queue
from .inputs import page_links_in_forms, page_tree, page_web, robots_texts, table

BUDGET = 100
FRONTIER_SCHEMA = "url string, seq bigint, status string"


def links_raw(spark, sf_dir):
    return extract_links(table(spark, sf_dir, "pages")).select("page_id", "pos", "href")


def links_resolved(spark, sf_dir):
    """All links in eight forms, resolved."""
    return resolve_links(page_links_in_forms(spark, sf_dir)).select("page_id", "pos", "form", "abs_url")


def links_same_site(spark, sf_dir):
    links = resolve_links(page_links_in_forms(spark, sf_dir))
    return same_site(links).select("page_id", "pos", "form", "abs_url")


def links_seed_site(spark, sf_dir):
    """Links that lie on the site of the page with the most bytes."""
    pages = table(spark, sf_dir, "pages")
    seed = pages.agg(F.max_by(netloc("url"), F.struct(F.octet_length("html"), "page_id")).alias("site")).scalar()
    links = resolve_links(page_links_in_forms(spark, sf_dir))
    return same_site(links, seed).select("page_id", "pos", "form", "abs_url")


def rules(spark, sf_dir):
    return parse_robots(robots_texts(spark, sf_dir))


def links_allowed(spark, sf_dir):
    links = resolve_links(page_links_in_forms(spark, sf_dir))
    kept = drop_disallowed(links, rules(spark, sf_dir), "abs_url")
    return kept.select("page_id", "pos", "form", "abs_url")


def links_looked_up(spark, sf_dir):
    """Links none of whose beginnings is a path of the site's pages, by lookup: each page forbids its own path."""
    links = resolve_links(page_links_in_forms(spark, sf_dir))
    pages = table(spark, sf_dir, "pages")
    paths = pages.select(netloc("url").alias("host"), F.lit("disallow").alias("kind"), F.regexp_replace(url_path("url"), "[^/]*$", "").alias("value"))
    everywhere = pages.select(F.lit(None).cast("string").alias("host"), F.lit("disallow").alias("kind"), F.left(url_path("url"), F.lit(4)).alias("value"))
    forbidden = paths.unionByName(everywhere.where(F.col("value").endswith("/") & (F.length("value") > 3)))
    kept = drop_disallowed(links, forbidden.where(F.length("value") > 1), "abs_url", listed=0)
    return kept.select("page_id", "pos", "form", "abs_url")


def robots_rules(spark, sf_dir):
    """Rules of each host's robots text, in both modes."""
    robots = robots_texts(spark, sf_dir)
    modes = [parse_robots(robots, m).withColumn("mode", F.lit(m)) for m in ("reference", "strict")]
    return modes[0].unionByName(modes[1])


def robots_files(spark, sf_dir):
    """Rules of robots texts stored as one file per host, in both modes."""
    path = fresh_path(spark, "robots")
    robots_texts(spark, sf_dir).write.partitionBy("host").text(path)
    robots = read_robots(spark, path, F.col("host"))
    modes = [parse_robots(robots, m).withColumn("mode", F.lit(m)) for m in ("reference", "strict")]
    return modes[0].unionByName(modes[1])


def robots_delays(spark, sf_dir):
    return crawl_delays(robots_texts(spark, sf_dir), rules(spark, sf_dir))


def start(spark, sf_dir):
    """The page table, a queue of all page URLs with a dead one after each, and the plain-http ones as visited."""
    pages = table(spark, sf_dir, "pages")
    urls = F.array(F.col("url"), F.concat(F.regexp_replace("url", "[?#].*", ""), F.lit("/gone")))
    queue = pages.select("page_id", F.posexplode(urls).alias("dead", "url")).select(
        "url", (F.col("page_id") * 2 + F.col("dead")).alias("seq")
    )
    visited = pages.where(F.col("url").startswith("http:")).select("url", F.lit(0).alias("seq"), F.lit("fetched").alias("status"))
    return pages, queue, visited


def frontier_next(spark, sf_dir):
    """The queue after one step: what is left of it, then the new links."""
    pages, queue, visited = start(spark, sf_dir)
    return next_frontier(pages, queue, visited, rules(spark, sf_dir), BUDGET).frontier


def frontier_visits(spark, sf_dir):
    """The URLs one step takes from the queue, with their fate."""
    pages, queue, visited = start(spark, sf_dir)
    return next_frontier(pages, queue, visited, rules(spark, sf_dir), BUDGET).visited


def crawl_counters(spark, sf_dir):
    pages, queue, visited = start(spark, sf_dir)
    step = next_frontier(pages, queue, visited, rules(spark, sf_dir), BUDGET)
    return crawl_summary(step.visited, step.frontier)


def crawl_order(spark, sf_dir):
    """A whole crawl of the page tree from its root: visiting order of every page."""
    tree = page_tree(spark, sf_dir)
    seeds = tree.where(F.col("node") == 0).select("url", F.lit(0).cast("bigint").alias("seq"))
    no_rules = spark.createDataFrame([], "host string, pos int, kind string, value string")
    return crawl(tree, seeds, no_rules, 1 << 40, netloc("abs_url")).visited


def web_crawl(spark, sf_dir, budgets):
    """Crawl the web of all pages from the first eight, under their sites' rules; one call for each budget, all on one log.
    Visited URLs with their fate, then the queue that is left."""
    web = written(page_web(spark, sf_dir), "web")
    seeds = web.where(F.col("node") < 8).select("url", F.col("node").alias("seq"))
    path = fresh_path(spark, "crawl")
    for budget in budgets:
        done = crawl(web, seeds, rules(spark, sf_dir), budget, netloc("abs_url"), path)
    return done.visited.unionByName(done.frontier.withColumn("status", F.lit("queued")))


def crawl_web(spark, sf_dir):
    """Half of the pages fetched, with rules, dead links and links of the given HTML."""
    return web_crawl(spark, sf_dir, [table(spark, sf_dir, "pages").count() // 2])


def crawl_resumed(spark, sf_dir):
    """The same crawl, broken off after ten pages and after a sixth of them, and taken up again."""
    n = table(spark, sf_dir, "pages").count()
    return web_crawl(spark, sf_dir, [min(10, n // 2), n // 6, n // 2])


def depths(spark, sf_dir):
    """Hops of every page of the page tree from its root."""
    tree = page_tree(spark, sf_dir)
    links = written(site_links(tree, netloc("abs_url")).select("url", "abs_url"), "tree-links")
    return crawl_depth(links, tree.where(F.col("node") == 0).select("url"))


def queue_roundtrip(spark, sf_dir):
    """The home pages of all sites in the order of their first page, written as a queue file and read back."""
    pages = table(spark, sf_dir, "pages")
    home = F.concat(F.regexp_extract("url", "^[a-z]+://[^/?#]*", 0), F.lit("/"))
    numbered = number_rows(pages.select("page_id", home.alias("url")), ["page_id"], "seq")
    path = fresh_path(spark, "queue")
    write_queue(numbered, path)
    return read_queue(spark, path)


QUERIES = {
    "links_raw": links_raw,
    "links_resolved": links_resolved,
    "links_same_site": links_same_site,
    "links_seed_site": links_seed_site,
    "links_allowed": links_allowed,
    "links_looked_up": links_looked_up,
    "robots_rules": robots_rules,
    "robots_files": robots_files,
    "robots_delays": robots_delays,
    "frontier_next": frontier_next,
    "frontier_visits": frontier_visits,
    "crawl_summary": crawl_counters,
    "crawl_order": crawl_order,
    "crawl_web": crawl_web,
    "crawl_resumed": crawl_resumed,
    "crawl_depth": depths,
    "queue_roundtrip": queue_roundtrip,
}

# RE2 has no Unicode \s and the test pages hold none outside ASCII
HREFS = r"""regexp_extract_all(html, '(?i)<a\s+(?:[^>]*?\s+)?href=["'']([^"'' >#][^"'' >]*)["'']', 1)"""
NETLOC = "regexp_extract({0}, '^[a-zA-Z]+://([^/?#]*)', 1)"
PATH = "regexp_replace(regexp_extract({0}, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')"
# an empty query leaves no question mark
TIDY = r"regexp_replace({0}, '\?$', '')"
LINKS = f"""
raw AS (SELECT page_id, url, unnest({HREFS}) AS href, generate_subscripts({HREFS}, 1) - 1 AS pos FROM pages)"""
# what each form must resolve to, written down from how the form was made
FORMS = f"""
{LINKS},
based AS (
  SELECT *, split_part(url, '://', 1) AS scheme, {NETLOC.format("url")} AS host, {PATH.format("url")} AS path,
         split_part(regexp_replace(href, '^/', ''), '#', 1) AS bare FROM raw),
placed AS (SELECT *, scheme || '://' || host AS site, regexp_replace(path, '[^/]*$', '') AS folder FROM based),
forms AS (
  SELECT page_id, url, pos, 0 AS form, {TIDY.format("site || '/' || bare")} AS abs_url FROM placed
  UNION ALL SELECT page_id, url, pos, 1, {TIDY.format("site || folder || bare")} FROM placed
  UNION ALL SELECT page_id, url, pos, 2, {TIDY.format("site || regexp_replace(folder, '[^/]+/$', '') || bare")} FROM placed
  UNION ALL SELECT page_id, url, pos, 3, {TIDY.format("scheme || '://cdn.' || host || '/' || bare")} FROM placed
  UNION ALL SELECT page_id, url, pos, 4, site || path || '?q=' || bare FROM placed
  UNION ALL SELECT page_id, url, pos, 5, {TIDY.format("site || folder || bare")} FROM placed
  UNION ALL SELECT page_id, url, pos, 6, 'mailto:' || bare FROM placed
  UNION ALL SELECT page_id, url, pos, 7,
    CASE WHEN scheme IN ('http', 'https') THEN {TIDY.format("scheme || '://' || host || '/' || bare")} END FROM placed)"""
ROBOTS = f"""
hosts AS (
  SELECT host, count(*) AS n, min(regexp_extract(path, '^/[^/]*/', 0)) AS low, max(path) AS high
  FROM (SELECT {NETLOC.format("url")} AS host, {PATH.format("url")} AS path FROM pages) GROUP BY host)"""
# what the texts say: odd hosts name their greatest path; the empty value of even ones takes the Allow line; a text
# without another agent has no block in reference mode
RULES = f"""
{ROBOTS},
closed AS (SELECT * FROM hosts WHERE n % 3 <> 0),
delay AS (SELECT host, n || CASE WHEN n % 2 = 1 THEN '.5' ELSE '' END AS value FROM hosts),
rules AS (
  SELECT 'reference' AS mode, host, 0 AS pos, 'disallow' AS kind, low AS value FROM closed
  UNION ALL SELECT 'reference', host, 1, 'delay', value FROM delay JOIN closed USING (host)
  UNION ALL SELECT 'reference', host, 2, 'disallow', CASE WHEN n % 2 = 1 THEN high ELSE 'Allow: /' END FROM closed
  UNION ALL SELECT 'strict', host, 0, 'disallow', low FROM hosts
  UNION ALL SELECT 'strict', host, 1, 'delay', value FROM delay
  UNION ALL SELECT 'strict', host, 2, 'disallow', high FROM hosts WHERE n % 2 = 1)"""
BLOCKED = """EXISTS (SELECT 1 FROM rules r WHERE r.mode = 'reference' AND r.kind = 'disallow' AND r.host = {host}
                     AND starts_with({path}, r.value))"""
STEP = f"""
{LINKS}, {RULES},
queue AS (
  SELECT url, page_id * 2 AS seq FROM pages
  UNION ALL SELECT regexp_replace(url, '[?#].*', '') || '/gone', page_id * 2 + 1 FROM pages),
visited AS (SELECT url FROM pages WHERE url LIKE 'http:%'),
fate AS (
  SELECT url, seq, CASE WHEN {BLOCKED.format(host=NETLOC.format("url"), path=PATH.format("url"))} THEN 'disallowed'
                        WHEN url IN (SELECT url FROM pages) THEN 'fetched' ELSE 'failed' END AS status
  FROM queue WHERE url NOT IN (SELECT url FROM visited)),
fetched AS (SELECT * FROM fate WHERE status = 'fetched' ORDER BY seq LIMIT {BUDGET}),
cut AS (SELECT CASE WHEN count(*) < {BUDGET} THEN (SELECT max(seq) FROM queue) ELSE max(seq) END AS last FROM fetched),
taken AS (SELECT fate.* FROM fate, cut WHERE seq <= last),
found AS (
  SELECT {TIDY.format("split_part(raw.url, '://', 1) || '://' || " + NETLOC.format("raw.url") + " || split_part(href, '#', 1)")} AS url,
         seq, pos FROM raw JOIN fetched USING (url)),
fresh AS (
  SELECT url, min((seq, pos)) AS spot FROM found
  WHERE NOT {BLOCKED.format(host=NETLOC.format("url"), path=PATH.format("url"))}
    AND url NOT IN (SELECT url FROM visited) AND url NOT IN (SELECT url FROM queue) GROUP BY url),
merged AS (
  SELECT url, 0 AS new, (seq, 0) AS spot FROM queue, cut WHERE seq > last
  UNION ALL SELECT url, 1, spot FROM fresh)"""
TREE = """
nodes AS (SELECT page_id AS node, split_part(url, '#', 1) || '?node=' || page_id AS url FROM pages)"""
# round by round: what the last round has found, less what any round has
WEB = f"""
RECURSIVE {RULES},
nodes AS (SELECT page_id AS node, split_part(url, '#', 1) || '?node=' || page_id AS url, html FROM pages),
own AS (SELECT node, url, unnest({HREFS}) AS href, generate_subscripts({HREFS}, 1) AS pos FROM nodes),
linked AS (
  SELECT url, pos, {TIDY.format("split_part(url, '://', 1) || '://' || " + NETLOC.format("url") + " || split_part(href, '#', 1)")} AS target FROM own
  UNION ALL SELECT a.url, 1000000 + b.node, b.url FROM nodes a JOIN nodes b ON b.node > 0 AND (b.node - 1) // 4 = a.node
  UNION ALL SELECT a.url, 1::BIGINT << 40, b.url FROM nodes a JOIN nodes b ON b.node = a.node + 1
  UNION ALL SELECT url, 1::BIGINT << 41, regexp_replace(url, '[?].*', '') || '/gone' FROM nodes),
edges AS MATERIALIZED (
  SELECT url, pos, target, CASE WHEN target IN (SELECT url FROM nodes) THEN 'fetched' ELSE 'failed' END AS status FROM linked
  WHERE NOT {BLOCKED.format(host=NETLOC.format("target"), path=PATH.format("target"))}),
crawled(url, seq, status, from_seq) USING KEY (url) AS (
  SELECT url, node, CASE WHEN {BLOCKED.format(host=NETLOC.format("url"), path=PATH.format("url"))} THEN 'disallowed' ELSE 'fetched' END, -1::BIGINT
  FROM nodes WHERE node < 8
  UNION ALL
  SELECT target, (SELECT max(seq) FROM recurring.crawled) + row_number() OVER (ORDER BY spot), status, spot.seq
  FROM (SELECT target, min({{'seq': c.seq, 'pos': pos}}) AS spot, any_value(e.status) AS status
        FROM crawled c JOIN edges e ON e.url = c.url WHERE c.status = 'fetched' AND target NOT IN (SELECT url FROM recurring.crawled)
        GROUP BY target)),
ended AS (
  SELECT coalesce((SELECT seq FROM (SELECT seq, row_number() OVER (ORDER BY seq) AS n FROM crawled WHERE status = 'fetched')
                   WHERE n = (SELECT count(*) // 2 FROM pages)), (SELECT max(seq) FROM crawled)) AS last)"""
# every directory of a site's page is closed, and everywhere each short first directory
LOOKED_UP = f"""
closed AS (
  SELECT DISTINCT {NETLOC.format("url")} AS host, regexp_replace({PATH.format("url")}, '[^/]*$', '') AS value FROM pages
  UNION SELECT NULL, substring({PATH.format("url")}, 1, 4) FROM pages
  WHERE substring({PATH.format("url")}, 1, 4) LIKE '%/' AND length(substring({PATH.format("url")}, 1, 4)) > 3)"""

SQL = {
    "links_raw": f"WITH {LINKS} SELECT page_id, pos, href FROM raw",
    "links_resolved": f"WITH {FORMS} SELECT page_id, pos, form, abs_url FROM forms",
    "links_same_site": f"WITH {FORMS} SELECT page_id, pos, form, abs_url FROM forms WHERE form NOT IN (3, 6)",
    "links_seed_site": f"""
WITH {FORMS}
SELECT page_id, pos, form, abs_url FROM forms
WHERE {NETLOC.format("abs_url")} = (SELECT {NETLOC.format("url")} FROM pages ORDER BY strlen(html) DESC, page_id DESC LIMIT 1)""",
    "links_allowed": f"""
WITH {FORMS}, {RULES}
SELECT page_id, pos, form, abs_url FROM forms
WHERE NOT {BLOCKED.format(host=NETLOC.format("abs_url"), path=PATH.format("abs_url"))}""",
    "links_looked_up": f"""
WITH {FORMS}, {LOOKED_UP}
SELECT page_id, pos, form, abs_url FROM forms
WHERE NOT EXISTS (SELECT 1 FROM closed r WHERE length(r.value) > 1 AND (r.host IS NULL OR r.host = {NETLOC.format("abs_url")})
                  AND starts_with({PATH.format("abs_url")}, r.value))""",
    "robots_rules": f"WITH {RULES} SELECT mode, host, pos, kind, value FROM rules",
    "robots_delays": f"WITH {ROBOTS} SELECT host, CASE WHEN n % 3 = 0 THEN 15 ELSE n END AS delay FROM hosts",
    "frontier_next": f"WITH {STEP} SELECT url, row_number() OVER (ORDER BY new, spot) - 1 AS seq FROM merged",
    "frontier_visits": f"WITH {STEP} SELECT url, seq, status FROM taken",
    "crawl_summary": f"""
WITH {STEP}
SELECT (SELECT count(*) FROM fetched) AS pages_fetched, (SELECT count(*) FROM taken) AS urls_visited,
       (SELECT count(*) FROM merged) AS urls_remaining""",
    "crawl_order": f"WITH {TREE} SELECT url, node AS seq, 'fetched' AS status FROM nodes",
    "crawl_web": f"""
WITH {WEB}
SELECT url, seq, CASE WHEN seq <= last THEN status ELSE 'queued' END AS status FROM crawled, ended WHERE seq <= last OR from_seq <= last""",
    "crawl_depth": f"""
WITH RECURSIVE {TREE},
reached(node, depth) AS (
  SELECT 0::BIGINT, 0::BIGINT
  UNION ALL SELECT n.node, depth + 1 FROM reached r JOIN nodes n ON n.node > 0 AND (n.node - 1) // 4 = r.node)
SELECT url, depth FROM reached JOIN nodes USING (node)""",
    "queue_roundtrip": r"""
WITH homes AS (
  SELECT regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || '/' AS url, min(page_id) AS first_id FROM pages GROUP BY 1)
SELECT url, row_number() OVER (ORDER BY first_id) - 1 AS seq FROM homes""",
}
SQL["crawl_resumed"] = SQL["crawl_web"]
SQL["robots_files"] = SQL["robots_rules"]
