"""URL verdicts from allow and block rules, carried over to aliases.

A rule names a host and the beginning of a path. It fits its host with all subdomains, and of the fitting rules the
longest decides. URLs that redirect to each other or name the same canonical page are one resource: where no rule
fits a URL itself, its aliases decide, an explicit allow among them before a block; without either it is allowed.

Matching is an equality join of the few (host suffix, path prefix) pairs a URL has with the rules, so many rules for one
host cost nothing more. Aliases are connected components over redirect and canonical links.

Edge cases: a null URL, or one without ``://``, has empty host and path, fits no rule and is no alias; a page without
html has no links; rules that say both for the same host and path count as allow; other columns of the pages pass
through unless named like an output; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.links import resolve_links
from ..plans.joins import lookup_join
from ..plans.storage import written
from .components import connected_components

# The rules of the registered query.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
# a tag ends where the next one begins at the latest, so the time is linear in the page
CANONICAL = r"(?is)<link\s[^<>]*rel\s*=\s*[\"']?canonical[\"'\s>][^<>]*"
REFRESH = r"(?is)<meta\s[^<>]*http-equiv\s*=\s*[\"']?refresh[\"'\s>][^<>]*"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """``host, path, verdict`` of given rules."""
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def host_of(url: str) -> Column:
    """What stands between the first ``://`` and the path, in lower case; empty without it."""
    host = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: str) -> Column:
    """From the end of the host to the query or fragment."""
    return F.coalesce(F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: str) -> Column:
    """A URL as a node of the link graph: scheme and host in lower case, without what follows a ``#`` behind the host; null
    where there is no ``://``."""
    whole = F.regexp_extract(F.col(url), r"(?s)^.*?://[^#]*", 0)
    head = F.regexp_extract(F.col(url), r"^[^/?#]*?://[^/?#]*", 0)
    lowered = F.concat(F.translate(head, UPPER, LOWER), F.substring(whole, F.length(head) + 1, F.length(whole)))
    return F.when(F.contains(F.col(url), F.lit("://")), lowered)


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``url, target`` of the canonical link and the redirect of each page."""
    link = F.regexp_extract(F.col(html), CANONICAL + r"?>", 0)
    canonical = F.regexp_extract(link, r"(?is)\shref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    meta = F.regexp_extract(F.col(html), REFRESH + r"?>", 0)
    redirect = F.regexp_extract(meta, r"(?is)url\s*=\s*[\"']?([^\"'\s>]+)", 1)
    named = pages.select(F.col(url).alias("url"), F.explode(F.array(canonical, redirect)).alias("href"))
    named = named.where(F.col("url").isNotNull() & (F.col("href") != ""))
    found = resolve_links(named.withColumn("href", F.replace("href", F.lit("&amp;"), F.lit("&"))))
    return found.select("url", F.col("abs_url").alias("target"))


def best_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``node, rule, verdict`` of the nodes that a rule fits; ``urls`` has distinct ``node``."""
    usable = rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
    # both bounded by how long a host or path can be, not by how many rules there are
    lengths = [r[0] for r in usable.select(F.length("path")).distinct().collect()]
    labels = usable.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    allow_first = F.when(F.col("verdict") == "allow", 0).otherwise(1)
    chosen = usable.groupBy("host", "path").agg(F.min_by("verdict", allow_first).alias("verdict"))
    # a host holds no line end, so the joined text stands for the pair
    ruled = chosen.select(F.concat("host", F.lit("\n"), "path").alias("_key"), F.concat("host", "path").alias("rule"), "verdict")
    placed = urls.select("node", host_of("node").alias("_host"), path_of("node").alias("_path"))
    parts = F.split("_host", r"\.")
    counts = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(labels, 1))))
    suffixes = F.transform(counts, lambda k: F.array_join(F.slice(parts, F.size(parts) - k + 1, k), "."))
    sizes = F.filter(F.array(*[F.lit(n) for n in sorted(lengths)]).cast("array<int>"), lambda n: n <= F.length("_path"))
    prefixes = F.transform(sizes, lambda n: F.left("_path", n))
    pairs = (
        placed.select("node", "_path", F.explode(suffixes).alias("_h"), prefixes.alias("_prefixes"))
        .select("node", "_h", F.explode("_prefixes").alias("_p"))
        .select("node", F.concat("_h", F.lit("\n"), "_p").alias("_key"))
    )
    fitting = lookup_join(pairs, ruled, "_key", spread_by="node")
    best = F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("_best")
    return fitting.groupBy("node").agg(best).select("node", "_best.rule", "_best.verdict")


def judge_urls(
    pages: DataFrame, rules: DataFrame, links: DataFrame | None = None, url: str = "url", html: str = "html"
) -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (null where none fits) and ``verdict`` to every page.

    ``links(url, target)`` are further redirects, such as those of a download log; those in the html are always used.
    """
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", html)]
    found = page_links(pages, url, html)
    if links is not None:
        found = found.unionByName(links.select("url", "target"))
    edges = written(found.select(node_of("url").alias("a"), node_of("target").alias("b")), "aliases")
    rows = pages.select(*others, node_of(url).alias("_node"))
    urls = rows.select(F.col("_node").alias("node")).unionByName(edges.select(F.col("b").alias("node")))
    ruled = written(best_rules(urls.where(F.col("node").isNotNull()).distinct(), rules), "ruled")

    members = connected_components(edges)
    known = members.join(ruled, "node")
    decided = known.groupBy("component").agg(F.min("verdict").alias("_by_alias"))  # 'allow' before 'block'
    aliases = members.join(decided, "component").select("node", "_by_alias")
    both = ruled.join(written(aliases, "by-alias"), "node", "full").select(
        F.col("node").alias("_node"), F.col("rule").alias("_rule"), F.coalesce("verdict", "_by_alias").alias("_verdict")
    )
    judged = lookup_join(rows, both, "_node", "left", spread_by=url)
    return judged.select(
        *others,
        host_of(url).alias("host"),
        path_of(url).alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.lit("allow")).alias("verdict"),
    )
