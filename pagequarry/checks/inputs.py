"""Inputs of the registered queries: the given tables, and larger forms Spark derives from them."""

import hashlib
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import BASE_PARTS, cut_fragment, netloc, url_path, with_base_parts
from ..operators.index import SearchIndex, build_index
from ..operators.links import extract_links
from ..operators.search import Searcher
from ..plans.storage import shared_folder
from ..sources.index_store import load_or_build

INDEX_BUCKETS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. A file with a single row group is one task however large the machine is, so an input with
    fewer splits than cores is spread by its key; a table of many files stays as it lies."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, df.columns[0]) if df.rdd.getNumPartitions() < cores else df


def document_index(spark: SparkSession, sf_dir: str) -> SearchIndex:
    """Lazy index of the documents' text with their small columns as metadata."""
    return build_index(table(spark, sf_dir, "documents"), fields=["text"], metadata=["lang", "source", "n_chars"])


def stored_index(spark: SparkSession, sf_dir: str) -> SearchIndex:
    """The document index, built and stored once per application and loaded by every later search."""
    key = hashlib.sha256(sf_dir.encode()).hexdigest()[:12]
    path = f"{shared_folder(spark)}/pagequarry/index-{spark.sparkContext.applicationId}-{key}"
    return load_or_build(spark, path, lambda: document_index(spark, sf_dir), buckets=INDEX_BUCKETS)


@cache
def searcher(spark: SparkSession, sf_dir: str) -> Searcher:
    """A searcher over the stored index, kept for the session like any index in use."""
    return Searcher(stored_index(spark, sf_dir))


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def site_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark texts and, behind them, the title of each site's first page: more words than fit a literal list."""
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    titles = pages.groupBy(netloc("url")).agg(F.min(F.struct("page_id", title.alias("text"))).alias("first"))
    sites = titles.select((F.lit(1 << 40) + F.col("first.page_id")).alias("query_id"), "first.text")
    return benchmark_queries(spark, sf_dir).unionByName(sites)


def page_links_in_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link of every page in eight forms: as it is, relative, from the parent folder, on another host, as a
    query, with dot segments, as a mail address and absolute with an upper-case scheme."""
    links = extract_links(with_base_parts(table(spark, sf_dir, "pages"), "url"))
    bare = F.regexp_replace("href", "^/", "")
    host = netloc("url")
    forms = F.array(
        F.col("href"),
        bare,
        F.concat(F.lit("../"), bare),
        F.concat(F.lit("//cdn."), host, F.lit("/"), bare),
        F.concat(F.lit("?q="), bare),
        F.concat(F.lit("./a/../"), bare),
        F.concat(F.lit("mailto:"), bare),
        F.concat(F.upper(F.split("url", ":")[0]), F.lit("://"), host, F.lit("/"), bare),
    )
    return links.select("page_id", "url", "pos", *BASE_PARTS, F.posexplode(forms).alias("form", "href"))


def robots_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A robots text per host, made from the number of its pages and its least and greatest paths."""
    pages = table(spark, sf_dir, "pages").select(netloc("url").alias("host"), url_path("url").alias("path"))
    hosts = pages.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.regexp_extract("path", "^/[^/]*/", 0)).alias("low"),
        F.max("path").alias("high"),
    )
    odd = F.col("n") % 2 == 1
    text = F.concat(
        F.lit("User-agent: *\nDisallow: "),
        F.col("low"),
        F.lit("\nCrawl-delay: "),
        F.col("n").cast("string"),
        F.when(odd, F.lit(".5")).otherwise(""),
        F.lit("\nDisallow:"),
        F.when(odd, F.concat(F.lit(" "), F.col("high"))).otherwise(""),
        F.lit("\nAllow: /"),
        F.when(F.col("n") % 3 == 0, F.lit("\n")).otherwise(F.lit("\nUser-agent: bad\nDisallow: /\n")),
    )
    return hosts.select("host", text.alias("text"))


def page_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as a corpus whose links lead on: page ``i`` links to pages ``4i + 1`` to ``4i + 4`` and back to its
    parent. Distances then grow with the table."""
    nodes = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("node"), F.concat(cut_fragment("url"), F.lit("?node="), "page_id").alias("url")
    )
    parent = ((F.col("node") - 1) / 4).cast("bigint")
    down = nodes.where(F.col("node") > 0).select(parent.alias("node"), F.col("node").alias("to"), F.col("url").alias("to_url"))
    up = nodes.where(F.col("node") > 0).select(F.col("node").alias("to"), parent.alias("node"))
    back = up.join(nodes.select("node", F.col("url").alias("to_url")), "node").select(
        F.col("to").alias("node"), F.col("node").alias("to"), "to_url"
    )
    anchor = F.concat(F.lit('<a href="'), F.col("to_url"), F.lit('">x</a>'))
    # five links at most per page
    anchors = down.unionByName(back).groupBy("node").agg(F.array_sort(F.collect_list(F.struct("to", anchor.alias("a")))).alias("as"))
    html = F.array_join(F.transform("as", lambda x: x["a"]), "\n")
    return nodes.join(anchors, "node", "left").select("node", "url", F.coalesce(html, F.lit("")).alias("html"))


def page_web(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with their whole HTML, made into a web: behind what a page has, it links to the pages ``4i + 1`` to
    ``4i + 4`` of the tree, to the page after it and to an address of its own where there is nothing."""
    pages = table(spark, sf_dir, "pages")
    nodes = pages.select("page_id", F.concat(cut_fragment("url"), F.lit("?node="), "page_id").alias("url"), "html")
    targets = nodes.select(F.col("page_id").alias("to"), F.col("url").alias("to_url"))
    tree = targets.where(F.col("to") > 0).select(((F.col("to") - 1) / 4).cast("bigint").alias("page_id"), "to", "to_url")
    after = targets.where(F.col("to") > 0).select((F.col("to") - 1).alias("page_id"), F.lit(1 << 40).alias("to"), "to_url")
    gone = nodes.select("page_id", F.lit(1 << 41).alias("to"), F.concat(F.regexp_replace("url", "[?].*", ""), F.lit("/gone")).alias("to_url"))
    anchor = F.concat(F.lit('\n<a href="'), F.col("to_url"), F.lit('">x</a>'))
    # six links at most per page
    added = tree.unionByName(after).unionByName(gone).groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("to", anchor.alias("a")))).alias("as"))
    html = F.concat("html", F.array_join(F.transform("as", lambda x: x["a"]), ""))
    return nodes.join(added, "page_id").select(F.col("page_id").alias("node"), "url", html.alias("html"))


def stamped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with a download time that follows ``page_id``."""
    at = F.timestamp_add("SECOND", F.col("page_id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, sf_dir, "pages").withColumn("at", at)


def record_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages laid out as record pages: their title, size, paragraph text, language and host in the markup the
    record fields are read from. Some lack the name, some have two countries."""
    pages = table(spark, sf_dir, "pages")
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    lang = F.regexp_extract("html", '<html lang="([a-z]*)"', 1)
    body = F.regexp_extract("html", r"<article>([\s\S]*?)</article>", 1)
    size = F.octet_length("html").cast("string")
    second = F.when(F.length(title) % 2 == 0, F.concat(F.lit('\n <a href="/x">'), F.upper(lang), F.lit("</a>"))).otherwise("")
    layout = F.concat(
        F.when(F.length(title) % 5 == 0, F.lit("<h1>")).otherwise(F.lit('<h1 class="primary_title">')),
        title,
        F.lit('</h1>\n<div class="site-rating" data-votes="'),
        size,
        F.lit('" data-rating="'),
        F.col("page_id").cast("string"),
        F.lit('" data-average=" 3.5 "></div>\n<div class="intro-text text-lead">\n '),
        body,
        F.lit('\n</div>\n<dl><dt class="t">Full Name</dt>\n<dd class="d">\n '),
        title,
        F.lit(' of <small>x</small></dd>\n'),
        # one page in three has a block before it that names no country
        F.when(F.length(title) % 3 == 0, F.lit('<dt class="t">Country</dt>\n<dd class="d">\n unknown\n</dd>\n')).otherwise(""),
        F.lit('<dt class="t">Country</dt>\n<dd class="d">\n <a href="/c">'),
        lang,
        F.lit("</a>"),
        second,
        F.lit('\n</dd>\n<dt class="t">Status</dt>\n<dd class="d">\n Listed '),
        size,
        F.lit(' <span>x</span></dd>\n<dt class="t">Type</dt>\n<dd class="d">\n '),
        netloc("url"),
        F.lit(' <i class="c"></i></dd></dl>'),
    )
    return pages.select("page_id", "url", layout.alias("html"))
