"""Page inventory, extraction, record files and streaming intake."""

from pyspark.sql import functions as F

from ..functions.text import strip_markup
from ..functions.url import page_rel_path
from ..operators.extract import FIELD_RULES, extract_fields, extract_records, join_log_pages, select_pages
from ..operators.index import build_index, number_documents
from ..operators.search import Searcher
from ..plans.ordering import number_rows
from ..plans.storage import fresh_path
from ..sources.pages import (
    append_log,
    latest_pages,
    load_queue,
    page_inventory,
    page_number,
    path_collisions,
    read_log,
    read_page_files,
    save_queue,
    write_page_files,
)
from ..sources.records import read_records, write_records
from ..streaming.intake import first_seen, read_intake, read_page_stream, start_first_copies, start_intake
from .inputs import record_pages, stamped_pages, table
from .search_checks import literal

PAGE_RULES = {
    "title": r"<title>([^<]*)</title>",
    "h1": r"<h1>([^<]*)</h1>",
    "lang": r'<html lang="([a-z]*)"',
    "charset": r'<meta charset="(.*?)"',
}
# pages of one language tie in the first, and both hold words of many titles
ORDERED_QUERIES = ["the nicht", "that und que"]
COPY = 1 << 40
LANGUAGE_PATHS = r"^(en|fr)/.+"


def inventory(spark, sf_dir):
    return page_inventory(stamped_pages(spark, sf_dir), "at").drop("at")


def log_roundtrip(spark, sf_dir):
    """The download log appended twice, once per scheme, and read back."""
    log = inventory(spark, sf_dir)
    path = fresh_path(spark, "log")
    append_log(log.where(F.col("url").startswith("https:")), path)
    append_log(log.where(~F.col("url").startswith("https:")), path)
    return read_log(spark, path)


def placed_pages(spark, sf_dir):
    """The pages with their file path; no join, the path comes from the URL."""
    return stamped_pages(spark, sf_dir).withColumn("filepath_saved", page_rel_path("url"))


def collisions(spark, sf_dir):
    found = path_collisions(placed_pages(spark, sf_dir), ["at", "page_id"])
    return found.select(
        "filepath_saved",
        "n_pages",
        F.col("first_page.page_id").alias("first_page_id"),
        F.col("last_page.page_id").alias("last_page_id"),
    )


def page_latest(spark, sf_dir):
    """The page that stays under each path, with a digest of its text."""
    kept = latest_pages(placed_pages(spark, sf_dir), ["at", "page_id"])
    return kept.select("filepath_saved", "page_id", F.md5("html").alias("digest"))


def page_select(spark, sf_dir):
    """Pages of the wanted class per language folder: count and bytes."""
    chosen = select_pages(inventory(spark, sf_dir), pattern=LANGUAGE_PATHS)
    folder = F.split("filepath_saved", "/")[0]
    return chosen.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("n_pages"), F.sum("filesize_bytes").alias("bytes"))


def doubled_log(spark, sf_dir):
    """The download log with every https row twice, as after a restarted crawl."""
    log = inventory(spark, sf_dir)
    return log.unionByName(log.where(F.col("url").startswith("https:")))


def kept_pages(spark, sf_dir):
    """The page table without German pages, as if those files were gone."""
    kept = latest_pages(placed_pages(spark, sf_dir), ["at", "page_id"])
    return kept.where(~F.col("filepath_saved").startswith("de/"))


def log_page_join(spark, sf_dir):
    pages = kept_pages(spark, sf_dir).select("filepath_saved", F.octet_length("html").cast("bigint").alias("page_bytes"))
    return join_log_pages(doubled_log(spark, sf_dir), pages).select("url", "filepath_saved", "filesize_bytes", "page_bytes")


def records_of_log(spark, sf_dir):
    """The whole extraction job over log and page table, with generic rules."""
    return extract_records(doubled_log(spark, sf_dir), kept_pages(spark, sf_dir), PAGE_RULES, LANGUAGE_PATHS)


def record_fields(spark, sf_dir):
    """The nine record fields of every page laid out as a record page."""
    found = extract_fields(record_pages(spark, sf_dir))
    return found.withColumn("description", F.md5("description"))


def extract_generic(spark, sf_dir):
    return extract_fields(table(spark, sf_dir, "pages"), PAGE_RULES)


def stripped(spark, sf_dir):
    """Article bodies without markup, as size and digest."""
    bodies = extract_fields(table(spark, sf_dir, "pages"), {"body": r"<article>([\s\S]*?)</article>"})
    plain = strip_markup("body")
    return bodies.select("page_id", F.length(plain).cast("bigint").alias("n_chars"), F.md5(plain).alias("digest"))


def records_csv_roundtrip(spark, sf_dir):
    """Records with bodies full of quotes and commas, written as CSV and read back."""
    records = extract_fields(table(spark, sf_dir, "pages"), {**PAGE_RULES, "body": r"<body>([\s\S]*?)</body>"})
    path = fresh_path(spark, "records")
    write_records(records.drop("page_id"), path)
    columns = ["url", *PAGE_RULES, "body"]
    return read_records(spark, path, columns).withColumn("body", F.md5("body"))


def stream_page_dedup(spark, sf_dir):
    """Pages in two batches, the plain-http ones repeated, taken in by a stream that drops repeats."""
    pages = table(spark, sf_dir, "pages")
    source, sink, state = (fresh_path(spark, f"intake-{d}") for d in ("in", "out", "state"))
    repeats = pages.where(F.col("url").startswith("http:"))
    for batch in (pages.unionByName(repeats), repeats):
        batch.write.mode("append").parquet(source)
        query = start_intake(first_seen(read_page_stream(spark, source)), sink, state)
        query.awaitTermination()
    return spark.read.parquet(sink).select("page_id", "url")


def page_latest_many(spark, sf_dir):
    """The page that stays under each path, with more losers than are sent to the pages."""
    kept = latest_pages(placed_pages(spark, sf_dir), ["at", "page_id"], limit=0)
    return kept.select("filepath_saved", "page_id", F.md5("html").alias("digest"))


def records_in_order(spark, sf_dir):
    """From log to ranking in the order of the log: pages appended by size, then the https ones once more, extracted, written
    as CSV, read, numbered, indexed and searched. Ties of the ranking follow the log, not the URLs."""
    log = inventory(spark, sf_dir)
    path, csv = fresh_path(spark, "log"), fresh_path(spark, "records")
    append_log(log, path, ["filesize_bytes", "page_id"])
    append_log(log.where(F.col("url").startswith("https:")), path, ["page_id"])
    pages = latest_pages(placed_pages(spark, sf_dir), ["at", "page_id"])
    rules = {"name": PAGE_RULES["title"], "contry": PAGE_RULES["lang"]}
    records = extract_records(read_log(spark, path, numbered=True), pages, rules, LANGUAGE_PATHS)
    write_records(records, csv, ["seq"])
    numbered = number_documents(read_records(spark, csv, ["url", *rules], numbered=True), ["seq"])
    index = Searcher(build_index(numbered, metadata=["url"]))
    found = index.with_metadata(index.search(ORDERED_QUERIES, top_k=None))
    return found.select("query_id", "rank", "doc_id", "url", F.round("score", 9).alias("score"))


def stream_first_copy(spark, sf_dir):
    """Pages delivered in two batches, the later ones with altered copies: the first page of each URL stays."""
    pages = table(spark, sf_dir, "pages")
    source, sink, state = (fresh_path(spark, f"first-{d}") for d in ("in", "out", "state"))
    altered = pages.select((F.col("page_id") + COPY).alias("page_id"), "url", F.concat(F.lit("copy "), "html").alias("html"))
    early, late = pages.where(F.col("url").startswith("http:")), pages.where(~F.col("url").startswith("http:"))
    copies = altered.where(F.col("url").startswith("http:"))
    for batch in (early.unionByName(copies), late.unionByName(copies).unionByName(altered)):
        batch.write.mode("append").parquet(source)
        start_first_copies(read_page_stream(spark, source), sink, state).awaitTermination()
    return read_intake(spark, sink).select("page_id", "url", F.md5("html").alias("digest"))


def queue_versions(spark, sf_dir):
    """The queue of all pages by size saved, then replaced by its second half: what is loaded is the newest version."""
    path = fresh_path(spark, "queues")
    queue = number_rows(inventory(spark, sf_dir).select("page_id", "url", "filesize_bytes"), ["filesize_bytes", "page_id"], "seq")
    save_queue(queue, path)
    half = load_queue(spark, path).agg(F.floor(F.count(F.lit(1)) / 2)).scalar()
    save_queue(load_queue(spark, path).where(F.col("seq") >= half), path)
    return load_queue(spark, path)


def page_files(spark, sf_dir):
    """Every page as a text file of its own, found and read again by file path."""
    path = fresh_path(spark, "page-files")
    write_page_files(table(spark, sf_dir, "pages"), path)
    back = read_page_files(spark, path)
    return back.select(page_number("filepath_saved").alias("page_id"), F.md5("html").alias("digest"))


QUERIES = {
    "page_files": page_files,
    "page_latest_many": page_latest_many,
    "records_in_order": records_in_order,
    "stream_first_copy": stream_first_copy,
    "queue_versions": queue_versions,
    "page_inventory": inventory,
    "log_roundtrip": log_roundtrip,
    "path_collisions": collisions,
    "page_latest": page_latest,
    "page_select": page_select,
    "log_page_join": log_page_join,
    "extract_records": records_of_log,
    "extract_fields": record_fields,
    "extract_generic": extract_generic,
    "strip_markup": stripped,
    "records_csv_roundtrip": records_csv_roundtrip,
    "stream_page_dedup": stream_page_dedup,
}

PATH = r"regexp_replace(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', ''), '^/+', '')"
REL_PATH = f"CASE WHEN {PATH} = '' OR {PATH} LIKE '%/' THEN {PATH} || 'index.html' ELSE {PATH} END"
LOG = f"""
log AS (
  SELECT page_id, url, strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%S.%f') AS downloaded_at,
         strlen(html) AS filesize_bytes, {REL_PATH} AS filepath_saved, html FROM pages)"""
LATEST = f"""
{LOG},
latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY filepath_saved ORDER BY page_id DESC) AS back FROM log)
  WHERE back = 1),
kept AS (SELECT * FROM latest WHERE filepath_saved NOT LIKE 'de/%'),
doubled AS (SELECT * FROM log UNION ALL SELECT * FROM log WHERE url LIKE 'https:%')"""


def first_of(pattern, column="html"):
    # the ends of the test pages' fields hold ASCII whitespace only
    return f"""trim(regexp_extract({column}, '{pattern}', 1), E' \\t\\n\\r')"""


PAGE_FIELDS = ", ".join(f"{first_of(p)} AS {c}" for c, p in PAGE_RULES.items())
RECORDS = f"""
parts AS (
  SELECT page_id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
         regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang,
         regexp_extract(html, '<article>([\\s\\S]*?)</article>', 1) AS body,
         strlen(html)::VARCHAR AS size, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages),
laid AS (
  SELECT page_id, url,
    CASE WHEN length(title) % 5 = 0 THEN '<h1>' ELSE '<h1 class="primary_title">' END || title || E'</h1>\\n'
    || '<div class="site-rating" data-votes="' || size || '" data-rating="' || page_id || '" data-average=" 3.5 "></div>'
    || E'\\n<div class="intro-text text-lead">\\n ' || body || E'\\n</div>\\n<dl><dt class="t">Full Name</dt>\\n<dd class="d">\\n '
    || title || E' of <small>x</small></dd>\\n'
    || CASE WHEN length(title) % 3 = 0 THEN E'<dt class="t">Country</dt>\\n<dd class="d">\\n unknown\\n</dd>\\n' ELSE '' END
    || E'<dt class="t">Country</dt>\\n<dd class="d">\\n <a href="/c">' || lang || '</a>'
    || CASE WHEN length(title) % 2 = 0 THEN E'\\n <a href="/x">' || upper(lang) || '</a>' ELSE '' END
    || E'\\n</dd>\\n<dt class="t">Status</dt>\\n<dd class="d">\\n Listed ' || size
    || E' <span>x</span></dd>\\n<dt class="t">Type</dt>\\n<dd class="d">\\n ' || host || ' <i class="c"></i></dd></dl>' AS html
  FROM parts)"""
RECORD_FIELDS = ", ".join(
    f"md5(regexp_replace({first_of(p)}, '<[^<]+?>', '', 'g')) AS {c}" if c == "description" else f"{first_of(p)} AS {c}"
    for c, p in FIELD_RULES.items()
)

SQL = {
    "page_inventory": f"WITH {LOG} SELECT page_id, url, downloaded_at, filesize_bytes, filepath_saved FROM log",
    "log_roundtrip": f"WITH {LOG} SELECT url, downloaded_at, filesize_bytes, filepath_saved FROM log",
    "path_collisions": f"""
WITH {LOG}
SELECT filepath_saved, count(*) AS n_pages, min(page_id) AS first_page_id, max(page_id) AS last_page_id
FROM log GROUP BY filepath_saved HAVING count(*) > 1""",
    "page_latest": f"WITH {LATEST} SELECT filepath_saved, page_id, md5(html) AS digest FROM latest",
    "page_select": f"""
WITH {LOG}
SELECT split_part(filepath_saved, '/', 1) AS folder, count(*) AS n_pages, sum(filesize_bytes)::BIGINT AS bytes
FROM log WHERE regexp_matches(filepath_saved, '{LANGUAGE_PATHS}') GROUP BY 1""",
    "log_page_join": f"""
WITH {LATEST}
SELECT d.url, d.filepath_saved, d.filesize_bytes, strlen(k.html) AS page_bytes
FROM doubled d JOIN kept k USING (filepath_saved)""",
    "extract_records": f"""
WITH {LATEST}
SELECT d.url, {", ".join(f"{first_of(p, 'k.html')} AS {c}" for c, p in PAGE_RULES.items())}
FROM doubled d JOIN kept k USING (filepath_saved) WHERE regexp_matches(d.filepath_saved, '{LANGUAGE_PATHS}')""",
    "extract_fields": f"WITH {RECORDS} SELECT page_id, url, {RECORD_FIELDS} FROM laid",
    "extract_generic": f"SELECT page_id, url, {PAGE_FIELDS} FROM pages",
    "strip_markup": r"""
SELECT page_id, length(plain) AS n_chars, md5(plain) AS digest
FROM (SELECT page_id, regexp_replace(trim(regexp_extract(html, '<article>([\s\S]*?)</article>', 1), E' \t\n\r'),
                                     '<[^<]+?>', '', 'g') AS plain FROM pages)""",
    "records_csv_roundtrip": rf"""
SELECT url, {PAGE_FIELDS}, md5({first_of(r"<body>([\s\S]*?)</body>")}) AS body FROM pages""",
    "stream_page_dedup": "SELECT page_id, url FROM pages",
}
SQL["page_latest_many"] = SQL["page_latest"]
SQL["records_in_order"] = f"""
WITH {LATEST},
appended AS (
  SELECT 0 AS time, filesize_bytes AS place, page_id, url, filepath_saved FROM log
  UNION ALL SELECT 1, 0, page_id, url, filepath_saved FROM log WHERE url LIKE 'https:%'),
records AS (
  SELECT row_number() OVER (ORDER BY time, place, a.page_id) - 1 AS doc_id, a.url,
         {first_of(PAGE_RULES["title"], "k.html")} AS name, {first_of(PAGE_RULES["lang"], "k.html")} AS lang
  FROM appended a JOIN latest k USING (filepath_saved) WHERE regexp_matches(a.filepath_saved, '{LANGUAGE_PATHS}')),
documents AS (SELECT doc_id, concat_ws(' ', name, lang) AS text FROM records),
{literal(*ORDERED_QUERIES).removeprefix("WITH ")}
SELECT CAST(query_id AS BIGINT) AS query_id, rank, doc_id, url, round(score, 9) AS score
FROM ranked JOIN records USING (doc_id) WHERE method = 'classic'"""
SQL["stream_first_copy"] = """
SELECT page_id, url, md5(html) AS digest
FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY page_id) AS copy FROM pages) WHERE copy = 1"""
SQL["queue_versions"] = """
SELECT url, seq FROM (SELECT url, row_number() OVER (ORDER BY strlen(html), page_id) - 1 AS seq, count(*) OVER () AS n FROM pages)
WHERE seq >= n // 2"""
# the writer ends a file with a line end
SQL["page_files"] = "SELECT page_id, md5(html || chr(10)) AS digest FROM pages"
