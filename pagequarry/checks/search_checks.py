"""Ranked search, comparison, statistics and display."""

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators.extract import extract_fields
from ..operators.index import build_index
from ..operators.search import Searcher
from .index_checks import IDFS, POSTINGS, TEXT_TOKENS, TOKENS
from .inputs import benchmark_queries, document_index, searcher, site_queries, table

QUERY = "historic thion of the nicht temple"
REPEATED = "thion nicht thion the thion"
SHORT = "the nicht"
# more than Spark cuts inside a task
DEEP = 2_000
GENERIC_RULES = {
    "name": r"<title>([^<]*)</title>",
    "description": r"<article><h1>([^<]*)</h1>",
    "contry": r'<html lang="([a-z]*)"',
}


def rounded(ranked):
    return ranked.withColumn("score", F.round("score", 9))


def flagship(spark, sf_dir):
    """Documents -> index -> ranked search -> metadata, without storing anything."""
    index = Searcher(document_index(spark, sf_dir))
    return rounded(index.with_metadata(index.search(QUERY)))


def search_classic(spark, sf_dir):
    index = searcher(spark, sf_dir)
    return rounded(index.with_metadata(index.search(QUERY)))


def search_smooth(spark, sf_dir):
    index = searcher(spark, sf_dir)
    return rounded(index.with_metadata(index.search(QUERY, "smooth")))


def search_repeated_term(spark, sf_dir):
    return rounded(searcher(spark, sf_dir).search(REPEATED))


def search_batch(spark, sf_dir):
    """The whole benchmark as queries, best ten documents each."""
    index = searcher(spark, sf_dir)
    return rounded(index.search(benchmark_queries(spark, sf_dir))).drop("method")


def search_all_matches(spark, sf_dir):
    """Whole result lists: every matching document of three queries in both methods, ranked, with their number."""
    found = searcher(spark, sf_dir).compare([QUERY, SHORT, REPEATED], top_k=None, matches=True)
    return rounded(found)


def search_deep(spark, sf_dir):
    """The whole benchmark as queries, more documents each than one task should sort."""
    index = searcher(spark, sf_dir)
    return rounded(index.search(benchmark_queries(spark, sf_dir), top_k=DEEP)).drop("method")


def search_many_terms(spark, sf_dir):
    """A table of queries with more distinct words than a literal list takes, with the number of matches."""
    index = searcher(spark, sf_dir)
    return rounded(index.search(site_queries(spark, sf_dir), "smooth", matches=True)).drop("method")


def search_match_count(spark, sf_dir):
    return searcher(spark, sf_dir).match_counts(benchmark_queries(spark, sf_dir))


def compare_idf(spark, sf_dir):
    return rounded(searcher(spark, sf_dir).compare(SHORT, 3))


def term_statistics(spark, sf_dir):
    """Statistics for each benchmark text, for a variant that is unknown and for one too short to be a term."""
    asked = benchmark_queries(spark, sf_dir)
    forms = F.array(F.col("text"), F.concat(F.lit("unseen_"), "text"), F.concat(F.lit("x "), F.substring("text", 1, 2)))
    inputs = asked.select("query_id", F.posexplode(forms).alias("form", "text")).select(
        (F.col("query_id") * 3 + F.col("form")).alias("query_id"), "text"
    )
    found = searcher(spark, sf_dir).term_statistics(inputs)
    places = ("idf_classic", "idf_smooth", "percentage_of_docs")
    return found.drop("input").withColumns({c: F.round(c, 9) for c in places})


def search_display(spark, sf_dir):
    """Search over page records; the name is missing where the title holds an entity."""
    records = extract_fields(table(spark, sf_dir, "pages").select("page_id", "url", "html"), GENERIC_RULES)
    records = records.withColumn("name", F.when(~F.col("name").contains("&"), F.col("name"))).withColumn("type", F.lit(""))
    index = Searcher(build_index(records, "page_id"))
    return index.display(index.search([SHORT, "than ouier der"], top_k=20))


def search_without_answers(spark, sf_dir):
    """Documents found for a word of each benchmark text, for that word unknown, cut to two letters, and for no text at all;
    and -1 for an index without documents, which is refused."""
    word = F.get(tokens(F.col("text")), F.lit(0))
    forms = F.array(word, F.concat(word, F.lit("_unseen")), F.left(word, F.lit(2)), F.lit(""), F.lit(None).cast("string"))
    asked = benchmark_queries(spark, sf_dir).select("query_id", F.posexplode(forms).alias("form", "text"))
    asked = asked.select((F.col("query_id") * 5 + F.col("form")).alias("query_id"), "text")
    index = searcher(spark, sf_dir)
    found = index.search(asked, top_k=None).groupBy("query_id").agg(F.count(F.lit(1)).alias("found"))
    counted = asked.select("query_id").join(found, "query_id", "left").withColumn("found", F.coalesce("found", F.lit(0)))
    try:
        refused = Searcher(build_index(table(spark, sf_dir, "documents").where(F.col("text").isNull() & F.col("text").isNotNull())))
    except ValueError:
        refused = None
    return counted.unionByName(spark.createDataFrame([(-1, -1 if refused is None else 0)], "query_id bigint, found bigint"))


QUERIES = {
    "search_without_answers": search_without_answers,
    "search_from_documents": flagship,
    "search_classic": search_classic,
    "search_smooth": search_smooth,
    "search_repeated_term": search_repeated_term,
    "search_batch": search_batch,
    "search_all_matches": search_all_matches,
    "search_deep": search_deep,
    "search_many_terms": search_many_terms,
    "search_match_count": search_match_count,
    "compare_idf": compare_idf,
    "term_statistics": term_statistics,
    "search_display": search_display,
}

SCORED = f"""
{POSTINGS},
asked AS (SELECT query_id, t, unnest(generate_series(1, len(t))) AS spot
          FROM (SELECT query_id, {TOKENS.format("query")} AS t FROM queries)),
q AS (SELECT query_id, spot - 1 AS pos, t[spot] AS term FROM asked),
w AS (SELECT query_id, doc_id, pos, tf / doc_len AS tf, {IDFS}
      FROM q JOIN postings USING (term) JOIN lens USING (doc_id) JOIN dfs USING (term), corpus),
scored AS (
  SELECT query_id, doc_id, min(pos) AS first_pos, 'classic' AS method, sum(tf * idf_classic) AS score
  FROM w GROUP BY query_id, doc_id
  UNION ALL
  SELECT query_id, doc_id, min(pos), 'smooth', sum(tf * idf_smooth) FROM w GROUP BY query_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, method
                               ORDER BY round(score, 12) DESC, first_pos, doc_id) AS rank FROM scored)"""


def literal(*queries):
    values = ", ".join(f"({i}, '{q}')" for i, q in enumerate(queries))
    return f"WITH queries AS (SELECT * FROM (VALUES {values}) v(query_id, query)), {SCORED}"


BENCHMARK = f"WITH queries AS (SELECT item_id AS query_id, text AS query FROM benchmark), {SCORED}"
SITES = f"""WITH queries AS (
  SELECT item_id AS query_id, text AS query FROM benchmark
  UNION ALL SELECT 1099511627776 + first.page_id, first.title FROM (
    SELECT min({{'page_id': page_id, 'title': regexp_extract(html, '<title>([^<]*)</title>', 1)}}) AS first
    FROM pages GROUP BY regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1))), {SCORED}"""
RANKED = "CAST(query_id AS BIGINT) AS query_id, method, rank, doc_id, round(score, 9) AS score"

SQL = {
    "search_classic": f"""{literal(QUERY)}
SELECT {RANKED}, lang, source, n_chars FROM ranked JOIN documents USING (doc_id) WHERE method = 'classic' AND rank <= 10""",
    "search_smooth": f"""{literal(QUERY)}
SELECT {RANKED}, lang, source, n_chars FROM ranked JOIN documents USING (doc_id) WHERE method = 'smooth' AND rank <= 10""",
    "search_repeated_term": f"{literal(REPEATED)} SELECT {RANKED} FROM ranked WHERE method = 'classic' AND rank <= 10",
    "search_batch": f"""{BENCHMARK}
SELECT query_id, rank, doc_id, round(score, 9) AS score FROM ranked WHERE method = 'classic' AND rank <= 10""",
    "search_all_matches": f"""{literal(QUERY, SHORT, REPEATED)}
SELECT {RANKED}, count(*) OVER (PARTITION BY query_id, method) AS matches FROM ranked""",
    "search_deep": f"""{BENCHMARK}
SELECT query_id, rank, doc_id, round(score, 9) AS score FROM ranked WHERE method = 'classic' AND rank <= {DEEP}""",
    "search_many_terms": f"""{SITES}
SELECT query_id, rank, doc_id, round(score, 9) AS score, matches
FROM (SELECT *, count(*) OVER (PARTITION BY query_id) AS matches FROM ranked WHERE method = 'smooth') WHERE rank <= 10""",
    "search_match_count": f"""{BENCHMARK}
SELECT item_id AS query_id, count(doc_id) AS matches
FROM benchmark LEFT JOIN (SELECT * FROM scored WHERE method = 'classic') s ON s.query_id = item_id GROUP BY item_id""",
    "compare_idf": f"{literal(SHORT)} SELECT {RANKED} FROM ranked WHERE rank <= 3",
    "term_statistics": f"""
WITH {POSTINGS},
inputs AS (
  SELECT item_id * 3 AS query_id, text FROM benchmark
  UNION ALL SELECT item_id * 3 + 1, 'unseen_' || text FROM benchmark
  UNION ALL SELECT item_id * 3 + 2, 'x ' || substring(text, 1, 2) FROM benchmark),
asked AS (SELECT query_id, ({TEXT_TOKENS})[1] AS term FROM inputs),
idfs AS (SELECT query_id, term, df, occurrences, n, {IDFS} FROM asked LEFT JOIN dfs USING (term), corpus)
SELECT query_id, term,
       CASE WHEN term IS NULL THEN 'invalid' WHEN df IS NULL THEN 'not_found' ELSE 'found' END AS status,
       df AS document_frequency, occurrences AS total_occurrences,
       CASE WHEN df IS NOT NULL THEN round(idf_classic, 9) END AS idf_classic,
       CASE WHEN df IS NOT NULL THEN round(idf_smooth, 9) END AS idf_smooth,
       round(df / n * 100, 9) AS percentage_of_docs
FROM idfs""",
    "search_display": f"""
WITH records AS (
  SELECT page_id AS doc_id, url,
         CASE WHEN title NOT LIKE '%&%' THEN title END AS name, description, lang
  FROM (SELECT page_id, url, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title,
               regexp_replace(trim(regexp_extract(html, '<article><h1>([^<]*)</h1>', 1)), '<[^<]+?>', '', 'g') AS description,
               regexp_extract(html, '<html lang="([a-z]*)"', 1) AS lang FROM pages)),
documents AS (SELECT doc_id, concat_ws(' ', name, description, lang) AS text FROM records),
{literal(SHORT, "than ouier der").removeprefix("WITH ")}
SELECT CAST(query_id AS BIGINT) AS query_id, rank, coalesce(name, 'N/A') AS name, printf('%.4f', score) AS score,
       url, nullif(lang, '') AS country, CAST(NULL AS VARCHAR) AS type
FROM ranked JOIN records USING (doc_id) WHERE method = 'classic' AND rank <= 20""",
}
SQL["search_from_documents"] = SQL["search_classic"]
SQL["search_without_answers"] = f"""
WITH {POSTINGS},
words AS (SELECT item_id * 5 AS query_id, ({TEXT_TOKENS})[1] AS term FROM benchmark),
asked AS (SELECT query_id, term FROM words UNION ALL SELECT query_id + unnest([1, 2, 3, 4]), NULL FROM words)
SELECT query_id, coalesce(df, 0) AS found FROM asked LEFT JOIN dfs USING (term) UNION ALL SELECT -1, -1"""
