"""Tokens, postings, statistics, numbering and index storage."""

from pyspark.sql import functions as F

from ..functions.text import tokens as text_tokens
from ..operators.index import build_index, explode_tokens, number_documents, present_fields
from ..plans.joins import together
from ..plans.storage import fresh_path
from ..sources.index_store import load_index, load_or_build, save_index
from .inputs import INDEX_BUCKETS, document_index, searcher, table

TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]{{3,}}')"
TEXT_TOKENS = TOKENS.format("text")
POSTINGS = f"""
toks AS (SELECT doc_id, unnest({TEXT_TOKENS}) AS term FROM documents),
postings AS (SELECT term, doc_id, count(*) AS tf FROM toks GROUP BY term, doc_id),
lens AS (SELECT doc_id, len({TEXT_TOKENS}) AS doc_len FROM documents),
dfs AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS occurrences FROM postings GROUP BY term),
corpus AS (SELECT count(*) AS n FROM documents)"""
IDFS = """CASE WHEN df > 0 THEN ln(n / df) ELSE 0 END AS idf_classic, ln((n + 1) / (df + 1)) + 1 AS idf_smooth"""


def tokens(spark, sf_dir):
    """All tokens of each document in order, as a count and a digest of the whole list."""
    found = table(spark, sf_dir, "documents").select("doc_id", text_tokens(F.col("text")).alias("tokens"))
    return found.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest")
    )


def tokens_fields(spark, sf_dir):
    """Tokens over several fields, counted per document with the last position and distinct terms."""
    fields = ["source", "text", "nosuch", "lang"]
    docs = table(spark, sf_dir, "documents")
    # the texts are shuffled once; their tokens, many times as long, are grouped where they are
    docs = together(docs.select("doc_id", *present_fields(docs, fields)), "doc_id")
    rows = explode_tokens(docs, fields)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.max("pos").cast("bigint").alias("last_pos"),
        F.countDistinct("term").alias("n_terms"),
        F.min_by("term", "pos").alias("first_term"),
        F.max_by("term", "pos").alias("last_term"),
    )


def postings(spark, sf_dir):
    """Every posting, folded to one digest row per document."""
    rows = document_index(spark, sf_dir).postings
    entry = F.concat("term", F.lit(":"), F.col("tf").cast("string"))
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.sum("tf").alias("doc_len"),
        F.md5(F.array_join(F.array_sort(F.collect_list(entry)), " ")).alias("digest"),
    )


def term_df(spark, sf_dir):
    return document_index(spark, sf_dir).term_df


def doc_lengths(spark, sf_dir):
    return document_index(spark, sf_dir).doc_lengths


def corpus_stats(spark, sf_dir):
    return document_index(spark, sf_dir).corpus_stats.select(
        "total_docs", "total_unique_terms", F.array_join("indexed_fields", ",").alias("indexed_fields")
    )


def doc_numbering(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return number_documents(pages, ["url", "page_id"])


def index_roundtrip(spark, sf_dir):
    """Save the index, load it, and account for every table of it."""
    path = fresh_path(spark, "roundtrip")
    save_index(document_index(spark, sf_dir), path, INDEX_BUCKETS)
    index = load_index(spark, path)
    sums = {"postings": "tf", "docs": "n_chars", "term_df": "df", "doc_lengths": "doc_len"}
    parts = [
        getattr(index, name).agg(F.count(F.lit(1)).alias("n_rows"), F.sum(c).alias("total")).select(F.lit(name).alias("table_name"), "*")
        for name, c in sums.items()
    ]
    stats = index.corpus_stats.select(F.lit("corpus_stats").alias("table_name"), F.lit(1).cast("bigint").alias("n_rows"), F.col("total_docs").alias("total"))
    out = stats
    for part in parts:
        out = out.unionByName(part)
    return out


def vocabulary_idf(spark, sf_dir):
    """Both IDFs of the whole vocabulary."""
    idfs = searcher(spark, sf_dir).vocabulary_idf()
    return idfs.select("term", "df", F.round("idf_classic", 9).alias("idf_classic"), F.round("idf_smooth", 9).alias("idf_smooth"))


def idf_table(spark, sf_dir):
    """IDFs of requested terms: every term of the benchmark, and a variant of each that no document has."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(text_tokens(F.col("text"))).alias("text")).distinct()
    asked = words.unionByName(words.select(F.concat("text", F.lit("_unseen")).alias("text")))
    found = searcher(spark, sf_dir).idf_table(asked.select(F.lit(0).alias("query_id"), "text"))
    return found.select("term", "df", F.round("idf_classic", 9).alias("idf_classic"), F.round("idf_smooth", 9).alias("idf_smooth"))


def tfidf_weights(spark, sf_dir):
    """Both weights of every posting, summed up per document."""
    weights = searcher(spark, sf_dir).weights()
    return weights.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"),
        F.round(F.sum("tf"), 6).alias("tf"),
        F.round(F.sum("tfidf_classic"), 6).alias("tfidf_classic"),
        F.round(F.max("tfidf_classic"), 9).alias("top_classic"),
        F.round(F.sum("tfidf_smooth"), 6).alias("tfidf_smooth"),
        F.round(F.max("tfidf_smooth"), 9).alias("top_smooth"),
    )


def index_load_or_build(spark, sf_dir):
    """A stored index three times: built, loaded (building again would fail), and rebuilt by force over another table."""
    path = fresh_path(spark, "load-or-build")
    benchmark = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")

    def never():
        raise AssertionError("a stored index was not loaded")

    def totals(step, index):
        return index.corpus_stats.select(F.lit(step).alias("step"), "total_docs", "total_unique_terms")

    built = totals("built", load_or_build(spark, path, lambda: document_index(spark, sf_dir), buckets=INDEX_BUCKETS))
    loaded = totals("loaded", load_or_build(spark, path, never, buckets=INDEX_BUCKETS))
    other = lambda: build_index(benchmark, fields=["text"])
    rebuilt = totals("rebuilt", load_or_build(spark, path, other, force_rebuild=True, buckets=INDEX_BUCKETS))
    return built.unionByName(loaded).unionByName(rebuilt).unionByName(totals("newest", load_index(spark, path)))


QUERIES = {
    "index_load_or_build": index_load_or_build,
    "tokens": tokens,
    "tokens_fields": tokens_fields,
    "postings": postings,
    "term_df": term_df,
    "doc_lengths": doc_lengths,
    "corpus_stats": corpus_stats,
    "doc_numbering": doc_numbering,
    "index_roundtrip": index_roundtrip,
    "vocabulary_idf": vocabulary_idf,
    "idf_table": idf_table,
    "tfidf_weights": tfidf_weights,
}

_ALL_FIELDS = " || ".join(TOKENS.format(c) for c in ("source", "text", "lang"))
SQL = {
    "tokens": f"""
SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS digest
FROM (SELECT doc_id, {TEXT_TOKENS} AS t FROM documents)""",
    "tokens_fields": f"""
SELECT doc_id, len(t) AS n_tokens, len(t) - 1 AS last_pos, len(list_distinct(t)) AS n_terms,
       t[1] AS first_term, t[len(t)] AS last_term
FROM (SELECT doc_id, {_ALL_FIELDS} AS t FROM documents) WHERE len(t) > 0""",
    "postings": f"""
WITH {POSTINGS}
SELECT doc_id, count(*) AS n_terms, sum(tf)::BIGINT AS doc_len,
       md5(string_agg(term || ':' || tf, ' ' ORDER BY term || ':' || tf)) AS digest
FROM postings GROUP BY doc_id""",
    "term_df": f"WITH {POSTINGS} SELECT term, df, occurrences FROM dfs",
    "doc_lengths": f"WITH {POSTINGS} SELECT doc_id, doc_len FROM lens",
    "corpus_stats": f"""
WITH {POSTINGS}
SELECT (SELECT n FROM corpus) AS total_docs, (SELECT count(*) FROM dfs) AS total_unique_terms, 'text' AS indexed_fields""",
    "doc_numbering": "SELECT page_id, url, row_number() OVER (ORDER BY url, page_id) - 1 AS doc_id FROM pages",
    "index_roundtrip": f"""
WITH {POSTINGS}
SELECT 'postings' AS table_name, count(*) AS n_rows, sum(tf)::BIGINT AS total FROM postings
UNION ALL SELECT 'docs', count(*), sum(n_chars)::BIGINT FROM documents
UNION ALL SELECT 'term_df', count(*), sum(df)::BIGINT FROM dfs
UNION ALL SELECT 'doc_lengths', count(*), sum(doc_len)::BIGINT FROM lens
UNION ALL SELECT 'corpus_stats', 1, n FROM corpus""",
    "vocabulary_idf": f"""
WITH {POSTINGS}, idfs AS (SELECT term, df, {IDFS} FROM dfs, corpus)
SELECT term, df, round(idf_classic, 9) AS idf_classic, round(idf_smooth, 9) AS idf_smooth FROM idfs""",
    "idf_table": f"""
WITH {POSTINGS},
words AS (SELECT DISTINCT unnest({TEXT_TOKENS}) AS term FROM benchmark),
asked AS (SELECT term FROM words UNION ALL SELECT term || '_unseen' FROM words),
found AS (SELECT term, coalesce(df, 0) AS df, n FROM asked LEFT JOIN dfs USING (term), corpus),
idfs AS (SELECT term, df, {IDFS} FROM found)
SELECT term, df, round(idf_classic, 9) AS idf_classic, round(idf_smooth, 9) AS idf_smooth FROM idfs""",
    "tfidf_weights": f"""
WITH {POSTINGS},
w AS (SELECT doc_id, tf / doc_len AS tf, {IDFS}
      FROM postings JOIN lens USING (doc_id) JOIN dfs USING (term), corpus)
SELECT doc_id, count(*) AS n_terms, round(sum(tf), 6) AS tf,
       round(sum(tf * idf_classic), 6) AS tfidf_classic, round(max(tf * idf_classic), 9) AS top_classic,
       round(sum(tf * idf_smooth), 6) AS tfidf_smooth, round(max(tf * idf_smooth), 9) AS top_smooth
FROM w GROUP BY doc_id""",
}
SQL["index_load_or_build"] = f"""
WITH {POSTINGS},
main AS (SELECT n AS total_docs, (SELECT count(*) FROM dfs) AS total_unique_terms FROM corpus),
other AS (
  SELECT (SELECT count(*) FROM benchmark) AS total_docs, count(DISTINCT term) AS total_unique_terms
  FROM (SELECT unnest({TEXT_TOKENS}) AS term FROM benchmark))
SELECT unnest(['built', 'loaded']) AS step, * FROM main UNION ALL SELECT unnest(['rebuilt', 'newest']), * FROM other"""
