"""Ranked TF-IDF search over an index, for one query or a table of them.

A search is one Spark job however many queries it answers. Its shape:

* query terms are expanded with their positions; identical queries are scored once;
* the term list is counted. A short one becomes literal filters, which prune bucket folders and row groups; a longer
  one that can be broadcast prunes the folders when the plan runs;
* hits (postings of query terms) are placed by document *before* they meet the query terms. The following
  aggregation per query and document keeps that placement, so only hits are shuffled, never hits times queries,
  and a hot term is spread by document instead of landing in one task;
* a small top k is cut inside each task before its rows are shuffled by query. A larger one is cut by counting scores
  in ranges, and what is left is ranked by a sort that deals each query's matches over many tasks. So is a whole
  result list (``top_k=None``): the number of matches never decides how much one task sorts.
"""

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..functions.weights import METHODS, doc_share, idf_classic, idf_smooth, term_frequency
from ..plans.joins import BROADCAST_BYTES, SALTS, fits_broadcast, frequent_first_join, hot_split_join, salted_join
from ..plans.ordering import rank_rows
from ..plans.storage import written
from .index import SearchIndex, bucket_of

DEFAULT_TOP_K = 10
# Up to this many distinct terms the list is written into the plan as a filter.
LITERAL_TERMS = 1_000
# Up to this many rows per query and task Spark cuts inside the tasks, if no query's last task gets more than LAST_TASK_ROWS.
GROUP_LIMIT = 1_000
LAST_TASK_ROWS = 1_000_000
# Ranges of scores counted per query before a large top k is ranked.
SCORE_RANGES = 4_096
# Bytes of a query's number and digest, with room for the row around them.
KEY_BYTES = 160


def query_table(spark, queries) -> DataFrame:
    """``query_id, text`` from one string, a list of strings or a table of that shape."""
    if isinstance(queries, DataFrame):
        return queries.select(F.col("query_id").cast("bigint"), "text")
    texts = [queries] if isinstance(queries, str) else list(queries)
    return spark.createDataFrame(list(enumerate(texts)), "query_id bigint, text string")


class Wanted(NamedTuple):
    """Expanded queries: ``query_id, query_key`` of all of them; ``query_key, pos, term`` of the distinct ones; whether
    they are a few strings of the caller; whether both tables are small enough to be broadcast; the terms with their
    bucket folders, when few enough to be written out."""

    queries: DataFrame
    terms: DataFrame
    given: bool
    small: bool
    literals: dict[str, int] | None


class Searcher:
    """Answers queries from an index; refuses an index without documents."""

    def __init__(self, index: SearchIndex):
        self.index = index
        self.spark = index.postings.sparkSession
        self.total_docs = index.total_docs()
        if self.total_docs == 0:
            raise ValueError("the index holds no documents")

    @property
    def _n(self) -> Column:
        return F.lit(self.total_docs)

    # -- query side ---------------------------------------------------------------------------------------

    def _expand(self, queries) -> Wanted:
        """A repeated word has a row per place; queries with the same tokens share a key (the least of their
        numbers), so copies are scored once."""
        tokenized = query_table(self.spark, queries).select("query_id", tokens(F.col("text")).alias("tokens"))
        if _given_small(queries):
            # a few strings of the caller: not worth a shuffle to find copies among them
            own = tokenized.select(F.col("query_id").alias("query_key"), F.posexplode("tokens").alias("pos", "term"))
            same = tokenized.select("query_id", F.col("query_id").alias("query_key"))
            return Wanted(same, own, True, True, self._literal_terms(own))
        # tokens hold no space, so the joined text stands for the list
        keyed = tokenized.withColumn("_digest", F.sha2(F.array_join("tokens", " "), 256))
        distinct = keyed.groupBy("_digest").agg(F.min("query_id").alias("query_key"), F.first("tokens").alias("tokens"))
        terms = distinct.select("query_key", F.posexplode("tokens").alias("pos", "term"))
        # measured, listed and joined below, so it is settled once
        terms = written(terms, "query-terms")
        small = fits_broadcast(terms) and keyed.count() * KEY_BYTES <= BROADCAST_BYTES
        keys = distinct.select("_digest", "query_key")
        wanted = keyed.select("query_id", "_digest")
        if small:
            wanted = wanted.join(F.broadcast(keys), "_digest")
        else:
            wanted = salted_join(wanted, keys, ["_digest"], "inner", ["query_id"])
        literals = self._literal_terms(terms.select("term").distinct())
        return Wanted(wanted.select("query_id", "query_key"), terms, False, small, literals)

    def _literal_terms(self, terms: DataFrame) -> dict[str, int] | None:
        """The given terms and their bucket folders when there are at most LITERAL_TERMS of them, else None."""
        folder = bucket_of("term", self.index.buckets or 1)
        found = terms.select("term", folder.alias("folder")).limit(LITERAL_TERMS + 1).collect()
        return {r.term: r.folder for r in found} if len(found) <= LITERAL_TERMS else None

    def _of_terms(self, table: DataFrame, literals: dict[str, int] | None, terms: DataFrame | None = None) -> DataFrame:
        """Rows of a term-keyed index table that can concern the query terms: by literals, or by a list of ``terms`` small
        enough to be broadcast. Stored by bucket, only the folders of these terms are read either way."""
        if literals is None:
            if terms is None:
                return table
            wanted, on = terms.select("term").where(F.length("term") > 0).distinct(), ["term"]
            if self.index.buckets:
                wanted, on = wanted.withColumn("_bucket", bucket_of("term", self.index.buckets)), ["_bucket", "term"]
            return table.join(F.broadcast(wanted), on, "left_semi")
        kept = table.where(F.col("term").isin(list(literals)))
        if self.index.buckets:
            kept = kept.where(F.col("_bucket").isin(sorted(set(literals.values()))))
        return kept

    # -- scoring ------------------------------------------------------------------------------------------

    def _parts(self, wanted: Wanted) -> DataFrame:
        """One row per query, document and matching query word: ``pos``, ``tf`` and both IDFs."""
        terms, literals = wanted.terms, wanted.literals
        listed = terms if wanted.small else None
        frequencies = self._of_terms(self.index.term_df, literals, listed).select("term", "df")
        # before the shuffle, drop what no query asks for
        hits = self._of_terms(self.index.postings, literals, listed).select(
            "term", "doc_id", term_frequency("tf", "doc_len").alias("tf")
        )
        if wanted.small:
            # unique terms on the other side, so the result is no longer than the measured term table
            weighed = self._with_idf(frequencies.join(F.broadcast(terms), "term"))
            return self._by_document(hits, wanted).join(F.broadcast(weighed), "term")
        weighed = self._with_idf(salted_join(terms, frequencies, ["term"], "inner", ["query_key"]))
        return salted_join(hits, weighed, ["term"], "inner", ["doc_id"])

    def _by_document(self, hits: DataFrame, wanted: Wanted) -> DataFrame:
        if wanted.given:
            return hits.repartition("doc_id")
        # a table of queries multiplies the hits, so their tasks are not merged for being small before that
        return hits.repartition(_shuffle_partitions(self.spark), "doc_id")

    def _with_idf(self, frequencies: DataFrame) -> DataFrame:
        return frequencies.select(
            "query_key",
            "pos",
            "term",
            idf_classic(self._n, "df").alias("idf_classic"),
            idf_smooth(self._n, "df").alias("idf_smooth"),
        )

    def _score(self, wanted: Wanted, methods: Sequence[str]) -> DataFrame:
        """``query_key, doc_id, first_pos, method, score`` for every matching document.

        A running sum adds the weights in the order of the query words, so equal inputs give equal doubles however
        the rows arrive. It is a sort that can spill, and no list of a document's matches is ever built.
        """
        so_far = W.partitionBy("query_key", "doc_id").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
        weights = {f"w_{m}": F.col("tf") * F.col(_idf_column(m)) for m in methods}
        sums = {w: F.sum(w).over(so_far) for w in weights}
        per_doc = (
            self._parts(wanted)
            .select("query_key", "doc_id", "pos", *[w.alias(name) for name, w in weights.items()])
            .withColumns(sums)
            .groupBy("query_key", "doc_id")
            # weights are never negative, so the last running sum is the greatest
            .agg(F.min("pos").alias("first_pos"), *[F.max(w).alias(w) for w in weights])
        )
        scored = F.array(*[F.struct(F.lit(m).alias("method"), F.col(f"w_{m}").alias("score")) for m in methods])
        return per_doc.select("query_key", "doc_id", "first_pos", F.inline(scored))

    def search(
        self, queries, method: str = "classic", top_k: int | None = DEFAULT_TOP_K, matches: bool = False
    ) -> DataFrame:
        """The best ``top_k`` documents of each query, all with None: ``query_id, method, rank, doc_id, score``, and with
        ``matches`` the number of documents that match the query.

        Any query word may match. Equal scores keep the order of the first matching query word, then of the
        document number. Unknown words add nothing; an empty query has no rows.
        """
        return self._ranked(queries, [method], top_k, matches)

    def compare(self, queries, top_k: int | None = DEFAULT_TOP_K, matches: bool = False) -> DataFrame:
        """Both IDF methods side by side, scored in one pass."""
        return self._ranked(queries, METHODS, top_k, matches)

    def _ranked(self, queries, methods: Sequence[str], top_k: int | None, matches: bool) -> DataFrame:
        if top_k is not None and top_k < 0:
            raise ValueError("top_k must not be negative")
        wanted = self._expand(queries)
        scored = self._score(wanted, methods)
        few = top_k is not None and top_k <= GROUP_LIMIT and top_k * _shuffle_partitions(self.spark) <= LAST_TASK_ROWS
        if matches or not few:
            # read by the cut, the sort and the count
            scored = written(scored, "scores")
        best = self._few(scored, top_k) if few else self._many(scored, top_k)
        columns = ["query_id", "method", F.col("rank").cast("bigint").alias("rank"), "doc_id", "score"]
        if matches:
            # every method scores the same documents; one row per query on the other side
            counts = scored.where(F.col("method") == methods[0]).groupBy("query_key").agg(F.count(F.lit(1)).alias("matches"))
            best = self._with_queries(best, counts, wanted.small)
            columns.append("matches")
        if few and not wanted.small:
            return salted_join(wanted.queries, best, ["query_key"], "inner", ["query_id"]).select(*columns)
        return self._with_queries(best, wanted.queries, wanted.small).select(*columns)

    def _with_queries(self, best: DataFrame, per_query: DataFrame, small: bool) -> DataFrame:
        """Join ranked rows with a table of queries; a long result is spread by document."""
        if small:
            return best.join(F.broadcast(per_query), "query_key")
        return salted_join(best, per_query, ["query_key"], "inner", ["doc_id"])

    def _few(self, scored: DataFrame, top_k: int) -> DataFrame:
        """Cut inside each task, then among what the tasks have left of a query."""
        order = W.partitionBy("query_key", "method").orderBy(F.desc("score"), "first_pos", "doc_id")
        ranked = scored.withColumn("rank", F.row_number().over(order))
        return ranked.where(F.col("rank") <= top_k).drop("first_pos")

    def _many(self, scored: DataFrame, top_k: int | None) -> DataFrame:
        """Ranks of any number of rows per query; ``scored`` is a stored table."""
        group = ["query_key", "method"]
        if top_k is not None:
            scored = _score_cut(scored, group, top_k)
        ranked = rank_rows(scored, group, [F.desc("score"), "first_pos", "doc_id"], "rank").drop("first_pos")
        return ranked if top_k is None else ranked.where(F.col("rank") <= top_k)

    def match_counts(self, queries) -> DataFrame:
        """Matching documents per query before the cut; 0 for a query that matches nothing."""
        wanted = self._expand(queries)
        per_query = (
            self._parts(wanted)
            .select("query_key", "doc_id")
            .distinct()
            .groupBy("query_key")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        # both sides hold one row per query (or per distinct one), and the counts are the smaller of the two
        counted = salted_join(wanted.queries, per_query, ["query_key"], "left", ["query_id"], 1 if wanted.small else SALTS)
        return counted.select("query_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("matches"))

    # -- metadata, statistics, weights --------------------------------------------------------------------

    def with_metadata(self, results: DataFrame) -> DataFrame:
        """Attach the stored metadata to an already cut result.

        The result is settled first. A short one turns into literal document filters, which prune the metadata
        folders and row groups; a long one is broadcast while it fits, and beyond that hot documents are split.
        """
        settled = written(results, "results")
        # metadata named like a result column keeps its values under a name of its own
        clashing = {c: f"doc_{c}" for c in settled.columns if c in self.index.docs.columns and c != "doc_id"}
        stored = self.index.docs.withColumnsRenamed(clashing)
        docs = stored.drop("_bucket")
        folder = bucket_of("doc_id", self.index.buckets or 1)
        ids = settled.select("doc_id", folder.alias("folder")).distinct().limit(LITERAL_TERMS + 1).collect()
        if len(ids) <= LITERAL_TERMS:
            docs = stored.where(F.col("doc_id").isin([r.doc_id for r in ids]))
            if self.index.buckets:
                docs = docs.where(F.col("_bucket").isin(sorted({r.folder for r in ids}))).drop("_bucket")
        if fits_broadcast(settled):
            if len(ids) > LITERAL_TERMS and self.index.buckets:
                # the folders of the documents that are asked for are found when the plan runs
                placed = settled.where(F.col("rank") > 0).withColumn("_bucket", folder)
                return stored.join(F.broadcast(placed), ["_bucket", "doc_id"]).drop("_bucket")
            return docs.join(F.broadcast(settled), "doc_id")
        return hot_split_join(settled, docs, "doc_id", "inner", "query_id")

    def display(self, results: DataFrame, name: str = "name", url: str = "url") -> DataFrame:
        """Results as shown to a reader: rank, name and URL (``N/A`` when absent), 4-decimal score, and country
        and type only when they are not empty."""
        shown = self.with_metadata(results)

        def column(c: str) -> Column:
            return F.col(c) if c in shown.columns else F.lit(None).cast("string")

        return shown.select(
            "query_id",
            "rank",
            F.coalesce(column(name), F.lit("N/A")).alias("name"),
            F.format_string("%.4f", "score").alias("score"),
            F.coalesce(column(url), F.lit("N/A")).alias("url"),
            F.nullif(column("contry"), F.lit("")).alias("country"),
            F.nullif(column("type"), F.lit("")).alias("type"),
        )

    def term_statistics(self, inputs) -> DataFrame:
        """Statistics of the first token of each input; ``status`` is found, not_found or invalid."""
        requested = query_table(self.spark, inputs).select(
            "query_id", F.col("text").alias("input"), F.get(tokens(F.col("text")), F.lit(0)).alias("term")
        )
        terms = requested.select("term").where(F.col("term").isNotNull()).distinct()
        literals = self._literal_terms(terms)
        listed = None
        if literals is None:
            terms = written(terms, "terms")
            listed = terms if fits_broadcast(terms) else None
        known = self._of_terms(self.index.term_df, literals, listed).select("term", "df", "occurrences")
        if literals is not None or listed is not None:
            # at most one row per term asked for
            joined = requested.join(F.broadcast(known), "term", "left")
        else:
            joined = salted_join(requested, known, ["term"], "left", ["query_id"])
        found = F.col("df").isNotNull()
        return joined.select(
            "query_id",
            "input",
            "term",
            F.when(F.col("term").isNull(), "invalid").when(found, "found").otherwise("not_found").alias("status"),
            F.col("df").alias("document_frequency"),
            F.col("occurrences").alias("total_occurrences"),
            F.when(found, idf_classic(self._n, "df")).alias("idf_classic"),
            F.when(found, idf_smooth(self._n, "df")).alias("idf_smooth"),
            doc_share(self._n, "df").alias("percentage_of_docs"),
        )

    def idf_table(self, inputs) -> DataFrame:
        """Both IDFs of each requested term (as given, not tokenised); unseen terms get theirs too."""
        requested = query_table(self.spark, inputs).select(F.col("text").alias("term")).distinct()
        literals = self._literal_terms(requested)
        known = self._of_terms(self.index.term_df, literals).select("term", "df")
        joined = requested.join(F.broadcast(known) if literals is not None else known, "term", "left")
        return self._idf_columns(joined)

    def vocabulary_idf(self) -> DataFrame:
        """Both IDFs of every term in the index."""
        return self._idf_columns(self.index.term_df.select("term", "df"))

    def _idf_columns(self, frequencies: DataFrame) -> DataFrame:
        return frequencies.select(
            "term",
            F.coalesce("df", F.lit(0)).cast("bigint").alias("df"),
            idf_classic(self._n, "df").alias("idf_classic"),
            idf_smooth(self._n, "df").alias("idf_smooth"),
        )

    def weights(self, pairs: DataFrame | None = None) -> DataFrame:
        """TF and both TF-IDF weights of every posting, or of the given ``term, doc_id`` pairs (0 where the
        document lacks the term or is unknown)."""
        postings = self.index.postings.select("term", "doc_id", "tf", "doc_len")
        if pairs is not None:
            # read twice below
            postings = written(pairs.select("term", "doc_id").join(postings, ["term", "doc_id"], "left"), "pairs")
        return self._with_frequency(postings).select(
            "term",
            "doc_id",
            term_frequency("tf", "doc_len").alias("tf"),
            (term_frequency("tf", "doc_len") * idf_classic(self._n, "df")).alias("tfidf_classic"),
            (term_frequency("tf", "doc_len") * idf_smooth(self._n, "df")).alias("tfidf_smooth"),
        )

    def weights_by(self, method: str, pairs: DataFrame | None = None) -> DataFrame:
        """TF-IDF by method name; any name but ``"smooth"`` means classic."""
        chosen = "tfidf_smooth" if method == "smooth" else "tfidf_classic"
        return self.weights(pairs).select("term", "doc_id", F.col(chosen).alias("tfidf"))

    def _with_frequency(self, postings: DataFrame) -> DataFrame:
        """Add ``df``. The frequent terms, which are most of the postings, are sent to them; only postings of the others move,
        and hot terms among these, known with their rows from the frequencies themselves, are split by document."""
        known = self.index.term_df.select("term", "df")
        if not self.index.buckets:
            known = written(known, "frequencies")
        return frequent_first_join(postings, known, "term", "df", "doc_id")


def _shuffle_partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _score_cut(scored: DataFrame, group: Sequence[str], top_k: int) -> DataFrame:
    """Rows that can be among the best ``top_k`` of their group: scores are counted in ranges of equal width up to the
    group's best, and the ranges below the one that holds the ``top_k``-th are left out. A group has at most SCORE_RANGES
    rows here, so the tables of ranges are no wider than the number of queries."""
    best = scored.groupBy(*group).agg(F.max("score").alias("_best"))
    spot = F.floor(F.coalesce(F.col("score") / F.nullif(F.col("_best"), F.lit(0.0)), F.lit(1.0)) * SCORE_RANGES)
    placed = _by_group(scored, best, group).withColumn("_range", spot)
    counted = placed.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_rows"))
    above = W.partitionBy(*group).orderBy(F.desc("_range")).rowsBetween(W.unboundedPreceding, W.currentRow)
    kept = counted.withColumn("_before", F.sum("_rows").over(above) - F.col("_rows")).where(F.col("_before") < top_k)
    lowest = kept.groupBy(*group).agg(F.min("_range").alias("_lowest"))
    cut = _by_group(placed, lowest, group).where(F.col("_range") >= F.col("_lowest"))
    return cut.drop("_best", "_range", "_lowest")


def _by_group(rows: DataFrame, per_group: DataFrame, group: Sequence[str]) -> DataFrame:
    """Join with a table of one row per group: broadcast when it fits, else spread over sub-keys."""
    settled = written(per_group, "per-query")
    if fits_broadcast(settled):
        return rows.join(F.broadcast(settled), list(group))
    return salted_join(rows, settled, list(group), "inner", ["doc_id"])


def _given_small(queries) -> bool:
    """True for query strings handed over by the caller that are short enough to need no measuring job."""
    if isinstance(queries, DataFrame):
        return False
    texts = [queries] if isinstance(queries, str) else list(queries)
    # a term row takes at most ROW_OVERHEAD bytes more than its text, and a term at least three of them
    return sum(len(t) + 1 for t in texts) * 32 <= BROADCAST_BYTES


def _idf_column(method: str) -> str:
    return "idf_smooth" if method == "smooth" else "idf_classic"
