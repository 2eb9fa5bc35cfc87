"""Inverted index with corpus statistics, as plain tables.

``postings(term, doc_id, tf, doc_len)`` is long, not nested: a popular term is many rows, never one big value.
It carries the document length, so scoring needs no join with a table as long as the corpus. A document sits
in one row, so its terms are counted inside that row and building postings shuffles nothing.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..plans.ordering import number_rows

# The record fields that are searched. `contry` is how the records spell that column.
INDEXED_FIELDS = ("name", "full_name", "description", "contry", "type", "status")


@dataclass(frozen=True)
class SearchIndex:
    """The tables of an index; ``buckets`` is set when they are stored in bucket folders, ``tokenized`` (``doc_id, tokens``)
    when they are still to be built."""

    postings: DataFrame
    docs: DataFrame
    term_df: DataFrame
    doc_lengths: DataFrame
    corpus_stats: DataFrame
    fields: tuple[str, ...]
    buckets: int | None = None
    tokenized: DataFrame | None = None

    def total_docs(self) -> int:
        return self.corpus_stats.select("total_docs").first()[0]


def corpus_statistics(docs: DataFrame, term_df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row: corpus size (documents without tokens count too), vocabulary size, indexed fields."""
    return docs.agg(F.count(F.lit(1)).alias("total_docs")).select(
        "total_docs",
        term_df.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_unique_terms"),
        F.array(*[F.lit(f) for f in fields]).cast("array<string>").alias("indexed_fields"),
    )


def bucket_of(column: str, buckets: int) -> Column:
    """Storage bucket of a term or document number."""
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def present_fields(docs: DataFrame, fields: Sequence[str]) -> list[str]:
    return [f for f in fields if f in docs.columns]


def field_tokens(docs: DataFrame, fields: Sequence[str]) -> Column:
    """Tokens of all fields one after the other; absent fields are skipped."""
    present = present_fields(docs, fields)
    if not present:
        return F.array().cast("array<string>")
    return F.concat(*[tokens(F.col(f)) for f in present])


def explode_tokens(docs: DataFrame, fields: Sequence[str], doc_id: str = "doc_id") -> DataFrame:
    """One row per token: ``doc_id, pos, term``."""
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(field_tokens(docs, fields)).alias("pos", "term")
    )


def count_terms(tokenized: DataFrame) -> DataFrame:
    """``doc_id, tokens`` -> ``term, doc_id, tf, doc_len`` without a shuffle.

    The tokens are sorted inside the row and the starts of equal runs give the counts. A ``doc_len`` that comes with the
    tokens is kept; without it the tokens are the whole document.
    """
    length = F.col("doc_len") if "doc_len" in tokenized.columns else F.size("tokens").cast("bigint")
    runs = tokenized.select("doc_id", length.alias("doc_len"), F.sort_array("tokens").alias("_sorted")).withColumn(
        "_starts",
        F.when(
            F.size("_sorted") > 0,
            F.filter(
                F.sequence(F.lit(0), F.size("_sorted") - 1),
                lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
            ),
        ).otherwise(F.array().cast("array<int>")),
    )
    run = F.transform(
        "_starts",
        lambda start, k: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_starts", k + 1), F.size("_sorted")) - start).cast("bigint").alias("tf"),
        ),
    )
    return runs.select("doc_id", "doc_len", F.explode(run).alias("_run")).select(
        "_run.term", "doc_id", "_run.tf", "doc_len"
    )


def shard_of(term: Column, buckets: int, shards: int) -> Column:
    """Shard of a term: the buckets are dealt over the shards, so a bucket lies in one."""
    return F.pmod(bucket_of(term, buckets), F.lit(shards))


def shard_tokens(tokenized: DataFrame, buckets: int, shards: int) -> DataFrame:
    """``doc_id, tokens`` -> ``doc_id, doc_len, shard, words``: a document's tokens of a shard as one string, so that what is
    shuffled is a few rows per document and not one per posting. Tokens hold no space. At most 26 shards."""
    # a letter for the shard before each token: sorted, the tokens of a shard lie together
    marked = F.transform("tokens", lambda t: F.concat(F.char(F.lit(65) + shard_of(t, buckets, shards)), t))
    letter = lambda i: F.left(F.get("_marked", i), F.lit(1))
    begins = F.when(
        F.size("_marked") > 0,
        F.filter(F.sequence(F.lit(0), F.size("_marked") - 1), lambda i: (i == 0) | (letter(i) != letter(i - 1))),
    ).otherwise(F.array().cast("array<int>"))

    def part(start: Column, k: Column) -> Column:
        own = F.slice("_marked", start + 1, F.coalesce(F.get("_begins", k + 1), F.size("_marked")) - start)
        words = F.array_join(F.transform(own, lambda t: F.substring(t, 2, 1 << 30)), " ")
        return F.struct((F.ascii(letter(start)) - 65).alias("shard"), words.alias("words"))

    rows = tokenized.select("doc_id", F.size("tokens").cast("bigint").alias("doc_len"), F.sort_array(marked).alias("_marked"))
    parts = rows.withColumn("_begins", begins).select("doc_id", "doc_len", F.explode(F.transform("_begins", part)).alias("_part"))
    return parts.select("doc_id", "doc_len", "_part.shard", "_part.words")


def term_totals(postings: DataFrame) -> DataFrame:
    """Documents and occurrences per term; summed inside each task before the shuffle."""
    return postings.groupBy("term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("occurrences")
    )


def number_documents(records: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Give records without a key a 0-based ``doc_id`` in the given order."""
    return number_rows(records, order, "doc_id")


def build_index(
    docs: DataFrame,
    doc_id: str = "doc_id",
    fields: Sequence[str] = INDEXED_FIELDS,
    metadata: Sequence[str] | None = None,
) -> SearchIndex:
    """Index of ``docs``, evaluated lazily. ``doc_id`` must be unique; ``metadata`` defaults to all columns."""
    kept = [c for c in docs.columns if c != doc_id] if metadata is None else list(metadata)
    tokenized = docs.select(F.col(doc_id).alias("doc_id"), field_tokens(docs, fields).alias("tokens"))
    postings = count_terms(tokenized)
    documents = docs.select(F.col(doc_id).alias("doc_id"), *kept)
    term_df = term_totals(postings)
    present = tuple(present_fields(docs, fields))
    return SearchIndex(
        postings=postings,
        docs=documents,
        term_df=term_df,
        doc_lengths=tokenized.select("doc_id", F.size("tokens").cast("bigint").alias("doc_len")),
        corpus_stats=corpus_statistics(documents, term_df, present),
        fields=present,
        tokenized=tokenized,
    )
