"""Parquet form of an index.

``path/manifest`` lists finished builds; ``path/builds/<id>`` holds their tables. A build becomes visible only
when its manifest row is appended, after all tables are complete, and the newest row wins. So a failed or
running build is never read, and a rebuild leaves readers of the former one alone.

Postings and document frequencies lie in folders by term bucket, metadata by document bucket, so a search reads
the folders of its terms only. Rows are shuffled by bucket and a salt: a hot term is written by many tasks as
many files. Inside a file rows are sorted, so parquet statistics skip the other terms of the bucket. What is shuffled for postings
that are not built yet is the tokens of a document, as a string per shard of the buckets; they are counted behind the shuffle.
"""

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.index import SearchIndex, bucket_of, corpus_statistics, count_terms, shard_tokens, term_totals
from ..plans.joins import SALTS
from ..plans.storage import read_if_there

BUCKETS = 256
# Shards of the buckets, and tokens that one task should count and sort.
SHARDS = 16
TASK_TOKENS = 2_000_000
BUILD_SCHEMA = "build string, fields array<string>, buckets int, docs_schema string"
MANIFEST_SCHEMA = f"{BUILD_SCHEMA}, built_at timestamp"
# Column types of the tables; those of the metadata depend on the documents and lie in the manifest.
SCHEMAS = {
    "postings": "term string, doc_id bigint, tf bigint, doc_len bigint, _bucket int",
    "term_df": "term string, df bigint, occurrences bigint, _bucket int",
    "doc_lengths": "doc_id bigint, doc_len bigint",
    "corpus_stats": "total_docs bigint, total_unique_terms bigint, indexed_fields array<string>",
}


def _write_bucketed(df: DataFrame, key: str, spread_by: str, order: list[str], buckets: int, path: str) -> None:
    # a bucket is written by as many tasks as there are for it, and by SALTS of them at least where rows allow
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(SALTS, -(-2 * tasks // buckets))
    (
        df.withColumn("_bucket", bucket_of(key, buckets))
        .repartition("_bucket", F.pmod(F.hash(spread_by), F.lit(salts)))
        .sortWithinPartitions("_bucket", *order)
        .write.partitionBy("_bucket")
        .parquet(path)
    )


def _write_postings(index: SearchIndex, tokens: int, buckets: int, path: str) -> None:
    """Write postings from the documents' ``tokens`` tokens. The number of tasks follows from it, so that their sorts fit
    into memory however many tokens there are."""
    shards = min(buckets, SHARDS)
    tasks = max(int(index.tokenized.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-tokens // TASK_TOKENS))
    salts = max(SALTS, -(-2 * tasks // shards))
    sharded = shard_tokens(index.tokenized, buckets, shards)
    dealt = sharded.repartition(tasks, "shard", F.pmod(F.hash("doc_id"), F.lit(salts)))
    postings = count_terms(dealt.select("doc_id", "doc_len", F.split("words", " ").alias("tokens")))
    placed = postings.withColumn("_bucket", bucket_of("term", buckets)).sortWithinPartitions("_bucket", "term", "doc_id")
    placed.write.partitionBy("_bucket").parquet(path)


def save_index(index: SearchIndex, path: str, buckets: int = BUCKETS) -> SearchIndex:
    """Write all tables of ``index`` as a new build below ``path`` and return the stored index."""
    spark = index.postings.sparkSession
    build = uuid.uuid4().hex
    root = f"{path}/builds/{build}"
    docs_schema = index.docs.withColumn("_bucket", F.lit(0)).schema.json()
    index.doc_lengths.write.parquet(f"{root}/doc_lengths")
    if index.tokenized is None:
        _write_bucketed(index.postings, "term", "doc_id", ["term", "doc_id"], buckets, f"{root}/postings")
    else:
        tokens = _table(spark, root, "doc_lengths").agg(F.sum("doc_len")).first()[0] or 0
        _write_postings(index, tokens, buckets, f"{root}/postings")
    totals = term_totals(_table(spark, root, "postings"))
    _write_bucketed(totals, "term", "term", ["term"], buckets, f"{root}/term_df")
    _write_bucketed(index.docs, "doc_id", "doc_id", ["doc_id"], buckets, f"{root}/docs")
    docs = _table(spark, root, "docs", docs_schema)
    stats = corpus_statistics(docs, _table(spark, root, "term_df"), index.fields)
    stats.write.parquet(f"{root}/corpus_stats")
    row = spark.createDataFrame([(build, list(index.fields), buckets, docs_schema)], BUILD_SCHEMA)
    row.withColumn("built_at", F.current_timestamp()).write.mode("append").parquet(f"{path}/manifest")
    return _open_build(spark, path, build, index.fields, buckets, docs_schema)


def _table(spark: SparkSession, root: str, name: str, docs_schema: str = "") -> DataFrame:
    """A stored table; its types are known, so no file is opened to find them."""
    schema = SCHEMAS.get(name) or StructType.fromJson(json.loads(docs_schema))
    return spark.read.schema(schema).parquet(f"{root}/{name}")


def _open_build(spark: SparkSession, path: str, build: str, fields, buckets: int, docs_schema: str) -> SearchIndex:
    tables = {t: _table(spark, f"{path}/builds/{build}", t, docs_schema) for t in (*SCHEMAS, "docs")}
    return SearchIndex(fields=tuple(fields), buckets=buckets, **tables)


def _newest_build(spark: SparkSession, path: str):
    manifest = read_if_there(spark, f"{path}/manifest", MANIFEST_SCHEMA)
    return manifest and manifest.orderBy(F.desc("built_at"), "build").first()


def index_exists(spark: SparkSession, path: str) -> bool:
    return _newest_build(spark, path) is not None


def load_index(spark: SparkSession, path: str) -> SearchIndex:
    """The newest finished build below ``path``."""
    newest = _newest_build(spark, path)
    if newest is None:
        raise FileNotFoundError(f"no finished index at {path}")
    return _open_build(spark, path, newest.build, newest.fields, newest.buckets, newest.docs_schema)


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], SearchIndex],
    force_rebuild: bool = False,
    buckets: int = BUCKETS,
) -> SearchIndex:
    """Load the stored index, or call ``build()`` for one and save it when there is none or a rebuild is forced."""
    if force_rebuild or not index_exists(spark, path):
        return save_index(build(), path, buckets)
    return load_index(spark, path)
