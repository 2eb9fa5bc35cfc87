"""A corpus pipeline of five operators: language, recurring lines, near duplicates, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame; ``run`` writes it as Parquet and reads it back as the next
one's input. All stages but the last return the columns of the documents they got.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.llm import bpe, jaccard_join, langid, line_dedup, mixing
from pagequarry.plans.storage import written

# language dictionaries, sketches and the mix's order cannot be had in SQL
ORACLE_SQL = None


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a clear margin."""
    found = langid.identify(docs, langid.fit(docs))
    return found.where("accepted").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; ``n_chars`` is that of the new text."""
    kept = line_dedup.drop_recurring_lines(docs, min_words=1).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else kept


def one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard_join.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids; the decoded text is kept as a digest."""
    return bpe.round_trip(docs, vocabulary(), outputs=("ids",))


STAGES = [
    ("language ID", language_id),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", one_per_group),
    ("mixing", mix_sources),
    ("BPE", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
