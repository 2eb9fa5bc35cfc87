"""Incremental page intake that lets each URL through once.

``first_seen`` keeps some copy of a URL, in the stream's own state. ``start_first_copies`` keeps the first one by an order
of the pages, against the table of what has been taken in.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.joins import SALTS, fits_broadcast
from ..plans.storage import read_if_there, written

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BATCH = "intake_batch"
PAGE_SCHEMA = "page_id bigint, url string, html string"


def read_page_stream(spark: SparkSession, folder: str, schema: str = PAGE_SCHEMA) -> DataFrame:
    """New parquet files of pages below ``folder`` as a stream."""
    return spark.readStream.schema(schema).parquet(folder)


def first_seen(pages: DataFrame, spread_by: str = "page_id") -> DataFrame:
    """One row per URL over the whole stream.

    A URL that much of the stream repeats is first reduced to one row per salt, so its copies are dropped by many
    tasks; the second step sees at most ``SALTS`` of them. The state holds every URL for good, like a visited
    set: with ``first_seen_within`` it shrinks, at the price of forgetting.
    """
    salted = pages.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    return salted.dropDuplicates(["url", "_salt"]).drop("_salt").dropDuplicates(["url"])


def first_seen_within(pages: DataFrame, event_time: str, delay: str, spread_by: str = "page_id") -> DataFrame:
    """One row per URL among rows up to ``delay`` apart; a URL older than that may pass again."""
    salted = pages.withWatermark(event_time, delay).withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)))
    return salted.dropDuplicatesWithinWatermark(["url", "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(["url"])


def _chosen_store(conf) -> str:
    chosen = conf.get(STATE_STORE)
    return ROCKSDB if chosen.endswith("HDFSBackedStateStoreProvider") else chosen


def start_intake(pages: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all pages present now and append them to the page table at ``path``; restart to go on.

    The seen URLs are kept in RocksDB, on disk rather than in the executors' heap, unless the session says otherwise.
    """
    conf = pages.sparkSession.conf
    conf.set(STATE_STORE, _chosen_store(conf))
    return (
        pages.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_first_copies(pages: DataFrame, path: str, checkpoint: str, order: Sequence[str] = ("page_id",)) -> StreamingQuery:
    """Take in all pages present now: of each URL that is not in the table at ``path`` yet, the first page by ``order``.

    A batch is cut to one page per URL before anything is compared: the least position of each URL is found on the
    narrow columns, with minima taken inside the tasks, so copies of a hot URL do not meet in one task. The batch is a
    folder of its own that a repeated batch overwrites, so a restart neither loses nor doubles pages. ``order`` must tell
    the pages of a URL apart.
    """

    def take(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        # read for the positions and for the pages
        batch = written(batch, "intake-batch")
        position = F.struct(*order)
        least = batch.groupBy("url").agg(F.min(position).alias("_first"))
        seen = read_if_there(spark, path, f"url string, {BATCH} bigint")
        if seen is not None:
            least = least.join(seen.where(F.col(BATCH) < number).select("url"), "url", "left_anti")
        least = written(least.select(F.col("url").alias("_url"), "_first"), "intake-first")
        chosen = F.broadcast(least) if fits_broadcast(least) else least
        first = batch.join(chosen, (F.col("url") == F.col("_url")) & (position == F.col("_first")))
        first.drop("_url", "_first").write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")

    return pages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_intake(spark: SparkSession, path: str) -> DataFrame:
    """The pages taken in by ``start_first_copies``, without the number of their batch."""
    return spark.read.option("basePath", path).parquet(path).drop(BATCH)
