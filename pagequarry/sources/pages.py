"""Page corpus, download log, queue and robots files."""

import os
import re
import uuid
from itertools import groupby
from operator import itemgetter

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip_space
from ..functions.url import page_rel_path
from ..operators.frontier import queue_of
from ..plans.joins import BROADCAST_BYTES, fits_broadcast
from ..plans.storage import read_if_there, written
from .file_order import in_file_order

# Columns of the download log.
LOG_SCHEMA = "url string, downloaded_at string, filesize_bytes bigint, filepath_saved string"
QUEUE_SCHEMA = "url string, seq bigint"
VERSIONS_SCHEMA = "version string, saved_at timestamp"
BITMAP_BITS = 1 << 27
PAGE_FOLDERS = 256
SPLITS_A_TASK = 16
NO_PAGE_ID = "__HIVE_DEFAULT_PARTITION__"
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_page_files(pages: DataFrame, folder: str) -> None:
    """Write ``html`` as a line of text to a file of its own for every ``page_id``, a number, below ``folder``, which must be
    new; ``page_number`` tells the page of a file. Rows of one page share a file when they lie in one task.

    In a folder that all machines have mounted the tasks open the files themselves: Hadoop starts a process to set the mode
    of each file and folder it makes there, which takes far longer than the page. Files lie in a fixed number of folders, so
    that listing them does not take a step per page. Any other store gets Spark's text files, in a folder per page.
    """
    root = mounted_path(pages.sparkSession, folder)
    rows = pages.select("page_id", "html")
    if root is None:
        rows.write.partitionBy("page_id").text(folder)
        return
    os.makedirs(root)
    name = F.concat(F.lit("page_id="), F.coalesce(F.col("page_id").cast("string"), F.lit(NO_PAGE_ID)))
    spot = F.lpad(F.lower(F.hex(F.pmod(F.xxhash64("page_id"), F.lit(PAGE_FOLDERS)))), 2, "0")
    line = F.concat(F.coalesce("html", F.lit("")), F.lit("\n")).cast("binary")
    placed = rows.sortWithinPartitions("page_id").select(F.concat(spot, F.lit("/"), name), line)

    def save(lines):
        task = TaskContext.get().partitionId()
        for name, same in groupby(lines, key=itemgetter(0)):
            path = f"{root}/{name}-part-{task:05d}.txt"
            os.makedirs(os.path.dirname(path), exist_ok=True)
            # another attempt of the task may be writing too; readers pass over names that begin with a dot
            own = f"{os.path.dirname(path)}/.{uuid.uuid4().hex}"
            with open(own, "wb") as file:
                file.writelines(line for _, line in same)
            os.replace(own, path)

    placed.foreachPartition(save)


def page_number(filepath_saved: Column | str) -> Column:
    """The ``page_id`` of a file of ``write_page_files``; null for other files and for pages without one."""
    return F.regexp_extract(filepath_saved, "(?:^|/)page_id=(-?[0-9]+)(?:-part-[^/]*|/[^/]*)$", 1).try_cast("bigint")


def mounted_path(spark: SparkSession, folder: str) -> str | None:
    """The path of a folder in the machines' own file tree; None for one in another store."""
    if folder.startswith("/"):
        # without a scheme the folder lies in the cluster's default store
        store = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        return folder.rstrip("/") if store.startswith("file:") else None
    local = re.fullmatch("file:(?://)?(/[^/].*?)/*", folder)
    return local and local[1]


def page_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filepath_saved, html, readable`` of every file below ``folder``; a file that is not UTF-8 has no ``html``, one that
    vanishes no row."""
    files = spark.read.option("recursiveFileLookup", True).option("ignoreMissingFiles", True).text(folder, wholetext=True)
    root = folder.split("://")[-1].removeprefix("file:").rstrip("/") + "/"
    # the metadata path is percent-encoded, where a plus is a plus
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    relative = F.substring(path, F.locate(root, path) + len(root), F.length(path))
    readable = F.is_valid_utf8("value")
    found = files.select(relative.alias("filepath_saved"), F.when(readable, F.col("value")).alias("html"), readable.alias("readable"))
    # a split holds few small files, as each counts with the cost of opening it; a task takes several splits one after the other
    splits, cores = files.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism
    return found.coalesce(max(splits // SPLITS_A_TASK, min(splits, 4 * cores), 1))


def read_page_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filepath_saved, html`` of every readable file below ``folder``; ``unreadable_files`` tells of the others."""
    return page_files(spark, folder).where("readable").drop("readable")


def unreadable_files(spark: SparkSession, folder: str) -> DataFrame:
    """``filepath_saved`` of the files below ``folder`` that are not UTF-8 text."""
    return page_files(spark, folder).where(~F.col("readable")).select("filepath_saved")


def page_inventory(pages: DataFrame, downloaded_at: str | Column) -> DataFrame:
    """Log row of each page: ``url``, ISO time, size in UTF-8 bytes, file path."""
    at = F.col(downloaded_at) if isinstance(downloaded_at, str) else downloaded_at
    others = [c for c in pages.columns if c not in ("url", "html")]
    return pages.select(
        *others,
        "url",
        F.date_format(at, ISO_FORMAT).alias("downloaded_at"),
        F.octet_length("html").cast("bigint").alias("filesize_bytes"),
        page_rel_path("url").alias("filepath_saved"),
    )


def append_log(log: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Append rows to the log table, in the order of the given columns if there are any."""
    placed = log if order is None else log.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.select("url", "downloaded_at", "filesize_bytes", "filepath_saved").write.mode("append").options(**CSV).csv(path)


def read_log(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """The log's rows; ``numbered`` adds ``seq``, their place in the order of appending."""
    log = spark.read.schema(LOG_SCHEMA).options(**CSV).option("multiLine", True).csv(path)
    return in_file_order(log) if numbered else log


def latest_pages(pages: DataFrame, order: list[str], limit: int = BROADCAST_BYTES) -> DataFrame:
    """One row per ``filepath_saved``: the last one by ``order``, which must make rows of a path distinct.

    Winners and losers are found on the narrow columns, with map-side maxima. While the losers are measured to fit
    ``limit`` they are sent to the pages, and no page moves. Beyond that a bitmap of their hashes, of a fixed size, tells
    which pages may be losers; only those are joined with them, the others pass where they lie.
    """
    narrow = pages.select("filepath_saved", *order)
    winner = narrow.groupBy("filepath_saved").agg(F.max(F.struct(*order)).alias("_last"), F.count(F.lit(1)).alias("_n"))
    several = winner.where(F.col("_n") > 1).select("filepath_saved", "_last")
    losers = narrow.join(several, "filepath_saved").where(F.struct(*order) < F.col("_last"))
    losers = written(losers.select("filepath_saved", *order), "overwritten")
    keys = ["filepath_saved", *order]
    if fits_broadcast(losers, limit):
        return pages.join(F.broadcast(losers), keys, "left_anti").select(*pages.columns)
    placed = pages.withColumn("_spot", _spot(keys))
    bitmaps = written(hashed_bitmaps(losers.select(_spot(keys).alias("_spot"))), "bitmaps")
    marked = placed.withColumn("_bucket", F.bitmap_bucket_number("_spot")).join(F.broadcast(bitmaps), "_bucket", "left")
    suspected = F.coalesce(bit_at("_bits", F.bitmap_bit_position("_spot")), F.lit(False))
    own = [F.col(c) for c in pages.columns]
    passed = marked.where(~suspected).select(*own)
    return passed.unionByName(marked.where(suspected).select(*own).join(losers, keys, "left_anti").select(*pages.columns))


def _spot(keys: list[str]) -> Column:
    """A row's place among the bits of all bitmaps, from 1."""
    return F.pmod(F.xxhash64(*keys), F.lit(BITMAP_BITS)) + 1


def hashed_bitmaps(spots: DataFrame) -> DataFrame:
    """``_bucket, _bits``: bitmaps of the spots that occur. There are BITMAP_BITS bits in all, so the table has a fixed
    greatest size (16 MB) however many spots there are."""
    placed = spots.select(F.bitmap_bucket_number("_spot").alias("_bucket"), F.bitmap_bit_position("_spot").alias("_bit"))
    return placed.groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))


def bit_at(bits: str, position: Column) -> Column:
    """Whether a bit of a bitmap is set; null without a bitmap."""
    byte = F.conv(F.hex(F.substring(F.col(bits), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.get(F.array(*[byte.bitwiseAND(1 << b) != 0 for b in range(8)]), (position % 8).cast("int"))


def path_collisions(pages: DataFrame, order: list[str]) -> DataFrame:
    """File paths that several pages share: how many, and the ``order`` values of the first and the last."""
    key = F.struct(*order)
    return (
        pages.groupBy("filepath_saved")
        .agg(F.count(F.lit(1)).alias("n_pages"), F.min(key).alias("first_page"), F.max(key).alias("last_page"))
        .where(F.col("n_pages") > 1)
    )


def save_pages(pages: DataFrame, path: str, order: list[str]) -> None:
    """Store the page table with one page per file path."""
    latest_pages(pages, order).write.mode("overwrite").parquet(path)


def write_queue(frontier: DataFrame, path: str) -> None:
    """Rewrite the queue as text, one URL per line; file names and lines follow ``seq``."""
    ordered = frontier.repartitionByRange("seq").sortWithinPartitions("seq")
    ordered.select(F.col("url").alias("value")).write.mode("overwrite").text(path)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """``url, seq`` in the order of writing; lines are trimmed, blanks and repeats dropped."""
    lines = in_file_order(spark.read.text(path), "line")
    cleaned = lines.select(strip_space(F.col("value")).alias("url"), "line")
    return queue_of(cleaned.where(F.col("url") != ""), ["line"])


def save_queue(frontier: DataFrame, path: str) -> None:
    """Store the queue with its numbers as a new version below ``path``. It takes the place of the former one when its row
    of the table of versions is appended, so a reader, or a crawl that is broken off, never sees half a queue."""
    spark = frontier.sparkSession
    version = uuid.uuid4().hex
    frontier.select("url", "seq").write.parquet(f"{path}/queues/{version}")
    row = spark.createDataFrame([(version,)], "version string").withColumn("saved_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{path}/versions")


def load_queue(spark: SparkSession, path: str) -> DataFrame:
    """``url, seq`` of the newest finished version; an empty queue where none was saved."""
    versions = read_if_there(spark, f"{path}/versions", VERSIONS_SCHEMA)
    newest = versions and versions.orderBy(F.desc("saved_at"), "version").first()
    if newest is None:
        return spark.createDataFrame([], QUEUE_SCHEMA)
    return spark.read.schema(QUEUE_SCHEMA).parquet(f"{path}/queues/{newest.version}")


def read_robots(spark: SparkSession, path: str, host: str | Column | None = None) -> DataFrame:
    """``host, text`` of robots files; without a host their rules hold for every URL. For a folder of many hosts, ``host`` is
    a column: that of its partitions, or one made from ``_metadata``."""
    return spark.read.text(path, wholetext=True).select(
        F.lit(host).cast("string").alias("host"), F.col("value").alias("text")
    )
