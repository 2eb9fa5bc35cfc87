"""The order in which rows lie in files that Spark has written or appended to.

Every write has its own identifier in its file names, and its files are numbered. Writes are ordered by the time of their
first file, files of a write by number, lines by their place. Names alone would mix the files of several appends, and
put the 100,000th file before the 99,999th.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast
from ..plans.ordering import number_rows
from ..plans.storage import written

# How Spark names the files of a write.
FILE_NUMBER = r"part-([0-9]+)-[^/]*$"
WRITE = r"part-[0-9]+-([0-9a-fA-F-]{36})[^/]*$"
KEYS = ("_time", "_write", "_number", "_file", "_block", "_line")


def in_file_order(rows: DataFrame, out: str = "seq") -> DataFrame:
    """Number the rows of a frame read from files (not changed since but by narrow steps that keep ``_metadata``) from 0, in
    the order they were written. Files with other names come in the order of time and name."""
    file = F.col("_metadata.file_path")
    placed = rows.select(
        "*",
        file.alias("_file"),
        F.coalesce(F.nullif(F.regexp_extract(file, WRITE, 1), F.lit("")), file).alias("_write"),
        F.col("_metadata.file_modification_time").alias("_changed"),
        F.regexp_extract(file, FILE_NUMBER, 1).try_cast("bigint").alias("_number"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    placed = written(placed, "placed-lines")
    # one row per write
    writes = written(placed.groupBy("_write").agg(F.min("_changed").alias("_time")), "writes")
    timed = placed.join(F.broadcast(writes) if fits_broadcast(writes) else writes, "_write")
    return number_rows(timed, KEYS, out).drop(*KEYS, "_changed")
