"""Global order without a single task: numbering, ranks within groups, and the n-th row."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .joins import fits_broadcast
from .storage import written

ROW_BITS = 33
# Ranges a round of counting looks at; a round is one aggregate, and each narrows the keys by this factor.
RANGES = 4_096


def place_rows(df: DataFrame, keys: Sequence[Column | str], out: str) -> DataFrame:
    """Write ``df`` range-partitioned and sorted by ``keys`` and add ``out``: partition and position in one number, in the
    order of the keys. Written, both stay as they are."""
    sorted_rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return written(sorted_rows.withColumn(out, F.monotonically_increasing_id()), "numbered")


def part_of(at: str) -> Column:
    """Partition of a place."""
    return F.shiftright(at, ROW_BITS)


def place_in_part(at: str) -> Column:
    return F.col(at).bitwiseAND((1 << ROW_BITS) - 1)


def number_rows(df: DataFrame, keys: Sequence[Column | str], out: str, start: int = 0) -> DataFrame:
    """Add ``out``: consecutive numbers in the order of ``keys`` (which should make rows distinct).

    Rows are range-partitioned and sorted inside each partition; an offset per partition (one row per task) turns
    places into global numbers.
    """
    placed = place_rows(df, keys, "_at")
    sizes = placed.groupBy(part_of("_at").alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    # one row per partition of the sort, so both the window and the broadcast are bounded by the task count
    before = F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_rows")
    offsets = sizes.select("_part", before.alias("_before"))
    return (
        placed.withColumn("_part", part_of("_at"))
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + place_in_part("_at") + start)
        .drop("_at", "_part", "_before")
    )


def rank_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], out: str) -> DataFrame:
    """Add ``out``: 1, 2, ... within each group of ``by`` (without nulls) in the given order.

    A group's rows are dealt over as many tasks as the sort has ranges, so no group is one task's work. What is counted
    per partition and group has at most as many rows as there are partitions and groups together.
    """
    placed = place_rows(df, [*by, *order], "_at").withColumn("_part", part_of("_at"))
    counted = placed.groupBy(*by, "_part").agg(F.min(place_in_part("_at")).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    so_far = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = F.sum("_rows").over(so_far) - F.col("_rows") - F.col("_first") + 1
    offsets = written(counted.select(*by, "_part", before.alias("_before")), "offsets")
    # a part of a group is no more than one task's rows
    joined = placed.join(F.broadcast(offsets) if fits_broadcast(offsets) else offsets, [*by, "_part"])
    return joined.withColumn(out, F.col("_before") + place_in_part("_at")).drop("_at", "_part", "_before")


def nth_smallest(df: DataFrame, key: str, n: int) -> int | None:
    """The ``n``-th value (from 1) of an integer column in ascending order, repeats counted; None when there are fewer
    values that are not null.

    Found by counting over key ranges: each round divides the range that holds the value and counts inside it, with
    sums taken in every task. Nothing is sorted and no rows are brought together, however large ``n`` is. Each round reads
    ``df``, which should therefore be a stored table.
    """
    low, high, total = df.agg(F.min(key), F.max(key), F.count(key)).first()
    if n < 1 or n > total:
        return None
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        inside = df.where(F.col(key).between(low, high))
        # distances from the low end are split as whole numbers
        ranges = inside.groupBy(F.expr(f"(CAST({_quoted(key)} AS DECIMAL(38, 0)) - {low}) DIV {width}").alias("range"))
        for row in sorted(ranges.agg(F.count(F.lit(1)).alias("rows")).collect()):
            if n <= row["rows"]:
                low = low + row["range"] * width
                high = min(high, low + width - 1)
                break
            n -= row["rows"]
    return low


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The rows up to the ``n``-th smallest value of a whole-number column without repeats."""
    last = nth_smallest(df, key, n)
    return df if last is None and n > 0 else df.where(F.col(key) <= F.lit(last)) if n > 0 else df.where(F.lit(False))
