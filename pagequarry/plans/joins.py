"""Joins whose strategy follows from measured sizes.

A side is broadcast only when its bytes have been counted and fit. Otherwise the rows are shuffled, and every key with
more rows than a task should take is split into as many sub-keys as its own rows need; only the lookup rows of such keys
are repeated. The limit is a number of rows, so it does not move with the size of the table: a key that holds half a
percent of a large corpus is split like one that holds a third. No single key decides how long a join takes, and every
way gives the same rows.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written

BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 64
# Sub-keys of a join whose keys are not counted.
SALTS = 32
# A key with more rows than this is split into parts of about this many.
PART_ROWS = 100_000
# Bytes of rows that are brought together by a key for one task.
PART_BYTES = 16 * 1024 * 1024
# Steps per doubling in which numbers of rows are told apart.
STEPS = 4


def _value_bytes(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.StringType):
        size = F.octet_length(col)
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(F.struct(col)))
    else:
        size = F.lit(8)
    return F.coalesce(size, F.lit(0)).cast("bigint")


def _row_bytes(df: DataFrame) -> Column:
    return sum((_value_bytes(f) for f in df.schema.fields), F.lit(ROW_OVERHEAD).cast("bigint"))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all values plus a fixed amount per row, counted in one aggregate."""
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit


def together(df: DataFrame, key: str, part_bytes: int | None = None) -> DataFrame:
    """``df`` shuffled by ``key`` into parts of about PART_BYTES as measured. What is exploded and grouped by the key behind it
    stays in its task."""
    parts = -(-measured_bytes(df) // (PART_BYTES if part_bytes is None else part_bytes))
    return df.repartition(max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), key)


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, spread_by: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Join with the left side spread over ``salts`` sub-keys and the right side repeated for each."""
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")))
    return spread.join(repeated, [*on, "_salt"], how).drop("_salt")


def key_rows(left: DataFrame, key: str) -> DataFrame:
    """``key, rows`` for every key, summed inside the tasks before the shuffle."""
    return left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def key_parts(counted: DataFrame, key: str, part_rows: int | None = None) -> DataFrame:
    """``key, _parts`` of the hot keys of a table ``key, rows``, with the number of sub-keys each needs. They are at most as
    many as ``part_rows`` goes into all rows."""
    limit = PART_ROWS if part_rows is None else part_rows
    hot = counted.where(F.col("rows") > limit)
    return written(hot.select(key, F.ceil(F.col("rows") / limit).cast("bigint").alias("_parts")), "hot-keys")


def hot_split_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str, counted: DataFrame | None = None
) -> DataFrame:
    """Shuffle join on ``key`` where the rows of hot keys are spread by ``spread_by``.

    ``counted`` (``key, rows``) says how many rows each key has on the left where a table knows that. Otherwise they are
    counted here, over a left side that is written first, so it is not worked out twice.
    """
    if counted is None:
        left = written(left, "join-side")
        counted = key_rows(left, key)
    parts = key_parts(counted, key)
    small = fits_broadcast(parts)
    # the table of hot keys is as short as the rows divided by the limit; if it is long all the same, both sides are joined to it
    known = F.broadcast(parts) if small else parts
    n = F.coalesce("_parts", F.lit(1))
    # rows without a key match nothing, so they may lie anywhere
    n = F.when(F.col(key).isNull(), F.lit(SALTS)).otherwise(n)
    spread = left.join(known, key, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), n)).drop("_parts")
    salts = F.sequence(F.lit(0).cast("bigint"), n - 1)
    repeated = right.join(known, key, "left").withColumn("_salt", F.explode(salts)).drop("_parts")
    return spread.join(repeated, [key, "_salt"], how).drop("_salt")


def least_frequent(counted: DataFrame, rows: str, limit: int | None = None) -> int | None:
    """The number of ``rows`` from which on the keys of a stored table ``counted`` can be broadcast; None when no key can be,
    0 when all can. Only a few numbers per doubling are told apart, so what is collected is short."""
    band = F.floor(F.log2(rows) * STEPS).alias("band")
    bands = counted.groupBy(band).agg(F.min(rows).alias("least"), F.sum(_row_bytes(counted)).alias("bytes"))
    left = BROADCAST_BYTES if limit is None else limit
    least = None
    for row in bands.orderBy(F.desc_nulls_last("band")).collect():
        left -= row["bytes"]
        if left < 0:
            return least
        least = row["least"]
    return 0


def frequent_first_join(left: DataFrame, right: DataFrame, key: str, rows: str, spread_by: str) -> DataFrame:
    """Left join with a table of one row per ``key``, stored, that tells how many ``rows`` the key has on the left.

    The most frequent keys, as many as can be broadcast, are sent to the left side, and their rows stay where they are. Only
    the rows of the other keys are shuffled. ``left`` is read twice unless all keys can be broadcast.
    """
    least = least_frequent(right, rows)
    if least == 0:
        return left.join(F.broadcast(right), key, "left")
    counted = right.select(key, F.col(rows).alias("rows"))
    if least is None:
        return hot_split_join(left, right, key, "left", spread_by, counted)
    frequent = F.broadcast(right.where(F.col(rows) >= least))
    others = left.join(frequent.select(key), key, "left_anti")
    rare = F.col(rows) < least
    far = hot_split_join(others, right.where(rare), key, "left", spread_by, counted.where(F.col("rows") < least))
    return left.join(frequent, key).unionByName(far)


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", spread_by: str = "", limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a long left side with a lookup table: broadcast when its bytes fit, hot keys split otherwise."""
    if fits_broadcast(right, limit):
        return left.join(F.broadcast(right), key, how)
    return hot_split_join(left, right, key, how, spread_by or left.columns[0])


def keys_among(table: DataFrame, probe: DataFrame, key: str, small: bool) -> DataFrame:
    """The distinct keys of a long ``table`` that occur in ``probe``. A ``small`` probe (measured by the caller) goes to
    the table, so only the keys found are shuffled; otherwise repeats are dropped before the shuffle by key."""
    if small:
        return table.select(key).join(F.broadcast(probe.select(key)), key, "left_semi").distinct()
    return table.select(key).distinct().join(probe.select(key), key, "left_semi")
