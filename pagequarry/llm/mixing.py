"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

A document's expected copies are the target of its source over the source's size. Within a source, documents stand
in the order of their size; the running sum of expected copies, shifted by one offset per source, says how often each
document is taken: once for every whole number it passes. As neighbours in that order have nearly the same size, the
words taken from a source differ from its target by one document's size at most.

The order is made by one range-partitioned sort over all sources at once, so a source with a third of all rows is
spread over many tasks. Targets follow from one row per source.

Edge cases: a null text has size 0, and a source of size 0 takes nothing of it; a null source is one like any other
and comes last; documents of equal size and id are alike to the sample, so repeated rows are counted one by one;
columns named like an output are replaced; an empty table gives an empty result.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast
from ..plans.ordering import number_rows
from ..plans.storage import written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix"


def word_count(text: str) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def offset(source: str, seed: str) -> Column:
    """A source's offset in (0, 1) from a keyed digest, a multiple of 2**-17 so that adding it to a count is exact."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("-"))))
    return (F.conv(F.substring(digest, 1, 4), 16, 10).cast("double") + 0.5) / 65536


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES, share: float = 1.0
) -> DataFrame:
    """``source, source_size`` -> also ``target``: shares of all words by weight, none above ``most`` times its source.

    Weights repeat over the sources in code point order. Sources whose share exceeds their bound take the bound, and
    what is left is shared by weight among the others, until none exceeds. One aggregate per round; the rounds end
    since a source that is bound stays bound.
    """
    placed = number_rows(sizes, [F.col("source").isNull(), "source"], "_place")
    weight = F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    rows = written(placed.withColumns({"_weight": weight, "_bound": F.col("source_size") * most}), "sources")
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    budget, level = total * share, None
    while True:
        free = F.lit(True) if level is None else F.col("_weight") * F.lit(level) <= F.col("_bound")
        bound, spread = rows.agg(F.sum(F.when(~free, F.col("_bound"))), F.sum(F.when(free, F.col("_weight")))).first()
        next_level = (budget - (bound or 0)) / spread if spread else float("inf")
        if level == next_level or not spread:
            break
        level = next_level
    unbound = F.lit(level if level is not None else 0.0) * F.col("_weight")
    return rows.select("source", "source_size", F.least(unbound, F.col("_bound").cast("double")).alias("target"))


def plan_mix(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    order: Sequence[str] = ("doc_id",),
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``copies`` to every document.

    ``order`` breaks ties of size. All columns of ``docs`` travel through one sort, so choose them narrowly where the
    texts are not wanted: a column ``size`` that is already there is taken as it is when ``text`` is empty.
    """
    sized = docs.withColumn("size", word_count(text)) if text else docs
    sized = sized.drop("source_size", "target", "copies", "_source")
    keyed = sized.withColumn("_source", F.col(source))
    numbered = number_rows(keyed, [F.col("_source").isNull(), "_source", "size", *order], "_number")
    per_source = numbered.groupBy(F.col("_source").alias("source")).agg(
        F.sum("size").alias("source_size"), F.min("_number").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    per_source = written(per_source, "source-sizes")
    targets = source_targets(per_source.select("source", "source_size"), weights, most)
    first = per_source.select(F.col("source").alias("_name"), "_first")
    known = targets.join(first, F.col("source").eqNullSafe(F.col("_name"))).select(
        F.col("source").alias("_name"), "source_size", "target", "_first"
    )
    known = written(known, "source-targets")
    same = F.col("_source").eqNullSafe(F.col("_name"))
    # one row per source: sent to the documents while it fits, else the join splits skewed sources by itself
    joined = numbered.join(F.broadcast(known) if fits_broadcast(known) else known, same)
    place = F.col("_number") - F.col("_first")
    size = F.nullif(F.col("source_size").cast("double"), F.lit(0.0))

    def passed(upto: Column) -> Column:
        return F.floor(upto.cast("double") * F.col("target") / size + offset("_source", seed))

    copies = F.coalesce(passed(place + 1) - passed(place), F.lit(0)).cast("bigint")
    return joined.withColumn("copies", copies).drop("_source", "_name", "_number", "_first")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row as often as ``plan_mix`` takes it, with the columns of ``docs``."""
    planned = plan_mix(docs, **options).where(F.col("copies") > 0)
    repeated = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return planned.withColumn("_copy", repeated).select(*docs.columns)
