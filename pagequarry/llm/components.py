"""Connected components of a link table by alternating stars, each round a pair of aggregates and joins.

Rounds are written to the shared folder, so the plan stays short and a lost executor repeats one round at most. The
least member of each neighbourhood is found with map-side minima, and the joins back split skewed keys, so a node with
very many links is no single task's work. The number of rounds grows with the logarithm of a component's size.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import written


def _state(edges: DataFrame) -> tuple:
    """Number of links and an order-free digest of them."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())


def _hang(edges: DataFrame, above: bool) -> DataFrame:
    """Link neighbours to the least node around: for each ``u``, its larger neighbours (``above``), or its smaller
    ones together with itself. ``edges`` has u > v."""
    if above:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
        hung = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("_m"))
        others = edges.join(least, "u").where(F.col("v") != F.col("_m"))
        hung = others.select(F.col("v").alias("u"), F.col("_m").alias("v")).unionByName(
            least.select("u", F.col("_m").alias("v"))
        )
    return hung.where(F.col("u") != F.col("v")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with a link: component is the least node that links lead to.

    Null ends and links of a node with itself count for nothing; repeated links are one. Of an empty table the result
    is empty.
    """
    low, high = F.least(a, b), F.greatest(a, b)
    ends = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(ends.select(high.alias("u"), low.alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = written(_hang(_hang(edges, True), False), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
