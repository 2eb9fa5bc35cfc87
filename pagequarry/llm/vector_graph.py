"""Near duplicates among embeddings with a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards: each goes to its ``OVERLAP`` nearest centroids. In every shard a flat
graph is built by robust pruning (a neighbour is left out when another one, already taken, is nearer to it by a factor).
The adjacency lists a vector has in its shards are united. Then every vector is searched for in each of its shards:
greedily from the shard's medoids to the nearest node, and from there and from its own node outwards as long as nodes lie
within the range and some slack. What is found is verified in double precision.

A pair is counted in the first shard both vectors share, and links leave a shard as a spanning forest, so no list of
all pairs is ever written. A shard above ``SHARD_ROWS`` vectors is worked on in pairs of blocks, so no task holds more than
two blocks, however dense a region is. Equal vectors are one node with a weight. A bounded sample of nodes is compared
with all vectors by brute force, so every run tells its own recall.

Bounds: the centroids are fitted on about ``SAMPLE`` vectors; everything else covers all rows.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components link with nothing; so do those of
different length with each other; rows repeated with their id are rows of their own that link with each other; a null
id is never the least of a component unless all are; an empty table gives an empty result.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.joins import lookup_join
from ..plans.storage import written
from .components import connected_components
from .shipping import map_batches, ship

THRESHOLD = 0.95
OVERLAP = 4
SHARD_ROWS = 1_600
MOST_CENTROIDS = 4_096
SAMPLE = 8_192
AUDITED = 64
NEAREST, AFAR, DEGREE = 48, 16, 24
ALPHA = 1.2
SLACK = 0.06
MEDOIDS = 8
QUERIES_AT_ONCE = 64


def _unit(matrix: np.ndarray) -> np.ndarray:
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled by powers of two, so that squares of very large and very small components neither overflow nor vanish;
    that leaves their direction as it is, to the last bit."""
    _, exponents = np.frexp(np.abs(matrix).max(axis=1, initial=0.0))
    return np.ldexp(matrix, -exponents[:, None])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equally long lists as a matrix of scaled rows."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return _scaled(array.flatten().to_numpy().astype(np.float64).reshape(len(array), -1))


def fit_centroids(vectors: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly picked starts."""
    x = _unit(vectors)
    centroids = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        home = np.argmax(x @ centroids.T, axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        centroids = np.where(norms[:, None] > 0, sums / np.maximum(norms, 1e-12)[:, None], centroids)
    return centroids


def nodes_of(rows: DataFrame) -> DataFrame:
    """``_key, _first, _weight, _node, _vector``: the distinct usable vectors of ``_id, _vector``."""
    sound = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where((F.size("_vector") > 0) & sound & F.exists("_vector", lambda x: x != 0))
    classes = usable.groupBy("_key").agg(
        F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_weight"), F.any_value("_vector").alias("_vector")
    )
    return classes.withColumn("_node", F.xxhash64("_key"))


def assign_shards(nodes: DataFrame, centroids: dict[int, np.ndarray]) -> DataFrame:
    """``node, weight, vector, shards``: the numbers of the nearest centroids, sorted. Lengths have shards of their own."""
    base, start = {}, 0
    for size in sorted(centroids):
        base[size], start = start, start + len(centroids[size])

    def run(batches):
        for batch in batches:
            vectors = batch.column("_vector").to_pylist()
            shards: list = [None] * len(vectors)
            by_size: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                by_size.setdefault(len(v), []).append(i)
            for size, rows in by_size.items():
                if size not in centroids:
                    for i in rows:
                        shards[i] = [-size]
                    continue
                near = _unit(_scaled(np.array([vectors[i] for i in rows], dtype=np.float64))) @ centroids[size].T
                width = min(OVERLAP, near.shape[1])
                best = np.sort(np.argpartition(-near, width - 1, axis=1)[:, :width], axis=1) + base[size]
                for i, found in zip(rows, best.tolist(), strict=True):
                    shards[i] = found
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), batch.column("_weight"), batch.column("_vector"), pa.array(shards, pa.list_(pa.int32()))],
                names=["node", "weight", "vector", "shards"],
            )

    chosen = nodes.select("_node", "_weight", "_vector")
    return map_batches(chosen, run, "node long, weight long, vector array<double>, shards array<int>")


def deal_cells(assigned: DataFrame) -> DataFrame:
    """Rows of the shards' cells: ``shard, i, j, block`` and the node. A shard of usual size is the one cell (0, 0)."""
    rows = assigned.withColumn("shard", F.explode("shards"))
    sizes = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.where(F.col("n") > SHARD_ROWS)
    blocks = F.ceil(F.col("n") / (SHARD_ROWS / 2)).cast("bigint").alias("_blocks")
    # at most one row per centroid
    dealt = rows.join(F.broadcast(large.select("shard", blocks)), "shard", "left")
    count = F.coalesce("_blocks", F.lit(1))
    block = F.pmod(F.xxhash64("node"), count)
    others = F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), lambda k: F.struct(
        F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")
    ))
    placed = dealt.withColumn("block", block).withColumn("_cell", F.explode(others))
    return placed.select("shard", "_cell.i", "_cell.j", "block", "node", "weight", "vector", "shards")


def build_graph(x: np.ndarray) -> np.ndarray:
    """Robust-pruned neighbours among the rows of ``x`` (unit vectors): candidates are the nearest ones and some others
    that keep the graph connected."""
    n = len(x)
    found = np.empty((n, DEGREE), dtype=np.int64)
    width = min(NEAREST + 1, n)
    afar = np.linspace(0, n - 1, min(AFAR, n)).astype(np.int64)
    for start in range(0, n, 256):
        sims = x[start : start + 256] @ x.T
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        wanted = np.concatenate([near, np.broadcast_to(afar, (len(sims), len(afar)))], axis=1)
        close = np.take_along_axis(sims, wanted, 1)
        found[start : start + 256] = prune_robustly(x, start, wanted, close)
    return found


def prune_robustly(x: np.ndarray, start: int, candidates: np.ndarray, sims: np.ndarray) -> np.ndarray:
    """Neighbours of the nodes from row ``start`` on: of a node's candidates, nearest first, one after another is taken,
    and with it go all that lie ALPHA times nearer to it than to the node. -1 fills up to DEGREE."""
    own = np.arange(start, start + len(candidates))
    order = np.argsort(-sims, axis=1, kind="stable")
    candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
    alive = candidates != own[:, None]
    far, rows = 2 - 2 * sims, np.arange(len(own))
    around = x[candidates]
    out = np.full((len(own), DEGREE), -1, dtype=np.int64)
    for place in range(DEGREE):
        first = np.argmax(alive, axis=1)
        has = alive[rows, first]
        if not has.any():
            break
        chosen = candidates[rows, first]
        out[has, place] = chosen[has]
        between = 2 - 2 * np.matmul(around, x[chosen][:, :, None])[:, :, 0]
        alive &= ALPHA * ALPHA * between > far
        alive[rows, first] = False
    return out


def medoids(x: np.ndarray) -> np.ndarray:
    """The row nearest to the mean, and others far from those taken before."""
    taken = [int(np.argmax(x @ x.mean(axis=0)))]
    nearest = x @ x[taken[0]]
    for _ in range(min(MEDOIDS, len(x)) - 1):
        taken.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[taken[-1]])
    return np.array(taken)


def range_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, at_least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query row, node row) of similarity ``at_least`` that a search over the graph meets."""
    starts = medoids(x)
    seen = np.zeros((len(queries), len(x)), dtype=bool)
    q = x[queries]
    each = np.arange(len(queries))
    sims = q @ x[starts].T
    at, best = starts[np.argmax(sims, axis=1)], sims.max(axis=1)
    moving = each
    while len(moving):  # greedy: to the best neighbour, as long as there is a better one
        around = graph[at[moving]]
        close = np.einsum("qd,qrd->qr", q[moving], x[np.maximum(around, 0)])
        close[around < 0] = -2
        top = np.argmax(close, axis=1)
        value = close[np.arange(len(moving)), top]
        better = value > best[moving] + 1e-12
        moved = moving[better]
        at[moved], best[moved] = around[np.arange(len(moving)), top][better], value[better]
        moving = moved
    who = np.concatenate([each, each])
    node = np.concatenate([at, queries])
    seen[who, node] = True
    fresh = np.flatnonzero(best >= at_least - SLACK)
    who, node = np.concatenate([each[fresh], each]), np.concatenate([at[fresh], queries])
    found_q, found_n = [each[best >= at_least]], [at[best >= at_least]]
    while len(who):  # outwards: neighbours of all nodes within the range and its slack
        around = graph[node]
        pairs_q, pairs_n = np.repeat(who, around.shape[1]), around.ravel()
        keep = pairs_n >= 0
        code = np.unique(pairs_q[keep] * len(x) + pairs_n[keep])
        pairs_q, pairs_n = np.divmod(code, len(x))
        keep = ~seen[pairs_q, pairs_n]
        pairs_q, pairs_n = pairs_q[keep], pairs_n[keep]
        seen[pairs_q, pairs_n] = True
        close = np.einsum("pd,pd->p", q[pairs_q], x[pairs_n])
        hit = close >= at_least
        found_q.append(pairs_q[hit])
        found_n.append(pairs_n[hit])
        near = close >= at_least - SLACK
        who, node = pairs_q[near], pairs_n[near]
    return queries[np.concatenate(found_q)], np.concatenate(found_n)


def _forest(n: int, a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Least name in each row's group, links being given by rows."""
    label = names.copy()
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (label == before).all():
            break
    return label


def _build_cell(table: pa.Table) -> pa.Table:
    nodes = table.column("node").to_numpy()
    graph = build_graph(_unit(_matrix(table.column("vector"))))
    lists = [nodes[row[row >= 0]].tolist() for row in graph]
    return pa.table({"node": pa.array(nodes, pa.int64()), "around": pa.array(lists, pa.list_(pa.int64()))})


def _search_cell(threshold: float):
    def search(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes, weights = table.column("node").to_numpy(), table.column("weight").to_numpy()
        block = table.column("block").to_numpy()
        shard, i, j = (table.column(c)[0].as_py() for c in ("shard", "i", "j"))
        raw = _matrix(table.column("vector"))
        x = _unit(raw)
        graph = _local_graph(nodes, table.column("around"))
        shards = table.column("shards").to_pylist()
        counts = np.zeros(len(nodes), dtype=np.int64)
        links = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        norms = np.sqrt(np.einsum("nd,nd->n", raw, raw))
        for start in range(0, len(nodes), QUERIES_AT_ONCE):
            queries = np.arange(start, min(start + QUERIES_AT_ONCE, len(nodes)))
            a, b = range_search(x, graph, queries, threshold - 1e-9)
            cosine = np.einsum("pd,pd->p", raw[a], raw[b]) / (norms[a] * norms[b])
            pair = (a != b) & (cosine >= threshold)
            # blocks i and j meet here; within one block, its own cell counts
            low, high = np.minimum(block[a], block[b]), np.maximum(block[a], block[b])
            pair &= (low == i) & (high == j)
            a, b = a[pair], b[pair]
            first = np.fromiter((_first_common(shards[p], shards[r]) == shard for p, r in zip(a, b)), bool, len(a))
            a, b = a[first], b[first]
            np.add.at(counts, a, weights[b])
            links[0].append(a)
            links[1].append(b)
        roots = _forest(len(nodes), np.concatenate(links[0]), np.concatenate(links[1]), nodes)
        kept = counts > 0
        return pa.table({
            "node": pa.array(nodes[kept], pa.int64()),
            "links": pa.array(counts[kept], pa.int64()),
            "root": pa.array(roots[kept], pa.int64()),
        })

    return search


def _first_common(a: list[int], b: list[int]) -> int:
    return min(set(a).intersection(b))


def _local_graph(nodes: np.ndarray, around: pa.ChunkedArray) -> np.ndarray:
    """United adjacency lists as rows of the cell's sorted nodes; -1 fills up."""
    lists = around.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(nodes)), sizes)
    at = np.minimum(np.searchsorted(nodes, flat), len(nodes) - 1)
    here = nodes[at] == flat
    owner, at = owner[here], at[here]
    # neighbours know each other both ways
    owner, at = np.concatenate([owner, at]), np.concatenate([at, owner])
    code = np.unique(owner * len(nodes) + at)
    owner, at = np.divmod(code, len(nodes))
    count = np.bincount(owner, minlength=len(nodes))
    table = np.full((len(nodes), max(1, int(count.max(initial=0)))), -1, dtype=np.int64)
    table[owner, np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)] = at
    return table


def near_duplicates(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = THRESHOLD
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row, and ``audited_links`` (the true number of links) for the
    rows of the audited nodes."""
    spark = vectors.sparkSession
    ship(spark)
    vector = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("_id"), vector.alias("_vector"))
    rows = rows.withColumn("_key", F.md5(F.array_join("_vector", ",", "null")))
    nodes = written(nodes_of(rows), "nodes")
    total = nodes.count()
    part = F.pmod(F.xxhash64("_node"), F.lit(1 << 20))
    sample = nodes.where(part < -(-(1 << 20) * SAMPLE // max(total, 1))).select("_vector").limit(2 * SAMPLE).toArrow()
    by_size: dict[int, list] = {}
    for v in sample.column(0).to_pylist():
        by_size.setdefault(len(v), []).append(v)
    k = min(MOST_CENTROIDS, max(1, -(-total * OVERLAP // SHARD_ROWS)))
    centroids = {size: fit_centroids(_scaled(np.array(v, dtype=np.float64)), k) for size, v in by_size.items()}

    cells = written(deal_cells(assign_shards(nodes, centroids)), "cells")
    built = cells.groupBy("shard", "i", "j").applyInArrow(_build_cell, "node long, around array<long>")
    united = built.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("around"))).alias("around"))
    joined = cells.join(united, "node")
    found = joined.groupBy("shard", "i", "j").applyInArrow(_search_cell(threshold), "node long, links long, root long")
    found = written(found, "found")
    counts = found.groupBy("node").agg(F.sum("links").alias("_links"))
    ends = found.where(F.col("node") != F.col("root")).select(F.col("node").alias("a"), F.col("root").alias("b"))
    groups = connected_components(ends)

    named = nodes.select("_key", "_first", "_weight", F.col("_node").alias("node")).join(counts, "node", "left")
    named = named.join(groups, "node", "left").withColumn("_group", F.coalesce("component", "node"))
    least = named.groupBy("_group").agg(F.min("_first").alias("_least"))
    audited = audit(nodes, threshold)
    named = named.join(least, "_group").join(audited, "node", "left").select(
        "_key", "_weight", "_links", "_least", "_audited"
    )
    joined = lookup_join(rows.select("_id", "_key"), written(named, "named"), "_key", "left", spread_by="_id")
    component = F.coalesce("_least", "_id")
    return joined.select(
        F.col("_id").alias("vec_id"),
        F.coalesce(F.col("_links") + F.col("_weight") - 1, F.col("_weight") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("_id") == component, F.lit(False)).alias("kept"),
        F.col("_audited").alias("audited_links"),
    )


def audit(nodes: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``node, _audited``: the links of AUDITED nodes counted against all vectors, in blocks; the recall of a run is the
    share of them that it found."""
    chosen = nodes.orderBy(F.xxhash64("_node", F.lit("audit")), "_node").limit(AUDITED).select("_node", "_vector", "_weight")
    asked = [(r["_node"], _scaled(np.array([r["_vector"]]))[0], r["_weight"]) for r in chosen.collect()]

    def run(batches):
        for batch in batches:
            vectors, own = batch.column("_vector").to_pylist(), batch.column("_node").to_numpy()
            weights = batch.column("_weight").to_numpy()
            sizes = np.array([len(v) for v in vectors])
            names, counts = [], []
            for size in set(sizes.tolist()):
                rows = np.flatnonzero(sizes == size)
                x = _scaled(np.array([vectors[r] for r in rows]))
                norms = np.sqrt(np.einsum("nd,nd->n", x, x))
                for node, query, _ in asked:
                    if len(query) != size:
                        continue
                    hit = (x @ query / (norms * np.sqrt(query @ query)) >= threshold) & (own[rows] != node)
                    names.append(node)
                    counts.append(int(weights[rows][hit].sum()))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(counts, pa.int64())], names=["node", "n"])

    counted = map_batches(nodes.select("_node", "_vector", "_weight"), run, "node long, n long")
    others = counted.groupBy("node").agg(F.sum("n").alias("_n"))
    copies = nodes.select(F.col("_node").alias("node"), (F.col("_weight") - 1).alias("_copies"))
    return others.join(copies, "node").select("node", (F.col("_n") + F.col("_copies")).alias("_audited"))
