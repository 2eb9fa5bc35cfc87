"""Merkle manifest of a dataset as a persistent tree: proofs for every row, and versions that copy paths.

A row's leaf is the digest of its fields. The rows of a group are a tree in the order of their key: two consecutive nodes make
one (a last one alone makes one too) until one is left, the group's subroot. The subroots, in the order of the groups, are the
leaves of one more tree, whose root stands for the dataset.

Trees are stored as pages: the nodes above ``1 << levels`` aligned leaves are one row. The tops of a stage's pages are the leaves of
the next stage, so a table of any size takes a few stages, each a shuffle by tree and page. A tree that holds a third of all
rows is spread over its pages like any other.

A changed row makes a version. It shares every node with the stored tree but its own leaf and the ancestors of that: these are
copied within the leaf's page, in the task that has the page; above it, the version goes on by itself along the path of its
page, which is joined to it. So no task sees all versions of a tree, however many there are, and a version costs as many nodes
as the tree is high.

Edge cases: a null field is `-`, so null and empty texts differ; a null group is a group of its own, before all others; rows
are ordered by key, null first, and rows with one key by their leaf; equal rows take places side by side, and which of them has
which place makes no difference; a changed leaf may be null (no change); a table without rows has no root and an empty result;
other columns are neither hashed nor returned.
"""

import hashlib
from collections.abc import Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast, lookup_join
from ..plans.ordering import number_rows
from ..plans.storage import written
from .shipping import map_batches, ship

LEVELS = 9
DIGEST = 32
PAGE = "tree string, block bigint, total bigint, first bigint, size int, levels int, nodes binary"
PATH = "tree string, place bigint, path binary"
# before each level of a path: the node stands alone, or its sibling follows and is on its left or right
ALONE, LEFT, RIGHT = range(3)
WHOLE = "*"


def field_text(column: str | Column) -> Column:
    """A field as it goes into a leaf: `-` for null, else its length in bytes, a colon and the value."""
    value = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[str | Column]) -> Column:
    """Leaf of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field_text(c) for c in columns]), 256))


def parent(*nodes: bytes) -> bytes:
    """Digest over the hexadecimal forms of the nodes."""
    return hashlib.sha256(b"".join([n.hex().encode() for n in nodes])).digest()


def climb(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The given nodes and ``levels`` levels above them."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([parent(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def page_levels(page: dict) -> list[list[bytes]]:
    """Nodes of a stored page by level, its leaves first."""
    nodes, size, found, at = page["nodes"], page["size"], [], 0
    for _ in range(page["levels"] + 1):
        found.append([nodes[i : i + DIGEST] for i in range(at, at + size * DIGEST, DIGEST)])
        at, size = at + size * DIGEST, (size + 1) // 2
    return found


def path_in(levels: list[list[bytes]], place: int) -> bytes:
    """Siblings of a page's leaf, from its own level to below the top."""
    parts = []
    for nodes in levels[:-1]:
        sibling = place ^ 1
        if sibling < len(nodes):
            parts += (bytes([LEFT if sibling < place else RIGHT]), nodes[sibling])
        else:
            parts.append(bytes([ALONE]))
        place >>= 1
    return b"".join(parts)


def siblings_of(path: bytes) -> list[tuple[int, bytes]]:
    """A path's levels: side and sibling."""
    found, at = [], 0
    while at < len(path):
        side = path[at]
        at += 1
        found.append((side, b"" if side == ALONE else path[at : at + DIGEST]))
        at += 0 if side == ALONE else DIGEST
    return found


def copies(node: bytes, path: bytes) -> list[bytes]:
    """New ancestors of a changed node along its path, up to the top."""
    found = []
    for side, sibling in siblings_of(path):
        node = parent(node) if side == ALONE else parent(sibling, node) if side == LEFT else parent(node, sibling)
        found.append(node)
    return found


class Forest(NamedTuple):
    """Trees as tables of pages, one per stage, and the top of each tree: ``tree, top``."""

    stages: list[DataFrame]
    tops: list[DataFrame]


class Manifest(NamedTuple):
    """``leaves(key, tree, place, total, leaf, changed)``, the pages of the groups' trees, those of the tree of subroots, where
    each group stands in it (``tree, place, top``), the root in hexadecimal (None without rows), levels of a page."""

    leaves: DataFrame
    groups: Forest
    whole: Forest
    order: DataFrame
    root: str | None
    levels: int


def plant(nodes: DataFrame, levels: int) -> Forest:
    """Pages over ``tree, place, total, node``, stage by stage. A page's leaves are one group of at most ``1 << levels`` rows."""
    ship(nodes.sparkSession)

    def page(key, rows):
        rows = rows.sort_by("place")
        total, first = rows.column("total")[0].as_py(), rows.column("place")[0].as_py()
        # a tree that ends within this page goes up to its one node
        height = min(levels, (total - 1).bit_length())
        stored = b"".join(b"".join(level) for level in climb(rows.column("node").to_pylist(), height))
        row = (key[0].as_py(), key[1].as_py(), total, first, rows.num_rows, height, stored)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
        names = ("tree", "block", "total", "first", "size", "levels", "nodes")
        return pa.table([pa.array([value], kind) for value, kind in zip(row, kinds, strict=True)], names=names)

    most = nodes.agg(F.max("total")).first()[0] or 0
    stages, tops = [], []
    while True:
        block = F.shiftright("place", levels).alias("block")
        grouped = nodes.select("tree", block, "place", "total", "node").groupBy("tree", "block")
        pages = written(grouped.applyInArrow(page, PAGE), "manifest-pages")
        top = F.expr(f"substring(nodes, -{DIGEST}, {DIGEST})")
        left = F.shiftright(F.col("total") + ((1 << levels) - 1), levels)
        stages.append(pages)
        tops.append(pages.where(left == 1).select("tree", top.alias("top")))
        most = (most + (1 << levels) - 1) >> levels
        if most <= 1:
            return Forest(stages, tops)
        nodes = pages.where(left > 1).select("tree", F.col("block").alias("place"), left.alias("total"), top.alias("node"))


def build(
    docs: DataFrame, key: str, group: str, columns: Sequence[str], changed: Column | None = None, levels: int = LEVELS
) -> Manifest:
    """Manifest of ``docs``: leaves over ``columns``, in trees by ``group``, ordered by ``key``. ``changed`` gives the leaf a row
    would have in a version of its own, or null."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    new = F.lit(None).cast("binary") if changed is None else changed
    fields = (F.col(key).alias("key"), tree.alias("tree"), leaf_digest(columns).alias("leaf"), new.alias("changed"))
    hashed = written(docs.select(*fields), "leaves")
    numbered = number_rows(hashed, ["tree", "key", "leaf"], "number")
    first = numbered.groupBy("tree").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("total"))
    placed = lookup_join(numbered, written(first, "trees"), "tree", spread_by="number")
    place = (F.col("number") - F.col("first")).alias("place")
    leaves = written(placed.select("key", "tree", place, "total", "leaf", "changed"), "placed-leaves")
    groups = plant(leaves.select("tree", "place", "total", F.col("leaf").alias("node")), levels)
    tops = groups.tops[0]
    for more in groups.tops[1:]:
        tops = tops.unionByName(more)
    order = written(number_rows(tops, ["tree"], "place"), "subroots")
    n = order.count()
    subroots = order.select(F.lit(WHOLE).alias("tree"), "place", F.lit(n).cast("bigint").alias("total"), F.col("top").alias("node"))
    whole = plant(subroots, levels)
    root = whole.tops[-1].select(F.lower(F.hex("top"))).first()
    return Manifest(leaves, groups, whole, order, root and root[0], levels)


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if fits_broadcast(table) else table


def page_paths(pages: DataFrame) -> DataFrame:
    """``tree, place, path`` within its page for every leaf of the given pages."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                levels, first = page_levels(row), row["first"]
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": [row["tree"]] * row["size"],
                        "place": list(range(first, first + row["size"])),
                        "path": [path_in(levels, i) for i in range(row["size"])],
                    },
                    pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", pa.binary())]),
                )

    return map_batches(pages, run, PATH)


def paths_above(forest: Forest, outer: DataFrame, levels: int) -> DataFrame:
    """``tree, block, above, top``: the way from the top of each page of the first stage to the root. ``outer`` has it for the
    tops of the trees: ``tree, above, top``."""
    found = None
    for stage in reversed(range(len(forest.stages))):
        ended = forest.tops[stage].select("tree").join(_small(outer), "tree")
        here = ended.select("tree", F.lit(0).cast("bigint").alias("block"), "above", "top")
        if found is not None:
            inside = page_paths(forest.stages[stage + 1]).withColumn("block", F.shiftright("place", levels))
            longer = inside.join(_small(found), ["tree", "block"])
            place = F.col("place").alias("block")
            here = here.unionByName(longer.select("tree", place, F.concat("path", "above").alias("above"), "top"))
        found = written(here, "manifest-paths")
    return found


def _walk(key, rows, pages):
    """Path of each leaf within its page, and the copies a change makes there."""
    page = pages.to_pylist()[0]
    levels, first = page_levels(page), page["first"]
    paths = [path_in(levels, place - first) for place in rows.column("place").to_pylist()]
    copied = [
        None if node is None else [node, *copies(node, path)]
        for node, path in zip(rows.column("changed").to_pylist(), paths, strict=True)
    ]
    return rows.append_column("path", pa.array(paths, pa.binary())).append_column("copied", pa.array(copied, pa.list_(pa.binary())))


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with its proof: ``key, tree, place, leaf, subroot`` (hexadecimal), ``path`` (all siblings with their sides),
    ``proof_sha256``; and for the leaf itself or, where it was changed, its version: ``copied`` (the new nodes from the leaf to
    the root, null without a change; node ``place >> l`` of level l of the group's tree, then of the tree of subroots, is
    ``copied[l]``, all others are the stored ones) and ``folded_root``."""
    whole, levels = manifest.whole, manifest.levels
    spark = manifest.leaves.sparkSession
    nothing = spark.createDataFrame([(WHOLE, b"", None)], "tree string, above binary, top binary")
    above = paths_above(whole, nothing, levels).select("block", "above")
    inside = page_paths(whole.stages[0]).withColumn("block", F.shiftright("place", levels)).join(_small(above), "block")
    inside = written(inside.select("place", F.concat("path", "above").alias("above")), "manifest-paths")
    outer = written(manifest.order.join(_small(inside), "place").select("tree", "above", "top"), "manifest-paths")
    above = paths_above(manifest.groups, outer, levels)

    block = F.shiftright("place", levels).alias("block")
    rows = manifest.leaves.select("key", "tree", block, "place", "leaf", "changed")
    ship(spark)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items()) + ", path binary, copied array<binary>"
    walked = rows.groupBy("tree", "block").cogroup(manifest.groups.stages[0].groupBy("tree", "block")).applyInArrow(_walk, schema)
    joined = walked.join(_small(above), ["tree", "block"]).select(
        "key", "tree", "place", "leaf", "path", "copied", "above", F.col("top").alias("subroot")
    )
    out = f"key {kinds['key']}, tree string, place bigint, leaf string, subroot string, path binary, proof_sha256 string"
    return map_batches(joined, _finish, f"{out}, copied array<binary>, folded_root string")


def _finish(batches):
    """Go on above the page: the proof's digest, the copies there, the root that follows."""
    for batch in batches:
        rows = batch.to_pydict()
        digests, copied, roots = [], [], []
        paths = [path + above for path, above in zip(rows["path"], rows["above"], strict=True)]
        for leaf, path, above, inside in zip(rows["leaf"], paths, rows["above"], rows["copied"], strict=True):
            digests.append(hashlib.sha256(b"".join([s.hex().encode() for _, s in siblings_of(path)])).hexdigest())
            nodes = [leaf, *copies(leaf, path)] if inside is None else inside + copies(inside[-1], above)
            roots.append(nodes[-1].hex())
            copied.append(None if inside is None else nodes)
        columns = [
            batch.column("key"),
            batch.column("tree"),
            batch.column("place"),
            pa.array([n.hex() for n in rows["leaf"]], pa.string()),
            pa.array([n.hex() for n in rows["subroot"]], pa.string()),
            pa.array(paths, pa.binary()),
            pa.array(digests, pa.string()),
            pa.array(copied, pa.list_(pa.binary())),
            pa.array(roots, pa.string()),
        ]
        names = ["key", "tree", "place", "leaf", "subroot", "path", "proof_sha256", "copied", "folded_root"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def versions(proved: DataFrame) -> DataFrame:
    """The versions among proved rows: ``key, tree, place, copied, root``, one row per changed leaf."""
    return proved.where(F.col("copied").isNotNull()).select("key", "tree", "place", "copied", F.col("folded_root").alias("root"))
