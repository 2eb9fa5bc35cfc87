"""Merkle manifests against a plain tree: pages of every size, null fields and groups, repeated rows, versions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from pagequarry.llm import manifest

FIELDS = ["doc_id", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])
    return levels


def plain_path(levels, place):
    """(sibling or None, whether it stands on the left) per level"""
    path = []
    for level in levels[:-1]:
        other = place ^ 1
        path.append((level[other] if other < len(level) else None, other < place))
        place >>= 1
    return path


def fold(node, path):
    for sibling, left in path:
        node = digest(node if sibling is None else sibling + node if left else node + sibling)
    return node


def brute(rows, touched):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((ordered, plain_tree([leaf_of(r) for r in ordered])))
    top = plain_tree([levels[-1][0] for _, levels in trees])
    found = []
    for k, (ordered, levels) in enumerate(trees):
        for place, row in enumerate(ordered):
            path = plain_path(levels, place) + plain_path(top, k)
            new = (*row[:2], row[2] + 1, row[3]) if touched(row) else row
            root = fold(leaf_of(new), path)
            proof = digest("".join(s for s, _ in path if s))
            found.append((row[0], leaf_of(row), levels[-1][0], proof, root))
    return top[-1][0], sorted(found, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 9])
def test_proofs_and_versions_are_those_of_a_plain_tree(spark, levels):
    sizes = {"en": 37, "de": 8, None: 5, "": 1, "é": 2, "zz": 9}
    rows = [(i, lang, None if i % 5 == 4 else i, f"text {i}" if i % 7 else None) for lang, n in sizes.items() for i in range(n)]
    rows += [(3, "en", 3, "text 3"), (3, "en", 3, "another"), (None, "en", 1, "no id"), (50, "en", 2, "")]

    def touched(row):
        return row[0] is not None and row[0] % 3 == 0 and row[2] is not None

    docs = spark.createDataFrame(rows, "doc_id long, lang string, n_chars long, text string")
    docs = docs.withColumns({"leaf": F.lit("x"), "tree": F.lit("y"), "place": F.lit(0)}).repartition(3)
    new = ["doc_id", "lang", F.col("n_chars") + 1, "text"]
    changed = F.when((F.col("doc_id") % 3 == 0) & F.col("n_chars").isNotNull(), manifest.leaf_digest(new))
    built = manifest.build(docs, "doc_id", "lang", FIELDS, changed, levels)
    root, expected = brute(rows, touched)
    assert built.root == root
    proved = manifest.prove(built)
    found = proved.collect()
    assert sorted(((r["key"], r["leaf"], r["subroot"], r["proof_sha256"], r["folded_root"]) for r in found), key=repr) == expected
    made = manifest.versions(proved).collect()
    assert len(made) == sum(map(touched, rows)) and all(r["root"] != root for r in made)
    # a version's new nodes are the leaf and one per level up to the root; everything else is shared
    for version in made:
        assert version["copied"][-1].hex() == version["root"]
        path = next(r["path"] for r in found if (r["tree"], r["place"]) == (version["tree"], version["place"]))
        assert len(version["copied"]) == 1 + len(manifest.siblings_of(bytes(path)))


def test_one_row_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None, None, None)], "doc_id long, lang string, n_chars long, text string")
    built = manifest.build(docs, "doc_id", "lang", FIELDS)
    row = manifest.prove(built).first()
    assert row["leaf"] == row["subroot"] == row["folded_root"] == built.root == leaf_of((1, None, None, None))
    assert row["proof_sha256"] == digest("") and row["copied"] is None
    nothing = manifest.build(docs.limit(0), "doc_id", "lang", FIELDS)
    assert nothing.root is None and manifest.prove(nothing).count() == 0
