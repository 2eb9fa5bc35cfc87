"""Token counts that follow edits: a segment tree of pre-tokens per document.

A leaf holds LEAF pre-tokens in a row: how many characters and how many tokens they have. Above the leaves are sums, so a
position is found by descending and the total is the root. An edit replaces a run of leaves: encoding starts at the leaf
that holds the last character whose pre-token could still change, and goes on until a new pre-token ends where an old
leaf begins behind the edit. From such a place on, pre-tokens depend only on the text that follows, so the rest of the
tree stays; only sums above changed leaves are made again.

Edge cases: a null text is the empty text with 0 tokens; edits that reach beyond the text are cut to it; null edits and
an empty list change nothing; several edits of a document apply one after another; all other columns pass through,
those named like an output are replaced.
"""

from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import add_columns, texts_of
from .bpe import Tokenizer, read_spec, tokenizer

LEAF = 32
EDITS = "array<struct<start:int,removed:int,inserted:string>>"


class SegmentTree:
    """Sums over leaves ``(characters, tokens)``; level 0 is the leaves, every next one sums pairs."""

    def __init__(self, leaves: list[tuple[int, int]]):
        self.levels = [list(leaves)]
        self._sum(0)

    def _sum(self, first: int) -> None:
        """Make the sums above the leaves from number ``first`` on again."""
        level = 0
        while len(self.levels[level]) > 1:
            below, first = self.levels[level], first // 2
            if level + 1 == len(self.levels):
                self.levels.append([])
            above = self.levels[level + 1]
            del above[first:]
            for i in range(2 * first, len(below), 2):
                pair = below[i : i + 2]
                above.append((sum(c for c, _ in pair), sum(t for _, t in pair)))
            level += 1
        del self.levels[level + 1 :]

    @property
    def total(self) -> tuple[int, int]:
        top = self.levels[-1]
        return top[0] if top else (0, 0)

    def leaf_at(self, position: int) -> tuple[int, int]:
        """Number and first character of the leaf that holds a position; behind the end, of the last leaf."""
        at, start = 0, 0
        for level in range(len(self.levels) - 2, -1, -1):
            at *= 2
            nodes = self.levels[level]
            if at + 1 < len(nodes) and position >= start + nodes[at][0]:
                start += nodes[at][0]
                at += 1
        return at, start

    def replace(self, first: int, end: int, leaves: list[tuple[int, int]]) -> None:
        """Put ``leaves`` in the place of those from ``first`` to before ``end``."""
        same = len(leaves) == end - first
        self.levels[0][first:end] = leaves
        if not same:
            self._sum(first)
            return
        low, high = first, end
        for level in range(1, len(self.levels)):
            low, high = low // 2, (high + 1) // 2
            below, nodes = self.levels[level - 1], self.levels[level]
            for i in range(low, min(high, len(nodes))):
                pair = below[2 * i : 2 * i + 2]
                nodes[i] = (sum(c for c, _ in pair), sum(t for _, t in pair))


def _pre_tokens(text: str, coder: Tokenizer) -> list[tuple[int, int]]:
    """Characters and tokens of each pre-token; a special token is one."""
    parts = coder.special_pattern.split(text) if coder.special_pattern else [text]
    found = []
    for i, part in enumerate(parts):
        if i % 2:
            found.append((len(part), 1))
        else:
            found += [(len(p), len(coder.pieces[p]) // 4) for p in coder.split(part)]
    return found


def _leaves(tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    runs = (tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF))
    return [(sum(c for c, _ in run), sum(t for _, t in run)) for run in runs]


def build_tree(text: str, coder: Tokenizer) -> SegmentTree:
    return SegmentTree(_leaves(_pre_tokens(text, coder)))


def apply_edit(text: str, tree: SegmentTree, coder: Tokenizer, start: int, removed: int, inserted: str) -> tuple[str, int]:
    """The edited text, and how many characters were encoded again; ``tree`` is brought up to date."""
    start = min(max(start, 0), len(text))
    stop = min(start + max(removed, 0), len(text))
    edited = text[:start] + inserted + text[stop:]
    shift = len(edited) - len(text)
    leaves = tree.levels[0]
    # white space looks two characters ahead, and an edit may complete a special token that began before it
    context = 2 + max(map(len, coder.special), default=0)
    first, begin = tree.leaf_at(start - context) if leaves else (0, 0)
    last, at = tree.leaf_at(stop) if leaves else (0, 0)
    spread = 1
    while True:
        end = min(last + spread, len(leaves))
        place = at + sum(c for c, _ in leaves[last:end])
        # two leaves more are read, so that the pre-token at ``place`` ends as it does in the whole text
        ahead = place + sum(c for c, _ in leaves[end : end + 2])
        part = edited[begin : ahead + shift]
        tokens = _pre_tokens(part, coder)
        if end == len(leaves):
            break
        ends = list(accumulate(c for c, _ in tokens))
        wanted = place + shift - begin
        near = bisect_right(ends, wanted)
        if place >= stop and near and ends[near - 1] == wanted:
            tokens = tokens[:near]
            break
        spread *= 2
    tree.replace(first, end, _leaves(tokens))
    return edited, len(part)


def count_with_edits(docs: DataFrame, path: str, text: str = "text", edits: str = "edits") -> DataFrame:
    """Count the tokens of each whole text, apply its edits (an array of EDITS) and count again from the tree.

    Adds ``n_tokens``, ``n_tokens_edited``, ``encoded_again`` (characters that the edits made the encoder read) and
    ``edited``, the text after the edits. No shuffle.
    """
    spec = read_spec(path)

    def make(batch):
        coder = tokenizer(spec)
        rows = []
        for content, changes in zip(texts_of(batch, text), batch.column(edits).to_pylist(), strict=True):
            tree = build_tree(content, coder)
            before, again = tree.total[1], 0
            for change in changes or []:
                if change is not None:
                    content, read = apply_edit(
                        content, tree, coder, change["start"] or 0, change["removed"] or 0, change["inserted"] or ""
                    )
                    again += read
            rows.append((before, tree.total[1], again, content))
        kinds = {"n_tokens": pa.int64(), "n_tokens_edited": pa.int64(), "encoded_again": pa.int64(), "edited": pa.string()}
        return {name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds.items())}

    long = T.LongType()
    added = {"n_tokens": long, "n_tokens_edited": long, "encoded_again": long, "edited": T.StringType()}
    return add_columns(docs, text, added, make)
