"""Alignment of the tokens of two tokenizers over the same texts, and how often their ids meet in the corpus.

Tokens are byte ranges. ``pandas.merge_asof``, keyed by document, finds for the start of each token the token of the other
side that covers it; both directions together give every overlap once. Places where tokens of both sides end cut a text into
groups.

Two passes. The first works on slices of the table (a megabyte of texts each): it encodes, aligns, and lists the
distinct id pairs of the slice with the number of documents that hold each. A document keeps its links as positions in its
slice's list, sorted, as gaps in one or two bytes. The counts of the lists are summed by pair over the corpus and compared
with the highest count of their first id; the second pass joins them back to the lists, brings list and documents of a slice
together and sums up the counts of each document's links. What is shuffled is the slices' lists, which hold a frequent pair
once per slice, and the packed links. Ids come from vocabularies, so the table of pairs is bounded by them; it is not sent
to the tasks all the same, but joined.

Edge cases: null and empty texts, and those whose joined bytes differ from a space and the text on either side, have no
tokens: zeros and an empty digest. Spelled-out special tokens are plain text. Rows count as documents one by one, whether or
not their ids repeat or are null. A text longer than a slice is a slice of its own. Other columns pass through unless named
like an output, which replaces them; an empty table gives an empty result.
"""

import hashlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.storage import written
from .arrow import pieces, schema_with, texts_of, with_columns
from .bpe import KEPT_PIECES, KeptTexts, Tokenizer, read_spec, tokenizer
from .piece_bpe import piece_model
from .shipping import map_batches, ship

SLICE_BYTES = 1024 * 1024
# columns of the first pass besides the counts
SLICE, LINKS, LIST = "__alignment_slice", "__alignment_links", "__alignment_list"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
RESULTS = (*COUNTS, "n_best", "count_sum", "groups_sha256")


class Side:
    """One tokenizer: ids of a text, and the bytes and decimal forms of its tokens."""

    def __init__(self, encode, bytes_of: np.ndarray):
        self.encode, self.bytes_of = encode, bytes_of
        self.sizes = np.array([len(b) for b in bytes_of], dtype="int64")
        numbers = [str(i) for i in range(len(bytes_of))]
        # an id followed by what comes after it, inside a side and at the end of its part of a group
        self.inner = np.array([n + "," for n in numbers], dtype=object)
        self.numbers = numbers


@lru_cache(maxsize=1)
def sides(spec_a: bytes, spec_b: bytes) -> tuple[Side, Side]:
    """Both tokenizers, built once per Python worker: the byte-level one reads a space and the text, the piece model puts
    that space there by itself."""
    a, b = tokenizer(spec_a), piece_model(spec_b)
    pieces_a = KeptTexts(_piece_encoder(a), KEPT_PIECES)

    def plain(text: str) -> bytes:
        return b"".join(map(pieces_a.__getitem__, a.split(" " + text)))

    first, second = Side(plain, a.bytes_of), Side(b.encode, b.bytes_of)
    first.outer = np.array([n + "|" for n in first.numbers], dtype=object)
    second.outer = np.array([n + ";" for n in second.numbers], dtype=object)
    return first, second


def _piece_encoder(coder: Tokenizer) -> Callable[[str], bytes]:
    """Ids of one pre-token as unsigned 32-bit integers. Where ids follow the order of the merges, the byte-pair library does
    that from the same vocabulary, at a tenth of the time for a word not met before."""
    tokens = {raw: i for i, raw in enumerate(coder.bytes_of) if raw and raw.decode(errors="replace") not in coder.special}
    if list(coder.ids[256:]) != sorted(coder.ids[256:]) or len(tokens) != len(set(coder.ids)):
        return lambda piece: coder.encode_piece(piece.encode())
    library = tiktoken.Encoding("pieces", pat_str=r"[\s\S]+", mergeable_ranks=tokens, special_tokens={})
    return lambda piece: array("I", library._core_bpe.encode_single_piece(piece.encode())).tobytes()


def pack(numbers: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Whole numbers from 0 on in seven bits a byte, the last byte of each below 128; and how many bytes each takes."""
    numbers = numbers.astype("int64")
    sizes = np.ones(len(numbers), dtype="int64")
    for bits in range(7, 63, 7):
        sizes += numbers >> bits > 0
    ends = np.cumsum(sizes)
    out = np.zeros(ends[-1] if len(ends) else 0, dtype=np.uint8)
    for k in range(int(sizes.max(initial=0))):
        here = sizes > k
        out[ends[here] - sizes[here] + k] = (numbers[here] >> (7 * k) & 127) | np.where(sizes[here] > k + 1, 128, 0)
    return out.tobytes(), sizes


def unpack(data: bytes) -> np.ndarray:
    """The numbers of ``pack``."""
    raw = np.frombuffer(data, dtype=np.uint8).astype("int64")
    ends = np.flatnonzero(raw < 128)
    if not len(ends):
        return ends
    starts = np.concatenate([[0], ends[:-1] + 1])
    place = np.arange(len(raw)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((raw & 127) << (7 * place), starts)


def covering(starts: np.ndarray, docs: np.ndarray, other_starts: np.ndarray, other_docs: np.ndarray) -> np.ndarray:
    """For each token, the other side's token of its document that covers its start. Tokens come in order."""
    if not len(starts):
        return np.zeros(0, dtype="int64")
    left = pd.DataFrame({"at": starts, "doc": docs})
    right = pd.DataFrame({"at": other_starts, "doc": other_docs, "token": np.arange(len(other_starts))})
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy()


def overlaps(starts_a, docs_a, starts_b, docs_b) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of tokens (numbers of A, numbers of B) whose byte ranges overlap, each once."""
    over_a = covering(starts_a, docs_a, starts_b, docs_b)
    over_b = covering(starts_b, docs_b, starts_a, docs_a)
    # a common start is found from both sides
    once = starts_a[over_b] != starts_b
    return np.concatenate([np.arange(len(starts_a)), over_b[once]]), np.concatenate([over_a, np.flatnonzero(once)])


def _tokens(texts: list[str], side: Side) -> list[np.ndarray]:
    return [np.frombuffer(side.encode(text), dtype="<u4") for text in texts]


def align_slice(texts: list[str], a: Side, b: Side) -> dict:
    """Counts, group digests, packed links and the list of id pairs for the texts of one slice."""
    n = len(texts)
    ids_a, ids_b = _tokens(texts, a), _tokens(texts, b)
    none = np.zeros(0, dtype="<u4")
    for i, text in enumerate(texts):
        # both encoders cover a text character by character and rewrite one of them only, U+2581 as a space, which takes
        # fewer bytes: so bytes are equal where their number is
        size = len(text.encode()) + 1
        if not text or a.sizes[ids_a[i]].sum() != size or b.sizes[ids_b[i]].sum() != size:
            ids_a[i] = ids_b[i] = none
    n_a, n_b = (np.array([len(ids) for ids in side], dtype="int64") for side in (ids_a, ids_b))
    all_a, all_b = (np.concatenate([none, *side]).astype("int64") for side in (ids_a, ids_b))
    docs_a, docs_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
    # both sides hold the same bytes, so running sums place tokens of all documents on one line
    ends_a, ends_b = np.cumsum(a.sizes[all_a]), np.cumsum(b.sizes[all_b])
    starts_a, starts_b = ends_a - a.sizes[all_a], ends_b - b.sizes[all_b]

    # marks per byte: where tokens of both sides end, a group does
    marks = np.zeros((2, 1 + (int(ends_a[-1]) if len(ends_a) else 0)), dtype=bool)
    marks[0, ends_a] = marks[1, ends_b] = True
    common = marks[0] & marks[1]
    last_a, last_b = common[ends_a], common[ends_b]
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    of_a, of_b = np.bincount(group_a), np.bincount(group_b)
    # A's part of a group comes first: tokens of the other side in earlier groups, or up to this one, stand before
    spots_a = np.arange(len(all_a)) + (np.cumsum(of_b) - of_b)[group_a]
    spots_b = np.arange(len(all_b)) + np.cumsum(of_a)[group_b]
    words = np.empty(len(all_a) + len(all_b), dtype=object)
    words[spots_a] = np.where(last_a, a.outer[all_a], a.inner[all_a])
    words[spots_b] = np.where(last_b, b.outer[all_b], b.inner[all_b])
    words = words.tolist()
    bounds = np.concatenate([[0], np.cumsum(n_a + n_b)])
    digests = [
        hashlib.sha256("".join(words[s:e])[:-1].encode()).hexdigest() if e > s else ""
        for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    ]

    link_a, link_b = overlaps(starts_a, docs_a, starts_b, docs_b)
    place, pairs = pd.factorize(all_a[link_a] << 32 | all_b[link_b], sort=True)
    # sorted by document and place in the list: gaps are small, a repeated pair is a gap of 0
    base = len(pairs) + 1
    keys = np.sort(docs_a[link_a] * base + place + 1)
    link_docs = keys // base
    first = np.diff(link_docs, prepend=-1) > 0
    gaps = np.where(first, keys % base, np.diff(keys, prepend=0))
    n_links = np.bincount(link_docs, minlength=n)
    packed, sizes = pack(gaps)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(link_docs, weights=sizes, minlength=n).astype("int64"))])
    holders = np.bincount(keys[gaps > 0] % base - 1, minlength=len(pairs))
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.bincount(docs_a[last_a], minlength=n),
        "n_links": n_links,
        "groups_sha256": digests,
        LINKS: [packed[s:e] for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)],
        LIST: (pairs >> 32, pairs & 0xFFFFFFFF, holders),
    }


def align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The first pass, not yet written: rows of ``docs`` with counts, digest, slice number and packed links; the first row
    of each slice carries the list of its id pairs. ``path_a`` is a byte-level file, ``path_b`` a piece model."""
    spec_a, spec_b = read_spec(path_a), read_spec(path_b)
    listed = T.ArrayType(T.StructType([T.StructField(f, T.IntegerType()) for f in ("a", "b", "docs")]))
    added = {c: T.LongType() for c in COUNTS} | {"groups_sha256": T.StringType()}
    added |= {SLICE: T.LongType(), LINKS: T.BinaryType(), LIST: listed}
    schema = schema_with(docs, added, () if keep_text else (text,))

    def run(batches):
        a, b = sides(spec_a, spec_b)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for piece in pieces(batch, text, SLICE_BYTES):
                found = align_slice(texts_of(piece, text), a, b)
                columns = {c: pa.array(found[c], pa.int64()) for c in COUNTS}
                columns["groups_sha256"] = pa.array(found["groups_sha256"], pa.string())
                columns[SLICE] = pa.array(np.full(piece.num_rows, number), pa.int64())
                columns[LINKS] = pa.array(found[LINKS], pa.binary())
                pairs = pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in found[LIST]], names=["a", "b", "docs"])
                ends = pa.array([0, *[len(pairs)] * piece.num_rows], pa.int32())
                columns[LIST] = pa.ListArray.from_arrays(ends, pairs)
                yield with_columns(piece, columns, () if keep_text else (text,))
                number += 1

    return map_batches(docs, run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents of the corpus that hold the ids linked, and whether no pair of ``a`` has more."""
    lists = aligned.where(F.size(LIST) > 0).select(F.inline(LIST))
    counts = lists.groupBy("a", "b").agg(F.sum("docs").alias("count"))
    # an id's pairs are at most the other vocabulary's ids
    return counts.withColumn("best", F.col("count") == F.max("count").over(W.partitionBy("a")))


def link_documents(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """The second pass: ``n_best`` and ``count_sum`` of every row from the counts of its links."""
    # renamed, as both sides of what follows come from one table
    lists = aligned.where(F.size(LIST) > 0).select(F.col(SLICE).alias("slice"), F.posexplode(LIST).alias("place", "pair"))
    lists = lists.select("slice", "place", "pair.a", "pair.b").join(counts, ["a", "b"])
    lists = lists.select("slice", "place", "count", "best")
    rows = aligned.drop(LIST)
    kept = [c for c in rows.columns if c not in (SLICE, LINKS)]
    added = {"n_best": T.LongType(), "count_sum": T.LongType()}
    schema = schema_with(rows.select(*kept), added)

    def sum_up(key, documents, scores):
        table = np.zeros((2, scores.num_rows), dtype="int64")
        place = scores.column("place").to_numpy()
        table[0, place] = scores.column("best").to_numpy()
        table[1, place] = scores.column("count").to_numpy()
        n_links = documents.column("n_links").to_numpy()
        gaps = unpack(b"".join(documents.column(LINKS).to_pylist()))
        bounds = np.concatenate([[0], np.cumsum(n_links)])
        running = np.cumsum(gaps)
        before = np.concatenate([[0], running])[bounds[:-1]]
        places = running - np.repeat(before, n_links) - 1
        sums = np.zeros((2, len(gaps) + 1), dtype="int64")
        np.cumsum(table[:, places], axis=1, out=sums[:, 1:])
        best, total = np.diff(sums[:, bounds], axis=1)
        columns = {c: documents.column(c) for c in kept} | {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table(columns)

    ship(aligned.sparkSession)
    grouped = rows.groupBy(SLICE).cogroup(lists.groupBy("slice"))
    return grouped.applyInArrow(sum_up, schema)


def cross_align(docs: DataFrame, path_a: str, path_b: str, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Rows of ``docs`` with the sizes of both encodings, groups and links, how many links are the best of their first id,
    and the sum of the links' counts over the corpus."""
    aligned = written(align(docs, path_a, path_b, text, keep_text), "aligned")
    return link_documents(aligned, written(pair_counts(aligned), "pair-counts"))
