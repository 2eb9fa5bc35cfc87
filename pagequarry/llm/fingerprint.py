"""Document fingerprints by content-defined chunking.

A gear hash runs over the UTF-8 bytes; where its low bits are zero a chunk may end. Chunking is normalised: short of the
usual length more zero bits are asked for, beyond it fewer, so lengths gather around the usual one. As boundaries
depend on the last 16 bytes only, an insertion moves them locally. The fingerprint is the sorted set of the chunks'
digests with their lengths, and likeness is the length-weighted share of one set found in the other.

Edge cases: a null text is the empty text; its fingerprint is the empty string; two empty texts are alike (1.0), an
empty and another one are not (0.0); equal texts have equal fingerprints.
"""

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns, texts_of
from .shipping import map_batches

LEAST, USUAL, MOST = 24, 64, 256
STRICT_BITS, EASY_BITS = 7, 4
WINDOW = 16
_GEAR = np.random.default_rng(20_240_608).integers(0, 1 << WINDOW, 256, dtype=np.uint16)
PAYLOAD_LEVEL = 3


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash modulo 2**16 after each byte: the sum of the last 16 bytes' numbers, each shifted by its age. Made by
    doubling the window four times."""
    h = _GEAR[data]
    reach = 1
    while reach < WINDOW:
        if len(h) > reach:
            h = h.copy()
            h[reach:] += h[:-reach] << np.uint16(reach)
        reach *= 2
    return h


def boundaries(data: bytes) -> list[int]:
    """Ends of the chunks."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    h = gear(np.frombuffer(data, dtype=np.uint8))
    easy = np.flatnonzero((h & np.uint16((1 << EASY_BITS) - 1)) == 0)
    strict = easy[(h[easy] & np.uint16((1 << STRICT_BITS) - 1)) == 0]
    easy, strict = (easy + 1).tolist(), (strict + 1).tolist()
    ends, start = [], 0
    while n - start > LEAST:
        end, usual = min(start + MOST, n), min(start + USUAL, n)
        at = bisect_left(strict, start + LEAST)
        if at < len(strict) and strict[at] <= usual:
            end = strict[at]
        else:
            at = bisect_left(easy, usual)
            if at < len(easy) and easy[at] < end:
                end = easy[at]
        ends.append(end)
        start = end
    if start < n:
        ends.append(n)
    return ends


def chunk_set(data: bytes) -> dict[int, int]:
    """Digest and length of the distinct chunks."""
    found, start = {}, 0
    for end in boundaries(data):
        found[xxhash.xxh3_64_intdigest(data[start:end])] = end - start
        start = end
    return found


def as_text(chunks: dict[int, int]) -> str:
    """A chunk set as text: length and digest of each chunk, in the order of the digests."""
    return " ".join(f"{length:x}-{digest:016x}" for digest, length in sorted(chunks.items()))


def containment(own: dict[int, int], other: dict[int, int]) -> float:
    """Share of ``own`` by length that ``other`` holds too."""
    whole = sum(own.values())
    if not whole:
        return 0.0 if other else 1.0
    return sum(length for digest, length in own.items() if digest in other) / whole


def fingerprint(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of each whole text. No shuffle."""
    def make(batch):
        return {out: pa.array([as_text(chunk_set(t.encode())) for t in texts_of(batch, text)], pa.string())}

    return add_columns(docs, text, {out: T.StringType()}, make)


def _cuts(docs: DataFrame, key: str) -> list[int]:
    """Values of ``key`` that cut the rows into about as many even ranges as there are shuffle partitions."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = docs.stat.approxQuantile("_order", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    return sorted({int(c) for c in found})


def compare_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every document, an edited text of it and its successor, and compare them.

    Documents stand in descending order of ``doc_id`` (repeated ids by the digest of their text, no id last), and after
    the last comes the first. The edited text has the last third of the code points replaced by as many from the
    beginning of the next document (or all of it). Returns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The texts move once, compressed: ids are cut into ranges, each range is a run of neighbours, and the first document
    of a range is also sent to the range before it. Their number is that of the shuffle partitions.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    rows = docs.select(F.col(doc_id).cast("bigint").alias("_order"), F.coalesce(text, F.lit("")).alias("_text"))
    cuts = _cuts(rows, "_order")
    # range 0 holds the greatest ids; rows without an id have the last range
    spot = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c).cast("bigint") for c in cuts])
        spot = F.lit(len(cuts)) - F.size(F.filter(edges, lambda c: c <= F.col("_order")))
    spot = F.when(F.col("_order").isNull(), len(cuts) + 1).otherwise(spot).cast("int")
    ranged = rows.select("_order", "_text", spot.alias("_range"))
    place = F.struct(F.col("_order"), F.md5("_text").alias("_tie"))
    # the greatest place of a range is its first document; one row per range
    heads = {
        r["_range"]: (r["_head"]["_order"], r["_head"]["_tie"])
        for r in ranged.groupBy("_range").agg(F.max(place).alias("_head")).collect()
    }
    taken = sorted(heads)
    before = {spot: taken[i - 1] for i, spot in enumerate(taken)}  # the first range stands behind the last one
    sent = _send(ranged, heads, before)
    ends = sent.repartition(F.col("_range")).sortWithinPartitions("_range", F.col("_guest"), F.desc_nulls_last("_order"), F.desc("_tie"))
    return map_batches(ends, _compare_runs, schema)


def _send(ranged: DataFrame, heads: dict, before: dict) -> DataFrame:
    """Rows with their text compressed; the first row of each range a second time, as a guest of the range before."""
    schema = "_range int, _guest boolean, _order bigint, _tie string, _data binary"

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=PAYLOAD_LEVEL)
        sent = set()
        for batch in batches:
            columns = [[], [], [], [], []]
            for order, text, spot in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tie = hashlib.md5(text.encode()).hexdigest()
                data = squeeze.compress(text.encode())
                homes = [(spot, False)]
                if heads[spot] == (order, tie) and spot not in sent:
                    sent.add(spot)
                    homes.append((before[spot], True))
                for home, guest in homes:
                    for column, value in zip(columns, (home, guest, order, tie, data), strict=True):
                        column.append(value)
            kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.string(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["_range", "_guest", "_order", "_tie", "_data"])

    return map_batches(ranged, run, schema)


def _compare_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours in a sorted run of ranges; one document waits for the next row."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    opened = zstandard.ZstdDecompressor()
    waiting = None
    for batch in batches:
        out = []
        for spot, guest, order, _, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = opened.decompress(data).decode()
            chunks = chunk_set(text.encode())
            if waiting is not None and waiting[0] == spot:
                out.append(_compare(*waiting[1:], text, chunks))
            # of two copies of a range's head sent by two tasks, and past a guest, there is nothing to compare
            waiting = None if guest else (spot, order, text, chunks)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row[i] for row in out], kind) for i, kind in enumerate(kinds)], names=names
        )


def _compare(order: int | None, text: str, chunks: dict, next_text: str, next_chunks: dict) -> tuple:
    n = len(text)
    third = n // 3
    edited = (text[: n - third] + next_text[:third]).encode()
    changed = chunk_set(edited)
    return (
        order,
        n,
        hashlib.sha256(edited).hexdigest(),
        as_text(chunks),
        as_text(changed),
        containment(chunks, changed),
        containment(chunks, next_chunks),
    )
