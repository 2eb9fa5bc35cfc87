"""Join of documents by the Jaccard similarity of their five-word shingles, with parity sketches.

Each shingle flips one bit of a document's sketch, so the Hamming distance of two sketches never exceeds the symmetric
difference D of the two sets. At similarity p / 100, two sets of sizes s and t link only if D <= (s + t)(100 - p) / (100
+ p). By the pigeonhole principle, of any D + 1 segments of a sketch at least one is then the same in both.

The sketch is long and sparse: its length doubles with the size band of the larger document, so a segment holds about
two shingles and is rarely the same by chance. A segment is known by a digest of its set bits. Documents give the keys
of as many non-empty segments as they need, the rarest first: rarity is guessed from a sample of documents, and as both
sides use the same order the guess decides the cost, never the result. A document enters the band of its own size and,
where its larger partners may lie in the next one, that one too.

Documents that share a key hang from the first one of them, and only those pairs are verified, so a group of copies
costs one pair per member and key, not all pairs. What that leaves open is closed exactly: where a pair failed, the
members of that key that are still in different groups are compared with each other, less those that their known
distances to the first one, or a second, dense sketch, rule out. Verification intersects the sets of whole texts.

Edge cases: a null or blank text has an empty set and is its own group; equal sets are one class from the start; rows
that share a doc_id are judged one by one, and a null id is never the least of a group unless all are null; all other
columns pass through, those named like an output are replaced; an empty table gives an empty result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.joins import fits_broadcast, lookup_join
from ..plans.storage import written
from .arrow import pieces, texts_of
from .components import connected_components
from .shipping import map_batches
from .words import U, mix, shingle_set

PERCENT = 80
WIDTH = 5
# below this size every shingle is a segment of its own
SINGLE = 48
SEGMENT_LOAD = 1.5
DENSE_WORDS = 8
# one document in so many is looked at to guess which keys are frequent; the guess holds so many keys at most
SAMPLE_ONE_IN = 16
GUESSED_KEYS = 1_000_000
# a key that is guessed in more documents than this is dealt with in several parts
HOT_ROWS = 200_000
PARTS = 64
# so many of a document's least keys tell whether a pair meets in a lesser key too
LOW_KEYS = 8
# so many documents are compared with one other by one task
PAIRS_AT_ONCE = 2_000


def most_apart(s: int, t: int, percent: int = PERCENT) -> int:
    """Greatest symmetric difference of linked sets of these sizes."""
    return (s + t) * (100 - percent) // (100 + percent)


def band_of(size: int) -> int:
    """Segments of the sketch for a larger document of this size; 0 for one per shingle."""
    return 0 if size < SINGLE else 1 << int(np.log2(size / SEGMENT_LOAD))


def band_top(band: int) -> int:
    """Greatest size of a band."""
    return SINGLE - 1 if band == 0 else int(2 * band * SEGMENT_LOAD) - 1


def dense_words(size: int) -> int:
    """Words of the dense sketch of a set: a power of two, so that sketches of linked sets differ in length by one fold at
    most, and long enough for sets of that size that have little in common to differ in more bits than linked ones may."""
    return max(DENSE_WORDS, 1 << max(0, -(-size // 64) - 1).bit_length())


class ShingleSet:
    """A document's set as spots in the sketch, in two independent scrambles of the shingles' hashes."""

    def __init__(self, shingles: np.ndarray):
        self.size = len(shingles)
        self.spots = mix(shingles, 2)
        self.bits = mix(self.spots, 3)

    def digests(self) -> tuple[int, int]:
        """Two digests that equal sets share; 0 for the empty set."""
        if not self.size:
            return 0, 0
        both = np.array([np.bitwise_xor.reduce(self.bits), np.sum(self.spots, dtype=U)], dtype=U)
        return tuple(mix(both, self.size).view(np.int64).tolist())

    def dense(self) -> np.ndarray:
        """Parity of the spots folded to as many bits as there are shingles, DENSE_WORDS * 64 at least."""
        width = dense_words(self.size) * 64
        counts = np.bincount((self.spots >> U(40)).astype(np.int64) % width, minlength=width)
        return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def segment_keys(shingles: ShingleSet, band: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the non-empty segments, and the numbers of these segments."""
    if band == 0:
        return shingles.bits, shingles.spots
    segments = shingles.spots & U(band - 1)
    order = np.argsort(segments)
    segments = segments[order]
    starts = np.flatnonzero(segments[1:] != segments[:-1]) + 1
    starts = np.concatenate([[0], starts])
    # a bit set twice is not set: digests of bits cancel in the same way
    digests = np.bitwise_xor.reduceat(shingles.bits[order], starts)
    held = segments[starts]
    if not digests.all():
        held, digests = held[digests != 0], digests[digests != 0]
    # the bits of a segment tell its number; the band is told apart by the salt
    return mix(digests, band), held


def empty_keys(held: np.ndarray, band: int) -> np.ndarray:
    """Keys of the empty segments."""
    return mix(np.setdiff1d(np.arange(band, dtype=U), held) + (U(band) << U(32)), 6)


class Guess:
    """Frequencies of keys guessed from a sample: key and number of sampled documents, in the order of the keys."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], counts[order]

    def of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)

    def rarest(self, keys: np.ndarray, wanted: int) -> np.ndarray:
        """The first keys by guessed frequency, then by value."""
        counts = self.of(keys)
        if not counts.any():
            return np.partition(keys, wanted - 1)[:wanted]
        return keys[np.lexsort((keys, counts))[:wanted]]


def document_keys(shingles: ShingleSet, guess: Guess, percent: int = PERCENT) -> np.ndarray:
    """The keys a document is found by, over the bands its partners may make it enter."""
    size = shingles.size
    if not size:
        return np.zeros(0, dtype=U)
    largest = size * 100 // percent
    chosen = []
    for band in dict.fromkeys((band_of(size), band_of(largest))):
        # in its own band a document may be the larger one of a pair, in a higher one it is the smaller
        needed = most_apart(size, min(largest, band_top(band)), percent) + 1
        keys, held = segment_keys(shingles, band)
        if len(keys) >= needed:
            chosen.append(guess.rarest(keys, needed))
        else:
            # too few for the guarantee: all of them, and the empty segments for a partner in the same case
            chosen += [keys, empty_keys(held, band)]
    return np.concatenate(chosen)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*rows, np.zeros(0, dtype=np.int64)])))


def _sets(batches: Iterator[pa.RecordBatch], text: str, width: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        for piece in pieces(batch, text):
            yield piece, [shingle_set(t, width) for t in texts_of(piece, text)]


def _guess(texts: DataFrame, width: int, percent: int) -> Guess:
    """Look at one document in SAMPLE_ONE_IN, chosen by a digest of its text."""
    sample = texts.where(F.pmod(F.xxhash64("_text"), F.lit(SAMPLE_ONE_IN)) == 0)

    def run(batches):
        for _, sets in _sets(batches, "_text", width):
            found = [np.zeros(0, dtype=U)]
            for shingles in map(ShingleSet, sets):
                if shingles.size:
                    bands = dict.fromkeys((band_of(shingles.size), band_of(shingles.size * 100 // percent)))
                    found += [segment_keys(shingles, band)[0] for band in bands]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(found)))], names=["key"])

    counts = map_batches(sample.select("_text"), run, "key long").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    rows = counts.where(F.col("n") >= 3).orderBy(F.desc("n"), "key").limit(GUESSED_KEYS).toArrow()
    keys = rows.column("key").to_numpy().astype(np.int64).view(U)
    return Guess(keys, rows.column("n").to_numpy().astype(np.int64))


def _profiles(texts: DataFrame, width: int) -> DataFrame:
    """``_id, _t, n, h, g, sketch`` of every document: digest of its text, its set's size, two digests of the set, and
    its dense sketch."""

    def run(batches):
        for piece, sets in _sets(batches, "_text", width):
            sets = [ShingleSet(s) for s in sets]
            digests = [s.digests() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("_id"),
                    piece.column("_t"),
                    pa.array([s.size for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    _lists([s.dense() for s in sets]),
                ],
                names=["_id", "_t", "n", "h", "g", "sketch"],
            )

    return map_batches(texts, run, "_id long, _t long, n long, h long, g long, sketch array<long>")


def _keyed(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``key, part, h``: the keys of every document; frequent ones are divided by document."""
    shared = texts.sparkSession.sparkContext.broadcast(_guess(texts, width, percent))

    def run(batches):
        guess = shared.value
        for _, sets in _sets(batches, "_text", width):
            sets = [s for s in map(ShingleSet, sets) if s.size]
            keys = [document_keys(s, guess, percent) for s in sets]
            hot = [k[guess.of(k) * SAMPLE_ONE_IN > HOT_ROWS] for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([s.digests()[0] for s in sets], pa.int64()),
                    _lists([_signed(k) for k in keys]),
                    _lists([_signed(k) for k in hot]),
                ],
                names=["h", "keys", "hot"],
            )

    rows = map_batches(texts, run, "h long, keys array<long>, hot array<long>")
    part = F.when(F.array_contains("hot", F.col("key")), F.pmod("h", F.lit(PARTS)) + 1).otherwise(0)
    return rows.select("h", "hot", F.explode("keys").alias("key")).select("key", part.cast("int").alias("part"), "h")


def _hang_together(keyed: DataFrame) -> DataFrame:
    """``key, part, h`` -> ``key, lead, h``: every document after the first of its key and part hangs from it.

    The rows are sorted by Spark, which spills, and read as a stream; nothing of a key but its first document is kept.
    """

    def run(batches):
        last = (None, None, None)  # key, part, lead
        for batch in batches:
            key, part, h = (batch.column(i).to_numpy() for i in range(3))
            if not len(key):
                continue
            new = np.empty(len(key), dtype=bool)
            new[0] = (key[0], part[0]) != last[:2]
            new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))
            lead = np.where(start >= 0, h[np.maximum(start, 0)], h[0] if last[2] is None else last[2])
            hung = lead != h
            # the first one of each part of a divided key hangs from the others in a second step
            first = new & (part > 0)
            last = (key[-1], part[-1], lead[-1])
            rows = hung | first
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[rows]), pa.array(lead[rows]), pa.array(h[rows])], names=["key", "lead", "h"]
            )

    sorted_rows = keyed.repartition(F.col("key"), F.col("part")).sortWithinPartitions("key", "part", "h")
    return map_batches(sorted_rows, run, "key long, lead long, h long")


def _verified(pairs: DataFrame, profiles: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``lead, h, apart, linked`` of pairs of classes that the dense sketch does not rule out already."""
    left = profiles.select(F.col("h").alias("lead"), F.col("n").alias("_n1"), F.col("sketch").alias("_s1"))
    right = profiles.select("h", F.col("n").alias("_n2"), F.col("sketch").alias("_s2"))
    sized = pairs.join(left, "lead").join(right, "h")
    # the sizes come first, so that only sketches of sets of like size are held against each other
    near = sized.where(_may_link("_n1", "_n2", percent)).where(_within(_hamming("_s1", "_s2"), "_n1", "_n2", percent))
    near = written(near.select("lead", "h", "_n1", "_n2"), "candidates")

    # each document goes to the first one it hangs from; a first one with many is sent to several parts
    parts = near.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / PAIRS_AT_ONCE).cast("bigint").alias("_parts"))
    part = F.pmod(F.xxhash64("h"), F.col("_parts"))
    partners = near.join(parts, "lead").select("h", "lead", part.alias("part"), F.lit(1).alias("role"))
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1))
    leads = parts.select(F.col("lead").alias("h"), "lead", every.alias("part"), F.lit(0).alias("role"))
    homes = partners.unionByName(leads).join(profiles.select("h", "_t", "_id"), "h")
    homes = written(homes.withColumnRenamed("_id", "_owner"), "homes")
    same = texts["_t"].eqNullSafe(homes["_t"]) & texts["_id"].eqNullSafe(homes["_owner"])
    sent = texts.join(F.broadcast(homes) if fits_broadcast(homes) else homes, same)
    sent = sent.select("lead", "part", "role", "h", "_text").repartition(F.col("lead"), F.col("part"))
    return map_batches(
        sent.sortWithinPartitions("lead", "part", "role", "h"),
        _compare_runs(width, percent),
        "lead long, h long, apart long, linked boolean",
    ).distinct()


def _compare_runs(width: int, percent: int):
    """Verify runs of rows that begin with the first document, whose set alone is kept."""

    def run(batches):
        lead, held = None, None
        for batch in batches:
            for piece, sets in _sets([batch], "_text", width):
                out = []
                columns = (piece.column(c).to_pylist() for c in ("lead", "part", "role", "h"))
                for key, part, role, h, shingles in zip(*columns, sets, strict=True):
                    # of texts with one digest, the one that the class was made from
                    if ShingleSet(shingles).digests()[0] != h:
                        continue
                    if role == 0:
                        lead, held = (key, part), shingles
                    elif lead == (key, part):
                        common = len(np.intersect1d(held, shingles, assume_unique=True))
                        union = len(held) + len(shingles) - common
                        out.append((key, h, union - common, 100 * common >= percent * union))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                    names=["lead", "h", "apart", "linked"],
                )

    return run


def _within(apart: Column, n1: str, n2: str, percent: int) -> Column:
    """Whether a symmetric difference leaves sets of these sizes similar enough."""
    return apart * (100 + percent) <= (F.col(n1) + F.col(n2)) * (100 - percent)


def _may_link(n1: str, n2: str, percent: int) -> Column:
    return F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent


def _hamming(a: str, b: str) -> Column:
    """Bits that differ in two dense sketches; the longer one is folded to the length of the other, which is half of its own."""
    words = F.least(F.size(a), F.size(b))

    def folded(s: str) -> Column:
        halves = F.transform(F.slice(s, F.lit(1), words), lambda x, i: x.bitwiseXOR(F.get(s, i + words)))
        return F.when(F.size(s) > words, halves).otherwise(F.col(s))

    differing = F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(differing, F.lit(0), lambda n, x: n + x)


def jaccard_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, width: int = WIDTH
) -> DataFrame:
    """``_id, _t, n_shingles, component_id`` for every row of ``docs``: id and digest of its text, the size of its set,
    and the least doc_id that links lead to."""
    texts = docs.select(F.col(doc_id).cast("bigint").alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_t"))
    found = written(_profiles(texts, width), "profiles")

    # one document per set goes on
    classes = found.where(F.col("n") > 0).groupBy("h", "g").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    classes = written(classes, "classes")
    copies = found.where(F.col("n") > 0).select("_id", "_t", "h", "g").join(
        classes.where(F.col("_rows") > 1).select(F.col("h").alias("_h"), F.col("g").alias("_g"), "_first"),
        (F.col("h") == F.col("_h")) & (F.col("g") == F.col("_g")) & (F.col("_id") != F.col("_first")),
    )
    copies = written(copies.select("_id", "_t", "h").distinct(), "copies")
    drop = F.broadcast(copies) if fits_broadcast(copies) else copies
    single = found.where(F.col("n") > 0).join(drop, ["_id", "h"], "left_anti")

    hung = written(_hang_together(_keyed(texts.join(drop, ["_id", "_t"], "left_anti"), width, percent)), "hung")
    # first documents of the parts of a divided key
    heads = hung.where(F.col("lead") == F.col("h")).groupBy("key").agg(F.min("h").alias("_lead"))
    tops = hung.where(F.col("lead") == F.col("h")).join(heads, "key").where(F.col("h") != F.col("_lead"))
    shared = hung.where(F.col("lead") != F.col("h")).unionByName(tops.select("key", F.col("_lead").alias("lead"), "h"))

    profiles = written(single.select("_id", "_t", "h", "n", "sketch").dropDuplicates(["h"]), "sketches")
    pairs = shared.select("lead", "h").distinct()
    checked = written(_verified(pairs, profiles, texts, width, percent), "checked")
    links = checked.where("linked").select(F.col("lead").alias("a"), F.col("h").alias("b"))
    groups = written(connected_components(links), "groups")

    more = _across(shared, checked, groups, profiles, texts, width, percent)
    if not more.isEmpty():
        groups = written(connected_components(links.unionByName(more)), "groups")

    label = classes.join(groups.select(F.col("node").alias("h"), "component"), "h", "left")
    label = label.select("h", "g", F.coalesce(F.col("component").cast("string"), _class("h", "g")).alias("_group"), "_first", "_rows")
    least = label.groupBy("_group").agg(F.min("_first").alias("component_id"), F.sum("_rows").alias("_size"))
    named = label.join(least.where(F.col("_size") > 1), "_group").select(_class("h", "g").alias("_class"), "component_id")
    narrow = found.select("_id", "_t", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, _class("h", "g")).alias("_class"))
    joined = lookup_join(narrow, written(named, "named"), "_class", "left", spread_by="_id")
    return joined.select("_id", "_t", "n_shingles", F.coalesce("component_id", "_id").alias("component_id"))


def _class(h: str, g: str) -> Column:
    return F.concat(F.hex(h), F.lit("-"), F.hex(g))


def _across(shared, checked, groups, profiles, texts, width: int, percent: int) -> DataFrame:
    """Links between documents that share a key, are in different groups and have not been compared: both hang from
    the same first document, and at least one of them is not linked with it."""
    group = groups.select(F.col("node").alias("h"), F.col("component").alias("_group"))
    # a pair that failed, or that size or sketch ruled out, leaves its document open in all keys the two share
    compared = written(shared.select("lead", "h").distinct(), "compared")
    failed = compared.join(checked.where("linked"), ["lead", "h"], "left_anti")
    open_keys = written(shared.join(failed, ["lead", "h"]).select("key").distinct(), "open-keys")
    hung = shared.join(open_keys, "key", "left_semi").join(checked.select("lead", "h", "apart"), ["lead", "h"], "left")
    leads = hung.select("lead", F.col("lead").alias("h"), "key", F.lit(0).cast("bigint").alias("apart")).distinct()
    known = hung.select("lead", "h", "key", "apart").unionByName(leads)
    known = known.join(group, "h", "left").join(profiles.select("h", "n", "sketch"), "h")
    # a document has as many keys as its size calls for, so this list is bounded by its text
    lows = known.groupBy("h").agg(F.slice(F.array_sort(F.collect_set("key")), 1, LOW_KEYS).alias("lows"))
    known = known.join(lows, "h")
    known = written(known.withColumn("_group", F.coalesce("_group", "h")), "open")
    columns = ("lead", "h", "n", "sketch", "_group", "apart", "lows")
    a, b = (known.select("key", *[F.col(c).alias(f"{c}{side}") for c in columns]) for side in (1, 2))
    # a pair that meets in a lesser key as well is left to that one: near copies share most of their keys
    elsewhere = F.exists("lows1", lambda k: (k < F.col("key")) & F.array_contains(F.col("lows2"), k))
    # two distances from the same document bound the one between them
    least_apart = F.when(F.col("lead1") == F.col("lead2"), F.abs(F.col("apart1") - F.col("apart2")))
    near = (
        a.join(b, "key")
        .where((F.col("h1") < F.col("h2")) & (F.col("_group1") != F.col("_group2")) & _may_link("n1", "n2", percent))
        .where(_within(F.coalesce(least_apart, F.lit(0)), "n1", "n2", percent))
        .where(~elsewhere)
        .where(_within(_hamming("sketch1", "sketch2"), "n1", "n2", percent))
    )
    pairs = near.select(F.col("h1").alias("lead"), F.col("h2").alias("h")).distinct()
    pairs = written(pairs.join(compared, ["lead", "h"], "left_anti"), "across")
    found = _verified(pairs, profiles, texts, width, percent)
    return written(found.where("linked").select(F.col("lead").alias("a"), F.col("h").alias("b")), "across-links")


def keep_one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without those that link to one with a lesser doc_id. Documents stay where they are; what is to be
    dropped is sent to them while it fits, else joined. Of rows repeated with id and text one stays."""
    verdicts = jaccard_components(docs, doc_id, text, **options)
    known = F.col("component_id").isNotNull()
    losing = known & (F.col("_id").isNull() | (F.col("component_id") < F.col("_id")))
    losers = verdicts.where(losing).select(F.coalesce("_id", F.lit(-1)).alias("__near_id"), F.col("_id").isNull().alias("__near_none"), F.col("_t").alias("__near_text"))
    losers = written(losers.distinct(), "losers")
    id_of = F.col(doc_id).cast("bigint")
    keyed = docs.withColumns({"__near_id": F.coalesce(id_of, F.lit(-1)), "__near_none": id_of.isNull(), "__near_text": F.xxhash64(text)})
    side = F.broadcast(losers) if fits_broadcast(losers) else losers
    kept = keyed.join(side, ["__near_id", "__near_none", "__near_text"], "left_anti")
    repeated = kept.groupBy("__near_id", "__near_none").agg(F.count(F.lit(1)).alias("__near_rows")).where(F.col("__near_rows") > 1)
    repeated = written(repeated.select("__near_id", "__near_none"), "repeated-ids")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    few = F.broadcast(repeated) if fits_broadcast(repeated) else repeated
    once = kept.join(few, ["__near_id", "__near_none"], "left_semi").dropDuplicates(["__near_id", "__near_none", "__near_text"])
    rest = kept.join(few, ["__near_id", "__near_none"], "left_anti")
    return rest.select(*docs.columns).unionByName(once.select(*docs.columns))
