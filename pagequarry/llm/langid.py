"""Language identification by compression with per-language dictionaries.

For each language a bounded sample of labelled text becomes a raw-content dictionary for zstandard. A text is
compressed with each of them, block by block so that the dictionary counts for the whole length, and the language
whose dictionary leaves the fewest bytes wins. The margin to the second decides whether the answer is accepted.

The sample is the ``SAMPLE_DOCS`` labelled documents of each language with the least hash of their id, the first
``SAMPLE_CHARS`` characters of each; so the model has ``SAMPLE_DOCS * SAMPLE_CHARS`` characters per language at most,
however long the table is. Everything else reads whole texts of all documents.

Edge cases: a null text and one without a letter are ``und`` with score 0 and not accepted; rows with null language
or null id are never learned from; equal sizes go to the least language name; with no labelled row at all every text is
``und``; a column named like an output is replaced, other columns pass through; an empty table gives an empty result.
"""

import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import add_columns, texts_of
from .bpe import character_classes, set_of

SAMPLE_DOCS = 150
SAMPLE_CHARS = 1_200
FOLDS = 5
BLOCK = 2_048
LEVEL = 6
MARGIN = 0.002
UNDETERMINED = "und"

@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """What is neither a letter nor a mark on one, and a letter."""
    table, _ = character_classes()
    marked = bytes(table[c] or unicodedata.category(chr(c))[0] == "M" for c in range(len(table)))
    return re.compile(f"[^{set_of(marked)}]+"), re.compile(f"[{set_of(table)}]")


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """Whether a document is kept away from training; one without an id is."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def letters(text: str) -> str:
    """Lower-cased words of letters with their marks, without numbers and signs, one space between them; empty without a
    letter."""
    others, letter = _patterns()
    return others.sub(" ", text.lower()).strip() if letter.search(text) else ""


@dataclass(frozen=True)
class Model:
    """Dictionary content by language; at most SAMPLE_DOCS * SAMPLE_CHARS characters each."""

    samples: tuple[tuple[str, bytes], ...]


@lru_cache(maxsize=2)
def _compressors(model: Model) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, sample in model.samples:
        content = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False)))
    return made


def classify(text: str, model: Model) -> tuple[str, float]:
    """Language and margin (0 to 1) of one whole text."""
    plain = letters(text)
    if not plain or not model.samples:
        return UNDETERMINED, 0.0
    data = f" {plain} ".encode()
    blocks = [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)]
    sizes = sorted((sum(len(c.compress(b)) for b in blocks), lang) for lang, c in _compressors(model))
    if len(sizes) == 1:
        return sizes[0][1], 1.0
    return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model:
    """Learn the dictionaries from documents with a language, held-out ones excepted.

    The ids are chosen on narrow columns with a per-task cut, then the few chosen texts are read.
    """
    labelled = docs.select(F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(text).alias("_text"))
    usable = labelled.where(F.col("_lang").isNotNull() & ~held_out("_id"))
    first = W.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id")
    ids = (
        usable.select("_id", "_lang")
        .withColumn("_place", F.row_number().over(first))
        .where(F.col("_place") <= SAMPLE_DOCS)
        .select("_id", "_lang")
        .collect()
    )
    if not ids:
        return Model(())
    chosen = usable.where(F.col("_id").isin(sorted({r["_id"] for r in ids})) & F.col("_text").isNotNull())
    rows = chosen.select("_lang", "_id", F.left("_text", F.lit(SAMPLE_CHARS)).alias("_text")).distinct()
    by_lang: dict[str, list] = {}
    for row in rows.orderBy("_lang", F.xxhash64("_id"), "_id", "_text").limit(SAMPLE_DOCS * 1_000).collect():
        plain = letters(row["_text"])
        if plain:
            by_lang.setdefault(row["_lang"], []).append(plain)
    # what stands last in a dictionary is cheapest to refer to; the order is that of the hash
    return Model(tuple((name, " ".join(parts).encode()) for name, parts in sorted(by_lang.items())))


def identify(docs: DataFrame, model: Model, text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add ``lang_pred``, ``score`` (the margin) and ``accepted`` (margin not below ``margin``). No shuffle."""

    def make(batch):
        found = [classify(t, model) for t in texts_of(batch, text)]
        return {
            "lang_pred": pa.array([lang for lang, _ in found], pa.string()),
            "score": pa.array([score for _, score in found], pa.float64()),
            "accepted": pa.array([lang != UNDETERMINED and score >= margin for lang, score in found], pa.bool_()),
        }

    added = {"lang_pred": T.StringType(), "score": T.DoubleType(), "accepted": T.BooleanType()}
    return add_columns(docs, text, added, make)
