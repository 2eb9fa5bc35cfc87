"""SentencePiece models of the merge type: encoding by one pass over the prefixes of a text, and decoding.

Such a model joins neighbouring symbols whose joined text is a piece, the best score first and of equal ones the leftmost.
What it makes of a text depends on that text alone, so every prefix has one encoding and one last token. An automaton
reports the pieces that end at a character; the last token is the one of them that may stand behind the last token of the
prefix before it, that is, whose joined text merges back into just these two. Only one can. The tokens stored per prefix are
followed back from the end. This holds for any scores: merges inside a span of tokens never depend on what lies outside it
as long as nothing joins across its edges. A pair is tested once by merging and remembered.

Where no piece holds two characters side by side, nothing ever joins across them. Texts are cut at such places and the parts,
mostly words, are remembered; what the pieces do not allow to be cut is encoded whole, in the same way.

Edge cases: a null text is the empty text, which has the begin and end ids only; spelled-out control pieces are ordinary
text; characters the model does not know become their UTF-8 bytes; U+2581 reads as a space, so it decodes to one; all other
columns pass through, and columns named like an output are replaced; an empty table gives an empty one.
"""

import codecs
import gc
import hashlib
import itertools
import re
import struct
from collections.abc import Collection, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import add_columns, texts_of
from .bpe import Kept, KeptTexts, read_spec

SPACE = "▁"
UNKNOWN = -1
KEPT_PARTS = 150_000
KEPT_PAIRS = 400_000
# Field numbers and kinds of the model file.
PIECE, TRAINER, NORMALIZER = 1, 2, 3
TEXT, SCORE, KIND = 1, 2, 3
NORMAL, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 3, 4, 5, 6
MODEL_TYPE, WHITESPACE_AS_SUFFIX, UNKNOWN_SURFACE, BEGIN_PIECE, END_PIECE = 3, 24, 44, 46, 47
CHARACTER_MAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
MERGING = 2


def _one_by_one(error: UnicodeDecodeError):
    """Each byte that belongs to no character becomes a replacement character of its own."""
    return "�", error.start + 1


codecs.register_error("pagequarry-byte", _one_by_one)


def read_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a protocol buffer message: number and value; numbers as unsigned integers, the rest as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        field, wire = divmod(varint(), 8)
        if wire == 0:
            yield field, varint()
            continue
        size = varint() if wire == 2 else {1: 8, 5: 4}[wire]
        yield field, data[at : at + size]
        at += size


def parts_pattern(pieces: Collection[str], last: int = 0x10FFFF) -> re.Pattern:
    """How a text of characters up to ``last`` may be cut into parts that nothing joins across, which follows from the pieces:
    before spaces, around line ends, and between letters and other characters. A place where some piece runs across is
    left whole."""
    letters = {c for piece in pieces for c in piece if c.isalpha()}
    inside = {pair for piece in pieces for pair in itertools.pairwise(piece)}
    if any(b == SPACE != a for a, b in inside):
        return re.compile("(?s).+")
    alone = "" if any("\n" in pair for pair in inside) else "\n"
    if any((a in letters) != (b in letters) for a, b in inside if SPACE not in (a, b)):
        bodies = f"[^ {alone}]+"
    else:
        known = "".join(re.escape(c) for c in sorted(letters) if ord(c) <= last)
        bodies = f"(?:[{known}]+|[^{known} {alone}]+)" if known else f"[^ {alone}]+"
    return re.compile(f" *{bodies}| +" + (f"|{alone}" if alone else ""))


class PieceModel:
    """Encoder and decoder of a model file's content. Models it would encode otherwise than the library are refused."""

    def __init__(self, spec: bytes):
        message = list(read_fields(spec))
        rows = [dict(read_fields(value)) for field, value in message if field == PIECE]
        trainer = dict(read_fields(next((v for f, v in message if f == TRAINER), b"")))
        normalizer = dict(read_fields(next((v for f, v in message if f == NORMALIZER), b"")))
        texts = [row[TEXT].decode() for row in rows]
        kinds = [row.get(KIND, NORMAL) for row in rows]
        sound = (
            trainer.get(MODEL_TYPE) == MERGING
            and not trainer.get(WHITESPACE_AS_SUFFIX)
            and not normalizer.get(CHARACTER_MAP)
            and normalizer.get(REMOVE_SPACES, 1) == 0
            and normalizer.get(ESCAPE_SPACES, 1) == 1
            and kinds.count(BYTE) == 256
            and USER_DEFINED not in kinds
            and UNUSED not in kinds
        )
        if not sound:
            raise ValueError("only merge-type models with byte pieces and texts taken as they are")
        self.prefix = SPACE if normalizer.get(DUMMY_PREFIX, 1) else ""
        numbers = {text: i for i, text in enumerate(texts)}
        self.begin = numbers[trainer.get(BEGIN_PIECE, b"<s>").decode()]
        self.end = numbers[trainer.get(END_PIECE, b"</s>").decode()]
        unknown = trainer.get(UNKNOWN_SURFACE, " ⁇ ".encode())
        self.texts, self.size = texts, len(texts)
        self.byte_ids = np.zeros(256, dtype="<u4")
        self.starts_with_space = np.zeros(self.size, dtype=bool)
        self.visible = np.array([k != CONTROL for k in kinds])
        self.bytes_of = np.full(self.size, b"", dtype=object)
        self.rank: dict[str, float] = {}
        for i, (text, kind) in enumerate(zip(texts, kinds, strict=True)):
            if kind == BYTE:
                self.byte_ids[int(text[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(text[3:5], 16)])
            elif kind == NORMAL:
                self.rank[text] = -struct.unpack("<f", rows[i].get(SCORE, bytes(4)))[0]
                self.bytes_of[i] = text.replace(SPACE, " ").encode()
                self.starts_with_space[i] = text.startswith(SPACE)
            elif kind != CONTROL:
                self.bytes_of[i] = unknown
        self.automaton = ahocorasick.Automaton()
        for text in self.rank:
            # a piece that merging its own characters does not arrive at is nobody's last token
            if len(text) == 1 or self.merged(text) == [text]:
                self.automaton.add_word(text, (numbers[text], len(text)))
        self.automaton.make_automaton()
        self.compatible = Kept(self._pair, KEPT_PAIRS)
        self.parts = KeptTexts(lambda part: self.encode_part(part.replace(" ", SPACE)), KEPT_PARTS)
        self.cut, self.latin = parts_pattern(self.rank), parts_pattern(self.rank, 0xFF)

    def merged(self, text: str) -> list[str]:
        """Symbols of a short text after all merges, done one by one."""
        symbols, rank = list(text), self.rank
        while len(symbols) > 1:
            best, at = None, 0
            for i in range(len(symbols) - 1):
                found = rank.get(symbols[i] + symbols[i + 1])
                if found is not None and (best is None or found < best):
                    best, at = found, i
            if best is None:
                break
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return symbols

    def _pair(self, pair: int) -> bool:
        left, right = divmod(pair, self.size)
        return self.merged(self.texts[left] + self.texts[right]) == [self.texts[left], self.texts[right]]

    def encode_part(self, part: str) -> bytes:
        """Ids of one part as unsigned 32-bit integers."""
        last, length = [UNKNOWN] * len(part), [1] * len(part)
        compatible, size = self.compatible, self.size
        for end, (token, span) in self.automaton.iter(part):
            if last[end] != UNKNOWN:
                continue
            start = end - span
            # nothing joins with a character the model does not know
            if start < 0 or last[start] == UNKNOWN or compatible[last[start] * size + token]:
                last[end], length[end] = token, span
        found, at = [], len(part) - 1
        while at >= 0:
            if last[at] == UNKNOWN:
                found += self.byte_ids[list(reversed(part[at].encode()))].tolist()
            else:
                found.append(last[at])
            at -= length[at]
        found.reverse()
        return struct.pack(f"<{len(found)}I", *found)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, without begin and end, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        # a space and its stand-in are one to the model
        text = self.prefix.replace(SPACE, " ") + text.replace(SPACE, " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(map(self.parts.__getitem__, self.cut.findall(text)))
        return b"".join(map(self.parts.__getitem__, self.latin.findall(text)))

    def framed(self, text: str) -> bytes:
        """Ids of a whole text between the begin and end ids."""
        return struct.pack("<I", self.begin) + self.encode(text) + struct.pack("<I", self.end)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: control ids show nothing, the space put before the first piece goes."""
        raw = b"".join(self.bytes_of[ids].tolist())
        shown = ids[self.visible[ids]]
        if self.prefix and len(shown) and self.starts_with_space[shown[0]]:
            raw = raw[1:]
        return raw.decode("utf-8", errors="pagequarry-byte")


@lru_cache(maxsize=2)
def piece_model(spec: bytes) -> PieceModel:
    """The model of a file's content, built once per Python worker."""
    built = PieceModel(spec)
    gc.freeze()
    return built


def _lists(rows: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int): begin, the tokens of each whole text, end. No shuffle."""
    spec = read_spec(path)

    def make(batch):
        model = piece_model(spec)
        return {ids: _lists([model.framed(t) for t in texts_of(batch, text)])}

    return add_columns(docs, text, {ids: T.ArrayType(T.IntegerType())}, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of an array of ids; null is no ids. No shuffle."""
    spec = read_spec(path)

    def make(batch):
        model = piece_model(spec)
        rows = batch.column(ids).to_pylist()
        return {out: pa.array([model.decode(np.array(r or [], dtype="int64")) for r in rows], pa.string())}

    return add_columns(encoded, None, {out: T.StringType()}, make)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", outputs: Collection[str] = ("ids", "decoded"), keep_text: bool = True
) -> DataFrame:
    """Encode and decode each whole text in one pass: adds ``n_tokens`` (all ids), ``ids_sha256``, ``decoded_sha256`` and,
    of ``ids`` and ``decoded``, those in ``outputs``. Without ``keep_text`` the text does not come back from the tasks."""
    spec = read_spec(path)
    added = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    added |= {"ids": T.ArrayType(T.IntegerType())} if "ids" in outputs else {}
    added |= {"decoded": T.StringType()} if "decoded" in outputs else {}

    def make(batch):
        model = piece_model(spec)
        encoded = [model.framed(value) for value in texts_of(batch, text)]
        decoded = [model.decode(np.frombuffer(row, dtype="<u4")) for row in encoded]
        columns = {
            "n_tokens": pa.array([len(r) // 4 for r in encoded], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in encoded], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
        }
        if "ids" in outputs:
            columns["ids"] = _lists(encoded)
        if "decoded" in outputs:
            columns["decoded"] = pa.array(decoded, pa.string())
        return columns

    return add_columns(docs, text, added, make, () if keep_text else (text,))
