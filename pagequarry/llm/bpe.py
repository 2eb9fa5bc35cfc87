"""Byte-pair encoding by one pass over the prefixes of each pre-token, and decoding.

Every prefix of a byte string has exactly one encoding, hence exactly one last token. Going from left to right, an
automaton reports all vocabulary tokens that end at the current byte. The last token of the prefix is the one that
may stand behind the last token of the prefix before it: two tokens may be neighbours when plain merging of their
joined bytes would leave just these two. Following the stored tokens back from the end gives the ids. The time is
linear in the length of the pre-token, so a word of a megabyte costs no more per byte than a short one.

Edge cases: a null text is the empty text (no ids, empty decoded text); special tokens written out in a text become
their ids, as the tokenizer file says; all other columns pass through, and columns named like an output are replaced.
"""

import gc
import hashlib
import json
import re
import struct
import unicodedata
from collections.abc import Collection
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import add_columns, texts_of

# Fixed value: how byte-level tokenizers of this family cut a text into pre-tokens.
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEVER = 1 << 31
KEPT_PIECES = 150_000
KEPT_PAIRS = 200_000
KEPT_LENGTH = 48


def byte_alphabet() -> dict[str, int]:
    """Visible stand-in characters of the 256 bytes: printable Latin-1 stands for itself, the rest follow from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


# First and last code points of the letters and numbers that Unicode 16 has added.
LETTERS_16 = """
1C89-1C8A A7CB-A7CD A7DA-A7DC 105C0-105F3 10D4A-10D65 10D6F-10D85 10EC2-10EC4 11380-11389 1138B-1138B 1138E-1138E
11390-113B5 113B7-113B7 113D1-113D1 113D3-113D3 11BC0-11BE0 13460-143FA 16100-1611D 16D40-16D6C 18CFF-18CFF 1E5D0-1E5ED
1E5F0-1E5F0
"""
NUMBERS_16 = "10D40-10D49 116D0-116E3 11BF0-11BF9 16130-16139 16D70-16D79 1CCF0-1CCF9 1E5F1-1E5FA"


@lru_cache(maxsize=1)
def character_classes() -> tuple[bytes, bytes]:
    """For every code point, whether it is a letter and whether it is a number in Unicode 16, which the library goes by:
    what Python's table of version 15.1 says, and the additions. White space has not changed."""
    if unicodedata.unidata_version > "16":
        raise ValueError("the character tables of this Python are newer than the tokenizer's")
    letters, numbers = (bytearray(unicodedata.category(chr(c))[0] == kind for c in range(0x110000)) for kind in "LN")
    for table, added in ((letters, LETTERS_16), (numbers, NUMBERS_16)):
        for span in added.split():
            first, last = (int(end, 16) for end in span.split("-"))
            table[first : last + 1] = b"\1" * (last + 1 - first)
    return bytes(letters), bytes(numbers)


def set_of(table: bytes) -> str:
    """Marked code points as the inside of a character class."""
    return "".join(
        rf"\U{m.start():08x}" + (rf"-\U{m.end() - 1:08x}" if len(m[0]) > 1 else "") for m in re.finditer(b"\1+", table)
    )


def pre_token_pattern(last: int = 0x10FFFF) -> re.Pattern:
    """PRE_TOKENS for texts of characters up to ``last``, with the classes written out."""
    letters, numbers = (set_of(table[: last + 1]) for table in character_classes())
    spaces = set_of(bytes(bool(regex.match(r"\s", chr(c))) for c in range(min(last, 0x3000) + 1)))
    pattern = PRE_TOKENS.replace(r"[^\s\p{L}\p{N}]", f"[^{spaces}{letters}{numbers}]")
    pattern = pattern.replace(r"\p{L}", f"[{letters}]").replace(r"\p{N}", f"[{numbers}]")
    return re.compile(pattern.replace(r"(?!\S)", f"(?![^{spaces}])").replace(r"\s", f"[{spaces}]"))


class Kept(dict):
    """Results by key in two generations: when the young one is full it takes the place of the old one, and what is asked
    for again moves back. So a bounded number is kept, and the frequent ones stay. ``make`` fills in what is missing."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.keep(key, value)
        return value

    def keep(self, key, value) -> None:
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value


class KeptTexts(Kept):
    """Only short pieces of text come again often enough to be kept."""

    def keep(self, key, value) -> None:
        if len(key) <= KEPT_LENGTH:
            super().keep(key, value)


class Tokenizer:
    """Encoder and decoder of a byte-level tokenizer file (JSON text)."""

    def __init__(self, spec: str | bytes):
        data = json.loads(spec)
        alphabet = byte_alphabet()
        vocab: dict[str, int] = data["model"]["vocab"]
        plain = {token: bytes(alphabet[c] for c in token) for token in vocab}
        single = {plain[t]: t for t in vocab if len(plain[t]) == 1}
        if len(single) < 256:
            raise ValueError("the vocabulary lacks some of the 256 bytes")
        # tokens are known by their age: the bytes first, then the merges in order
        ages: dict[str, int] = {single[bytes([b])]: b for b in range(256)}
        self.left, self.right = list(range(256)), list(range(256))
        self.ids = [vocab[single[bytes([b])]] for b in range(256)]
        self.joined: dict[tuple[int, int], int] = {}
        self.compatible = Kept(lambda pair: self.neighbours(*divmod(pair, NEVER)), KEPT_PAIRS)
        automaton = ahocorasick.Automaton()
        for b in range(256):
            automaton.add_word(chr(b), (b, 1))
        sound = set(range(256))
        for merge in data["model"]["merges"]:
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            a, b, both = ages[first], ages[second], first + second
            age = len(self.left)
            self.left.append(a)
            self.right.append(b)
            self.ids.append(vocab[both])
            self.joined.setdefault((a, b), age)
            if both in ages:
                continue
            ages[both] = age
            # only a token that merging its own bytes arrives at can be anyone's last token
            if a in sound and b in sound and self.neighbours(a, b, age):
                sound.add(age)
                raw = plain[both]
                automaton.add_word(raw.decode("latin-1"), (age, len(raw)))
        automaton.make_automaton()
        self.automaton = automaton
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens") or []}
        names = sorted(self.special, key=len, reverse=True)
        self.special_pattern = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.bytes_of = np.full(size, b"", dtype=object)
        for token, number in vocab.items():
            self.bytes_of[number] = plain[token]
        for token, number in self.special.items():
            self.bytes_of[number] = token.encode()
        self.pattern, self.latin = pre_token_pattern(), pre_token_pattern(0xFF)
        self.pieces = KeptTexts(lambda piece: self.encode_piece(piece.encode()), KEPT_PIECES)

    def neighbours(self, left: int, right: int, before: int = NEVER) -> bool:
        """Whether merging the bytes of both tokens leaves the two side by side, with only merges older than
        ``before`` at hand. The merges that made them are undone, newest first: if at any time the two parts at the
        seam could have been merged earlier (or as early, and further left), they would have been."""
        until = before
        while True:
            if self.joined.get((left, right), NEVER) < until:
                return False
            if left < 256 and right < 256:
                return True
            if right < 256 or left > right:
                until, left = left, self.right[left]
            else:
                until, right = right + 1, self.left[right]

    def encode_piece(self, piece: bytes) -> bytes:
        """Ids of one pre-token as unsigned 32-bit integers."""
        last = [-1] * len(piece)
        size = [0] * len(piece)
        compatible = self.compatible
        for end, (token, length) in self.automaton.iter(piece.decode("latin-1")):
            if last[end] >= 0:
                continue
            start = end - length
            if start < 0 or compatible[last[start] * NEVER + token]:
                last[end], size[end] = token, length
        ids, found, at = self.ids, [], len(last) - 1
        while at >= 0:
            found.append(ids[last[at]])
            at -= size[at]
        found.reverse()
        return struct.pack(f"<{len(found)}I", *found)

    def split(self, text: str) -> list[str]:
        """Pre-tokens of a text without special tokens."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.pattern.findall(text)
        return self.latin.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if self.special_pattern is None or not self.special_pattern.search(text):
            return b"".join(map(self.pieces.__getitem__, self.split(text)))
        parts = []
        for i, part in enumerate(self.special_pattern.split(text)):
            if i % 2:
                parts.append(self.special[part].to_bytes(4, "little"))
            else:
                parts += map(self.pieces.__getitem__, self.split(part))
        return b"".join(parts)

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids; bytes that are no UTF-8 become the replacement character."""
        return b"".join(self.bytes_of[ids].tolist()).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def tokenizer(spec: bytes) -> Tokenizer:
    """The tokenizer of a file's content, built once per Python worker."""
    built = Tokenizer(spec)
    gc.freeze()  # the tables stay, so the collector need not walk them again and again
    return built


def read_spec(path: str) -> bytes:
    """A tokenizer file, read by the driver and sent to the tasks (a vocabulary has a few megabytes at most)."""
    with open(path, "rb") as file:
        return file.read()


def _lists(rows: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), dtype="<i4")))


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add ``ids`` (array of int): the tokens of each whole text. No shuffle."""
    spec = read_spec(path)

    def make(batch):
        encoder = tokenizer(spec)
        return {ids: _lists([encoder.encode(t) for t in texts_of(batch, text)])}

    return add_columns(docs, text, {ids: T.ArrayType(T.IntegerType())}, make)


def decode(encoded: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add ``out``: the text of an array of ids; null is no ids. No shuffle."""
    spec = read_spec(path)

    def make(batch):
        decoder = tokenizer(spec)
        rows = batch.column(ids).to_pylist()
        return {out: pa.array([decoder.decode(np.array(r or [], dtype="int64")) for r in rows], pa.string())}

    return add_columns(encoded, None, {out: T.StringType()}, make)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", outputs: Collection[str] = ("ids", "decoded"), keep_text: bool = True
) -> DataFrame:
    """Encode and decode each whole text in one pass: adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, of
    ``ids`` and ``decoded``, those in ``outputs``. Without ``keep_text`` the text does not come back from the tasks."""
    spec = read_spec(path)
    added = {"n_tokens": T.LongType(), "ids_sha256": T.StringType(), "decoded_sha256": T.StringType()}
    added |= {"ids": T.ArrayType(T.IntegerType())} if "ids" in outputs else {}
    added |= {"decoded": T.StringType()} if "decoded" in outputs else {}

    def make(batch):
        coder = tokenizer(spec)
        encoded, digests, decoded = [], [], []
        for value in texts_of(batch, text):
            ids = coder.encode(value)
            again = coder.decode(np.frombuffer(ids, dtype="<u4"))
            encoded.append(ids)
            digests.append(hashlib.sha256(again.encode()).hexdigest())
            if "decoded" in outputs:
                decoded.append(again)
        columns = {
            "n_tokens": pa.array([len(r) // 4 for r in encoded], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(r).hexdigest() for r in encoded], pa.string()),
            "decoded_sha256": pa.array(digests, pa.string()),
        }
        if "ids" in outputs:
            columns["ids"] = _lists(encoded)
        if "decoded" in outputs:
            columns["decoded"] = pa.array(decoded, pa.string())
        return columns

    return add_columns(docs, text, added, make, () if keep_text else (text,))
