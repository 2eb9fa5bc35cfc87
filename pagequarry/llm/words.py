"""Words and five-word shingles of texts as 64-bit hashes, with numpy over UTF-8 bytes.

A word is a run of bytes other than ASCII white space; A-Z count as a-z. A word's hash is a polynomial over random
numbers per byte, taken from running sums, so all words of a text cost a few passes over its bytes.
"""

from functools import lru_cache

import numpy as np

U = np.uint64
# 256 random numbers from a fixed seed, the same for upper and lower case
_BYTES = np.random.default_rng(20_240_601).integers(1, 1 << 64, 256, dtype=U)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_WORD = np.ones(256, dtype=bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_BASE = 0x9E3779B97F4A7C15
_STEP = U(0xD6E8FEB86659FD93)
PIECE = 1 << 18


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    return tuple(np.cumprod(np.concatenate([[U(1)], np.full(PIECE, U(b), dtype=U)]), dtype=U) for b in (_BASE, inverse))


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """Scramble 64-bit integers one to one."""
    x = values + U(salt)
    shifted = x >> U(30)
    x ^= shifted
    x *= U(0xBF58476D1CE4E5B9)
    np.right_shift(x, U(27), out=shifted)
    x ^= shifted
    x *= U(0x94D049BB133111EB)
    np.right_shift(x, U(31), out=shifted)
    x ^= shifted
    return x


def word_hashes(text: bytes) -> np.ndarray:
    """One hash per word, in order. Works in pieces of PIECE bytes; a word may span any number of them."""
    up, down = _powers()
    found, carry, carried = [], 0, 0
    for begin in range(0, len(text), PIECE):
        data = np.frombuffer(text, dtype=np.uint8, count=min(PIECE, len(text) - begin), offset=begin)
        inside = np.zeros(len(data) + 2, dtype=bool)
        np.take(_WORD, data, out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(data) + 1, dtype=U)
        terms = _BYTES[data]
        terms *= up[: len(data)]
        np.cumsum(terms, out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        before = 0
        if carried:
            if len(starts) and starts[0] == 0:
                before = carried
                hashes[0] = U((carry + int(hashes[0]) * pow(_BASE, carried, 1 << 64)) % (1 << 64))
            else:
                found.append(np.array([carry], dtype=U))
            carried = 0
        if len(starts) and ends[-1] == len(data):
            carry, carried = int(hashes[-1]), int(ends[-1] - starts[-1]) + (before if len(starts) == 1 else 0)
            hashes = hashes[:-1]
        found.append(hashes)
    if carried:
        found.append(np.array([carry], dtype=U))
    return mix(np.concatenate(found)) if found else np.zeros(0, dtype=U)


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; of a shorter text the whole sequence; empty without
    words."""
    words = word_hashes((text or "").encode())
    if not len(words):
        return words
    span = min(width, len(words))
    rolled = np.zeros(len(words) - span + 1, dtype=U)
    for k in range(span):
        rolled = rolled * _STEP + words[k : len(words) - span + 1 + k]
    return np.unique(mix(rolled, span))
