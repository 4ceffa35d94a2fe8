"""Words and their hashes straight from UTF-8 bytes, vectorised over many documents."""

from __future__ import annotations

import numpy as np

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def byte_table(keep) -> np.ndarray:
    """256 booleans: is the byte part of a word?"""
    return np.array([keep(b) for b in range(256)], bool)


#: Everything but space and TAB..CR.
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ASCII letters, digits and all bytes of non-ASCII characters.
ALNUM = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        with np.errstate(over="ignore"):
            _powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _PRIME, np.uint64)]), dtype=np.uint64)
    return _powers


def words(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document index of each word; a document's border ends a word."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    borders = offsets[:-1][offsets[:-1] < len(data)]
    before[borders] = False
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[borders[borders > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, is_word: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    at = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(at, lengths)
    powers = _power_table(int(lengths.max()))
    values = (data[is_word[data]].astype(np.uint64) + np.uint64(1)) * powers[place]
    return mix(np.add.reduceat(values, at) + lengths.astype(np.uint64) * _PRIME)


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of k consecutive word hashes (n - k + 1 of them); k tags the hash."""
    n = len(hashes) - k + 1
    out = np.full(max(n, 0), np.uint64(k), np.uint64)
    for i in range(k if n > 0 else 0):
        out = mix(out * _PRIME + hashes[i : i + n])
    return out
