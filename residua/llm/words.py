"""Words of many texts at once, as NumPy arrays.

A word is a longest run of ASCII letters, ASCII digits and characters above U+007F; A-Z count as a-z.
All arrays of a ``Words`` run over the words of all its texts, text after text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import xxhash

SPACE = 32
#: Every byte of a UTF-8 text: lower-cased if a letter, itself if part of a word, else a space.
FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else SPACE for b in range(256)
)
LONG_WORD = 64
ODD = np.uint64(0x9E3779B97F4A7C15)
PRIME = np.uint64(0x100000001B3)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fold(text: str | None) -> bytes:
    """The text with every character that belongs to no word turned into a space."""
    return utf8(text).translate(FOLD)


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


@dataclass
class Words:
    """start, end: byte places within the own text; first: index of each text's first word, and the total."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray


def words_of(texts: Sequence[str | None]) -> Words:
    encoded = [utf8(t) for t in texts]
    joined = b" " + b" ".join(encoded) + b" "
    raw = np.frombuffer(joined.translate(FOLD), dtype=np.uint8)
    inside = raw != SPACE
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    begins = 1 + np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])]).astype(np.int64)
    first = np.searchsorted(start, begins)
    text = np.repeat(np.arange(len(encoded)), np.diff(first))
    size = end - start
    value = np.full(len(start), np.uint64(0xCBF29CE484222325))
    live = np.arange(len(start))
    for j in range(min(LONG_WORD, int(size.max(initial=0)))):
        live = live[size[live] > j] if j else live
        value[live] = (value[live] ^ raw[start[live] + j]) * PRIME
    for i in np.flatnonzero(size > LONG_WORD):
        value[i] = xxhash.xxh64_intdigest(raw[start[i] : end[i]].tobytes())
    return Words(text, start - begins[text], end - begins[text], scramble(value), first)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive words."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    size = len(hashes) - n + 1
    total = np.zeros(size, np.uint64)
    for j in range(n):
        total = total * ODD + hashes[j : j + size]
    return scramble(total)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """As ``runs`` for long windows: from running totals, so that the work does not grow with ``n``."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    powers = np.cumprod(np.full(len(hashes), ODD, np.uint64))
    totals = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers)])
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    back = np.cumprod(np.full(len(hashes), inverse, np.uint64))
    return scramble((totals[n:] - totals[:-n]) * back[: len(hashes) - n + 1])


def pieces(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``most``; a larger item is alone in its slice."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > most:
            yield slice(begin, i)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield slice(begin, len(sizes))


def in_pieces(texts: Sequence[str | None], most: int) -> Iterator[slice]:
    return pieces([len(t or "") for t in texts], most)
