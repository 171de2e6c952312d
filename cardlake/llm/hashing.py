"""Words of whole texts as 64-bit hashes, computed on Arrow buffers without one Python object per word.

A word's hash is a polynomial over random byte values, taken from running sums, so its cost does not depend on the
number of words. Texts are worked through in pieces that end between words; long texts need no more memory than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C16 | 3  # odd, and 2 modulo 4 after subtracting one, so that swapped bytes rarely collide
_RANDOM = np.random.default_rng(20240229)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
U = np.uint64


def byte_table(is_word) -> np.ndarray:
    """256 entries: the lower-cased byte (A-Z only) if it belongs to words, else 0."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            table[b] = low
    return table


# Words [^\x20\x09-\x0D]+. Byte 0 is a word byte there, so it takes the place of 0x20, which never occurs in a word.
NON_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
NON_SPACE[0] = 0x20
# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, letters and all bytes above 127.
ALNUM = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self):
        self.grow(PIECE + 1)

    def grow(self, n: int) -> None:
        self.up, self.down = _powers(n, BASE), _powers(n, pow(BASE, -1, 2**64))


_POWERS: list[_Powers] = []


def _piece(data: np.ndarray, table: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in ``data`` and their starts; ``cuts``: positions where a new text begins."""
    if not _POWERS:
        _POWERS.append(_Powers())
    if len(_POWERS[0].up) < len(data):
        _POWERS[0].grow(len(data))
    mapped = table[data]
    word = mapped != 0
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[cuts] = word[cuts]
    last = word.copy()
    last[:-1] &= ~word[1:]
    inner = cuts[cuts > 0] - 1
    last[inner] = word[inner]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    sums = BYTE_VALUES[mapped]
    sums[~word] = 0
    sums *= _POWERS[0].up[:len(data)]
    np.cumsum(sums, out=sums)
    before = np.where(starts > 0, sums[starts - 1], U(0))
    return mix((sums[ends] - before) * _POWERS[0].down[starts]), starts


def word_hashes(texts: pa.Array, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, hashes of the row's words in order) for every row of a binary column; null: no words."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    n = len(texts)
    if not n:
        return
    width = np.int64 if pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset:texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    null = np.asarray(texts.is_null())
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        begin, end = int(offsets[lo]), int(offsets[hi])
        if end - begin > 4 * PIECE:
            yield lo, (np.zeros(0, np.uint64) if null[lo] else _long(data[begin:end], table))
        elif end == begin:
            for row in range(lo, hi):
                yield row, np.zeros(0, np.uint64)
        else:
            bounds = offsets[lo:hi + 1] - begin
            cuts = bounds[:-1][bounds[:-1] < end - begin]
            hashes, starts = _piece(data[begin:end], table, cuts)
            at = np.searchsorted(starts, bounds)
            for row in range(lo, hi):
                a, b = (at[row - lo], at[row - lo + 1]) if not null[row] else (0, 0)
                yield row, hashes[a:b]
        lo = hi


def _long(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hashes of one long text, piece by piece; a piece ends behind a byte that belongs to no word."""
    out, at, zero = [], 0, np.zeros(1, np.int64)
    while at < len(data):
        end = min(len(data), at + PIECE)
        while end < len(data) and table[data[end - 1]]:
            gap = np.flatnonzero(table[data[end:end + PIECE]] == 0)
            end = end + int(gap[0]) + 1 if len(gap) else min(len(data), end + PIECE)
        out.append(_piece(data[at:end], table, zero)[0])
        at = end
    return np.concatenate(out)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words, in order; depends on k."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out *= U(BASE)
        out += words[j:j + n]
    return mix(out)


def with_binary(df, text: str, *keep: str):
    """Only the needed columns, the text as bytes named ``text``."""
    from pyspark.sql import functions as F

    return df.select(*keep, F.col(text).cast("binary").alias("text"))
