"""Word shingles of texts, vectorised over the bytes of an Arrow column.

Words are runs of bytes other than space and U+0009 to U+000D, with A-Z lower-cased; UTF-8 keeps other
characters apart from those bytes. Hashes have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C55)
#: Texts are taken together up to so many bytes, which bounds the memory of a task; a longer text is alone.
SLICE_BYTES = 1 << 20

_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values in place (splitmix64)."""
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        inverse = U64(pow(int(BASE), -1, 1 << 64))
        for k, base in enumerate((BASE, inverse)):
            p = np.full(n, base, U64)
            p[0] = 1
            _POWERS[k] = np.cumprod(p, dtype=U64)
    return _POWERS[0][:n], _POWERS[1][:n]


def slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``SLICE_BYTES`` of text each."""
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset:column.offset + len(column) + 1]
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, end
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (with the end of the last); nulls are empty."""
    offsets = np.frombuffer(column.buffers()[1], np.int32 if pa.types.is_string(column.type) else np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.zeros(0, np.uint8)
    return raw, offsets.astype(np.int64) - lo


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The lower-cased bytes, and the first and the past-the-last byte of each word, in order."""
    n = len(raw)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    lower = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    begin = ~space
    begin[1:] &= space[:-1] | cut[1:n]
    end = ~space
    end[:-1] &= space[1:] | cut[1:n]
    return lower, np.flatnonzero(begin), np.flatnonzero(end) + 1


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word and the row it is in, in order."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    lower, first, last = word_spans(raw, offsets)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, U64)
    np.cumsum((lower.astype(U64) + U64(1)) * up[:n], out=sums[1:])
    hashes = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U64))
    return hashes, np.searchsorted(offsets, first, "right") - 1


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles, repeats included, and ends[r]: the first shingle of row r + 1.

    A row with fewer words than ``width`` has its whole sequence as one shingle.
    """
    counts = np.bincount(rows, minlength=n_rows)
    n = len(words)
    rolled = np.full(n, U64(width))
    fits = np.arange(n)
    for k in range(min(width, n)):
        rolled[:n - k] = rolled[:n - k] * BASE + words[k:]
    whole = np.zeros(n, bool)
    if n >= width:
        whole[:n - width + 1] = rows[width - 1:] == rows[:n - width + 1]
    heads = np.cumsum(counts) - counts
    for r in np.flatnonzero((counts > 0) & (counts < width)):
        h = U64(counts[r])
        with np.errstate(over="ignore"):
            for w in words[heads[r]:heads[r] + counts[r]]:
                h = h * BASE + w
        rolled[heads[r]], whole[heads[r]] = h, True
    keep = fits[whole]
    sizes = np.bincount(rows[keep], minlength=n_rows)
    return mix(rolled[keep]), np.cumsum(sizes)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row of a column of texts."""
    for lo, hi in slices(column):
        raw, offsets = text_bytes(column.slice(lo, hi - lo))
        words, rows = word_hashes(raw, offsets)
        hashes, ends = shingle_hashes(words, rows, hi - lo, width)
        at = 0
        for r, end in enumerate(ends):
            yield lo + r, np.unique(hashes[at:end])
            at = end


def digest(shingles: np.ndarray) -> bytes:
    """128-bit identity of a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
