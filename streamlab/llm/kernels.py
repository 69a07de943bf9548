"""Array helpers shared by the text operators: words, hashes and shingles of Arrow batches.

All of them work on whole texts. A batch is cut into runs of whole documents of about
``CHUNK_BYTES``; a longer document is a run of its own, so memory follows the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
# A-Z to a-z, all other bytes as they are
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits over all 64 bits (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * CHUNK_BYTES:
            _powers[base] = have
    return have[:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else pa.large_string()
    column = pc.fill_null(column.cast(kind), b"" if kind == pa.large_binary() else "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive document ranges of about ``limit`` bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, n)
        first = last


class Words:
    """Words of a run of documents: byte spans and, per document, the range of its words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray | None = None):
        self.data, self.offsets = data, offsets
        n = len(data)
        inside = (~_SPACE if is_word is None else is_word)[data]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        self.starts = np.flatnonzero(inside & (~before | first[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        self.ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        self.of_doc = np.searchsorted(self.starts, offsets)

    def hashes(self, length: int | None = None) -> np.ndarray:
        """One 64-bit hash per lower-cased word, or per its first ``length`` bytes."""
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(_BYTE_CODE[LOWER[self.data]] * _power(_BASE, len(self.data)), out=sums[1:])
        ends = self.ends if length is None else np.minimum(self.ends, self.starts + length)
        return mix((sums[ends] - sums[self.starts]) * _power(_BASE_INVERSE, len(self.data) + 1)[self.starts])

    def doc_index(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.of_doc))


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the 5-word shingles of one word sequence, in order; a shorter one is one shingle."""
    n = len(words)
    if n == 0:
        return words
    width = min(n, SHINGLE)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += words[k : k + n - width + 1] * _PLACE[k]
    return mix(total)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    data, offsets = utf8(column)
    for a, b in runs(offsets):
        w = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h = w.hashes()
        for i in range(b - a):
            yield np.unique(shingle_hashes(h[w.of_doc[i] : w.of_doc[i + 1]]))
