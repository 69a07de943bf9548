"""Byte-level BPE: text -> token ids -> bytes, by a segment tree of pair ranks.

The leaves of the tree stand for byte positions. The leaf of a live token holds the rank of the
pair it forms with its live right neighbour, the root the smallest rank and, among equals, the
leftmost position. A merge changes three leaves: the merged token, its left neighbour and the
token that vanishes; each is carried up to the root, so a piece of n bytes costs O(n log n).

Pieces up to ``WIDE`` bytes are merged side by side: one tree per row of a matrix, each round
doing the next merge of every piece that still has one. Longer pieces get a tree of their own.

Handling of odd input: NULL and empty texts give an empty id list and empty bytes; equal texts
give equal ids; an existing column of the output's name is replaced; an id outside the
vocabulary is an error when decoding.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from streamlab.llm.kernels import runs
from streamlab.llm.session import with_python

WIDE = 64
CACHED_PIECES = 120_000  # distinct pieces of a generation; a Python worker remembers two
_NONE = np.iinfo(np.int64).max


class Vocabulary:
    """Merge ranks and the two look-ups made from them: pair of ids -> id, id -> bytes."""

    def __init__(self, raw: bytes, pattern: str):
        lines = (line.split() for line in raw.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.size = max(self.ranks.values()) + 1
        self.pieces = regex.compile(pattern)
        self.bytes_of: list[bytes | None] = [None] * self.size
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        found = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.size + right] = rank
        self.pair_rank = found
        self._pair_keys = np.array(sorted(found), np.int64)
        self._pair_ranks = np.array([found[k] for k in self._pair_keys.tolist()], np.int64)
        self.cache: dict[str, bytes] = {}  # piece -> its ids as little-endian int32
        self.older: dict[str, bytes] = {}  # the generation before

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where the two don't merge."""
        if not len(self._pair_keys):
            return np.full(len(left), -1, np.int64)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self._pair_keys, key), len(self._pair_keys) - 1)
        return np.where(self._pair_keys[at] == key, self._pair_ranks[at], -1)

    # -- encoding ---------------------------------------------------------------------------

    def _merge_one(self, piece: bytes) -> list[int]:
        """A long piece, with a segment tree of its own."""
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        ids = [int(self.byte_ids[b]) for b in piece] + [-1]
        right, left = list(range(1, n + 1)), list(range(-1, n))
        get, size = self.pair_rank.get, self.size
        tree = [_NONE] * (2 * width)

        def leaf(i: int) -> int:
            j = right[i]
            rank = get(ids[i] * size + ids[j]) if j < n else None
            return _NONE if rank is None else rank * width + i

        def put(i: int, value: int) -> None:
            node = i + width
            tree[node] = value
            while node > 1:
                node >>= 1
                small = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == small:
                    break
                tree[node] = small

        for i in range(n):
            tree[width + i] = leaf(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] != _NONE:
            rank, i = divmod(tree[1], width)
            gone = right[i]
            ids[i], right[i] = rank, right[gone]
            if right[i] < n:
                left[right[i]] = i
            put(gone, _NONE)
            put(i, leaf(i))
            if left[i] >= 0:
                put(left[i], leaf(left[i]))
        out, i = [], 0
        while i < n:
            out.append(ids[i])
            i = right[i]
        return out

    def _merge_many(self, pieces: list[bytes], width: int) -> tuple[bytes, list[int]]:
        """Pieces of at most ``width`` bytes (a power of two), one tree per row.

        (ids of all pieces as int32 bytes, where each piece's bytes end).
        """
        m, lengths = len(pieces), np.array([len(p) for p in pieces])
        flat = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(m, width)
        live = np.arange(width) < lengths[:, None]
        ids = np.full((m, width + 1), -1, np.int64)  # the last column stands for "no neighbour"
        ids[:, :width] = np.where(live, self.byte_ids[flat], -1)
        right = np.tile(np.arange(1, width + 2), (m, 1))
        right = np.where(right >= lengths[:, None], width, right)
        left = np.tile(np.arange(-1, width), (m, 1))
        left[:, 0] = width

        tree = np.full((m, 2 * width), _NONE, np.int64)
        r, c = np.nonzero(live & (right[:, :width] < width))
        rank = self.pairs(ids[r, c], ids[r, right[r, c]])
        tree[r, width + c] = np.where(rank < 0, _NONE, rank * width + c)
        node = width
        while node > 1:
            node >>= 1
            tree[:, node : 2 * node] = np.minimum(tree[:, 2 * node : 4 * node : 2], tree[:, 2 * node + 1 : 4 * node : 2])

        def put(rows: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
            node = at + width
            tree[rows, node] = value
            while node[0] > 1:  # all leaves are at one depth
                node = node >> 1
                tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

        def refresh(rows: np.ndarray, at: np.ndarray) -> None:
            rank = self.pairs(ids[rows, at], ids[rows, right[rows, at]])
            put(rows, at, np.where((right[rows, at] == width) | (rank < 0), _NONE, rank * width + at))

        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            rank, at = np.divmod(tree[rows, 1], width)
            gone = right[rows, at]
            after = right[rows, gone]
            ids[rows, at], right[rows, at], left[rows, after] = rank, after, at
            live[rows, gone] = False
            put(rows, gone, np.full(len(rows), _NONE))
            refresh(rows, at)
            before = left[rows, at]
            has = before < width
            if has.any():
                refresh(rows[has], before[has])
            rows = rows[tree[rows, 1] != _NONE]
        out = ids[:, :width][live].astype(np.int32)
        return out.tobytes(), (np.cumsum(live.sum(1)) * 4).tolist()

    def _learn(self, new: list[str]) -> None:
        """Put the ids of pieces not seen before into the cache."""
        by_width: dict[int, list[str]] = {}
        for piece in new:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.cache[piece] = np.int32(rank).tobytes()
            elif len(raw) > WIDE:
                self.cache[piece] = np.array(self._merge_one(raw), np.int32).tobytes()
            else:
                by_width.setdefault(max(2, 1 << (len(raw) - 1).bit_length()), []).append(piece)
        for width, pieces in by_width.items():
            step = max(1, (1 << 19) // width)
            for k in range(0, len(pieces), step):
                part = pieces[k : k + step]
                ids, ends = self._merge_many([p.encode() for p in part], width)
                first = 0
                for piece, end in zip(part, ends):
                    self.cache[piece] = ids[first:end]
                    first = end

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        if len(self.cache) > CACHED_PIECES:
            self.cache, self.older = {}, self.cache
        cache, older, split = self.cache, self.older, self.pieces.findall
        cut = [split(t) if t else [] for t in texts]
        new = set().union(*(set(pieces).difference(cache) for pieces in cut))
        for piece in new.intersection(older):
            cache[piece] = older[piece]
        self._learn(list(new.difference(older)))
        return [b"".join(map(cache.__getitem__, pieces)) for pieces in cut]

    # -- decoding ---------------------------------------------------------------------------

    @functools.cached_property
    def _lengths(self) -> np.ndarray:
        return np.array([len(b or b"") for b in self.bytes_of])

    def decode_batch(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Bytes of each run ``ids[offsets[i]:offsets[i + 1]]``."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size):
            raise ValueError("id outside the vocabulary")
        step = 1 << 16
        parts = (ids[k : k + step].tolist() for k in range(0, len(ids), step))
        data = b"".join([b"".join(map(self.bytes_of.__getitem__, part)) for part in parts])
        ends = np.concatenate([[0], np.cumsum(self._lengths[ids])])[offsets].astype(np.int64)
        return pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data)]
        ).cast(pa.binary())


@functools.lru_cache(maxsize=4)
def _vocabulary(raw: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(raw, pattern)


BYTES_AT_ONCE = 1_000_000


def encode_array(vocabulary: Vocabulary, texts: pa.Array) -> pa.Array:
    """A list<int32> array with the ids of each text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    parts = []
    for a, b in runs(offsets, BYTES_AT_ONCE):
        parts += vocabulary.encode_batch(texts.slice(a, b - a).to_pylist())
    ends = np.cumsum([0, *map(len, parts)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))


def decode_array(vocabulary: Vocabulary, ids: pa.Array) -> pa.Array:
    """The bytes of each id list; NULL counts as empty."""
    counts = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
    flat = pc.list_flatten(ids).to_numpy(zero_copy_only=False)
    return vocabulary.decode_batch(flat, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64))


class BpeCodec:
    """Encodes and decodes columns with the vocabulary in a tiktoken rank file.

    The file (about 1 MB, its size doesn't depend on the data) is read on the driver and sent to
    the workers as a broadcast variable.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        with open(path, "rb") as f:
            self._raw = spark.sparkContext.broadcast(f.read())
        self._pattern = pattern

    def _step(self, make):
        raw, pattern = self._raw, self._pattern
        return lambda column: make(_vocabulary(raw.value, pattern), column)

    def encode(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``ids``, an array of int."""
        return with_python(docs, [text], {"ids": _IDS}, self._step(lambda v, texts: [encode_array(v, texts)]))

    def decode(self, docs: DataFrame, ids: str = "ids") -> DataFrame:
        """``docs`` with ``decoded``, the bytes the ids stand for."""
        return with_python(docs, [ids], {"decoded": T.BinaryType()}, self._step(lambda v, column: [decode_array(v, column)]))

    def round_trip(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """Both in one pass."""

        def both(vocabulary: Vocabulary, texts: pa.Array) -> list[pa.Array]:
            ids = encode_array(vocabulary, texts)
            return [ids, decode_array(vocabulary, ids)]

        return with_python(docs, [text], {"ids": _IDS, "decoded": T.BinaryType()}, self._step(both))


_IDS = T.ArrayType(T.IntegerType())
