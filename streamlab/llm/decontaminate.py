"""Benchmark decontamination: passages of benchmark items inside documents.

A document is read through windows of as many words as an item has. A window that shares no
5-word shingle with an item of its size has similarity 0 and is never looked at; the others get a
SimHash of their shingles, of ``64 * LANES`` bits. The fingerprints of the items are indexed by
``RADIUS + 1`` blocks of bits: two fingerprints within ``RADIUS`` bits agree in one block at
least, so the index yields every item within the radius. Similar sets differ in about a fifth of
the bits, small ones (some ten shingles) in up to a third; unlike ones in half. The radius lies
more than four standard deviations above the former. Candidates are then compared exactly by the weighted Jaccard similarity of their shingle sets; a shingle weighs
ln(1 + items / items that have it). Items are counted over the whole benchmark, however it is cut
into blocks. A shingle of one item weighs as much as one that no item has, so only shingles that
several items have need an entry.

Words are runs of ASCII letters and digits or non-ASCII bytes, A-Z lower-cased, so punctuation
doesn't hide a passage. A sequence of fewer than five words is one shingle: such an item is found
where it is all of a document, not within a longer one.

Items are matched in blocks of ``ITEMS_AT_ONCE``; what is sent to the workers is bounded by that.

Handling of odd input: NULL or empty texts (documents or items) match nothing; rows of either
side that repeat are all reported; windows at the end of a text are cut there; other columns are
ignored. Whole texts are read.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from streamlab.llm.kernels import SHINGLE, Words, mix, runs, shingle_hashes, utf8
from streamlab.llm.session import slices, with_python

SIMILARITY = 0.75
LANES = 4
RADIUS = 104
ITEMS_AT_ONCE = 20_000
_TABLE_BITS = 20
_WINDOWS_AT_ONCE = 1_024

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_BITS = np.arange(64, dtype=np.uint64)
# of each block the bits in every lane
_BLOCK_MASKS = np.zeros((RADIUS + 1, LANES), np.uint64)
for _bit in range(64 * LANES):
    _BLOCK_MASKS[_bit % (RADIUS + 1), _bit // 64] |= np.uint64(1 << (_bit % 64))
_LANE = np.array([0x9E3779B97F4A7C15 * (2 * k + 1) % 2**64 for k in range(LANES)], np.uint64)


def _votes(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """+ or - the weight per bit of each hash, as a matrix of integers (sums of them are exact)."""
    weights = np.rint(weights * 1024).astype(np.int64)
    lanes = mix(shingles[:, None] ^ _LANE)
    return np.where((lanes[:, :, None] >> _BITS) & np.uint64(1), weights[:, None, None], -weights[:, None, None])


def _pack(sums: np.ndarray) -> np.ndarray:
    return np.bitwise_or.reduce(np.where(sums > 0, np.uint64(1) << _BITS, np.uint64(0)), axis=-1)


def _block_key(prints: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return mix((prints & mask) * _LANE).sum(1, dtype=np.uint64)


def distances(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ two).sum(1, dtype=np.int64)


class Weights:
    """Weights of shingles, from the number of items and the sorted shingles that several have."""

    def __init__(self, items: int, shingles: np.ndarray, counts: np.ndarray):
        self.new = math.log1p(items)  # of a shingle that one item has, or none
        self.shingles = shingles
        self.values = np.log1p(items / counts)
        self.of = dict(zip(shingles.tolist(), self.values.tolist()))

    def weigh(self, shingles: np.ndarray) -> np.ndarray:
        out = np.full(len(shingles), self.new)
        if len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, shingles), len(self.shingles) - 1)
            same = self.shingles[at] == shingles
            out[same] = self.values[at[same]]
        return out


def _item_shingles(texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Word hashes and distinct shingles of each item."""
    data, offsets = utf8(pa.array(texts, pa.string()))
    words = Words(data, offsets, _WORD)
    hashes = words.hashes()
    sequence = [hashes[words.of_doc[i] : words.of_doc[i + 1]] for i in range(len(texts))]
    return sequence, [np.unique(shingle_hashes(s)) for s in sequence]


def weights_of(items: DataFrame) -> Weights:
    """Weights over all items."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, sets = _item_shingles(batch["text"].to_pylist())
            h = np.concatenate([np.zeros(0, np.uint64), *sets])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    counts = items.select("text").mapInArrow(shingles, "h long").groupBy("h").agg(F.count("*").alias("n")).where("n > 1").toArrow()
    h = counts["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return Weights(items.count(), h[order], counts["n"].to_numpy()[order])


class ItemIndex:
    """Fingerprints of a block of items, by size and by block of bits.

    Without weights the block is the whole benchmark.
    """

    def __init__(self, ids: list, texts: list[str | None], weights: Weights | None = None):
        sequence, shingles = _item_shingles(texts)
        if weights is None:
            seen = sorted((h, n) for h, n in Counter(h for s in shingles for h in s.tolist()).items() if n > 1)
            weights = Weights(len(ids), np.array([h for h, _ in seen], np.uint64), np.array([n for _, n in seen], np.int64))
        self.weights = weights
        self.ids, self.size = ids, np.array([len(s) for s in sequence], np.int64)
        self.sets = [frozenset(s.tolist()) for s in shingles]
        sizes = defaultdict(set)
        for size, s in zip(self.size.tolist(), shingles):
            for h in s.tolist():
                sizes[h].add(size)
        self.known = np.array(sorted(sizes), np.uint64)
        self.sizes_of = [sorted(sizes[h]) for h in self.known.tolist()]
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.known >> np.uint64(64 - _TABLE_BITS)] = True
        self.by_size: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for size in np.unique(self.size[self.size > 0]).tolist():
            which = np.flatnonzero(self.size == size)
            prints = np.array([self._print(shingle_hashes(sequence[i])) for i in which], np.uint64)
            index = []
            for mask in _BLOCK_MASKS:
                key = _block_key(prints, mask)
                order = np.argsort(key, kind="stable")
                index.append((key[order], order))
            self.by_size[size] = (which, prints, index)

    def _print(self, shingles: np.ndarray) -> np.ndarray:
        return _pack(_votes(shingles, self.weights.weigh(shingles)).sum(0, keepdims=True))[0]

    def hits(self, shingles: np.ndarray) -> np.ndarray:
        """Positions of shingles that some item has."""
        at = np.flatnonzero(self.table[shingles >> np.uint64(64 - _TABLE_BITS)])
        return at[np.isin(shingles[at], self.known)] if len(at) else at

    def within(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within the radius."""
        which, items, index = self.by_size[size]
        pairs = []
        for mask, (values, order) in zip(_BLOCK_MASKS, index):
            key = _block_key(prints, mask)
            a = np.searchsorted(values, key, "left")
            n = np.searchsorted(values, key, "right") - a
            window = np.repeat(np.arange(len(prints)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
            item = order[at]
            near = distances(prints[window], items[item]) <= RADIUS
            pairs.append(window[near] * len(items) + item[near])
        pair = np.unique(np.concatenate(pairs))
        window, item = np.divmod(pair, len(items))
        return window, which[item], distances(prints[window], items[item])

    def similarity(self, window: frozenset, item: int) -> float:
        mine, weight, new = self.sets[item], self.weights.of, self.weights.new
        shared = math.fsum(weight.get(h, new) for h in mine & window)
        return shared / math.fsum(weight.get(h, new) for h in mine | window)

    def match(self, words: np.ndarray, hits: np.ndarray, similarity: float) -> dict[int, tuple[float, int, int, int]]:
        """item -> (similarity, first word, words, distance) of its best window in one document."""
        shingles, width = shingle_hashes(words), min(len(words), SHINGLE)
        starts: dict[int, list[np.ndarray]] = defaultdict(list)
        for q, k in zip(hits.tolist(), np.searchsorted(self.known, shingles[hits]).tolist()):
            for size in self.sizes_of[k]:
                starts[size].append(np.arange(max(0, q + width - size), q + 1))
        best: dict[int, tuple[float, int, int, int]] = {}
        for size, parts in starts.items():
            first = np.unique(np.concatenate(parts))
            for k in range(0, len(first), _WINDOWS_AT_ONCE):
                self._compare(size, first[k : k + _WINDOWS_AT_ONCE], shingles, width, len(words), similarity, best)
        return best

    def _compare(self, size, first, shingles, width, n_words, similarity, best) -> None:
        last = np.minimum(first + size, n_words)
        a, b = first, np.maximum(last - width + 1, first + 1)
        # sums of the stretches that the windows cover, each stretch once
        cuts = np.flatnonzero(np.concatenate([[True], a[1:] > np.maximum.accumulate(b)[:-1]]))
        prints = np.empty((len(a), LANES), np.uint64)
        for lo, hi in zip(cuts, [*cuts[1:], len(a)]):
            part = shingles[a[lo] : b[lo:hi].max()]
            sums = np.zeros((len(part) + 1, LANES, 64), np.int64)
            np.cumsum(_votes(part, self.weights.weigh(part)), axis=0, out=sums[1:])
            prints[lo:hi] = _pack(sums[b[lo:hi] - a[lo]] - sums[a[lo:hi] - a[lo]])
        window, item, distance = self.within(size, prints)
        for w, i, d in zip(window.tolist(), item.tolist(), distance.tolist()):
            s = self.similarity(frozenset(shingles[a[w] : b[w]].tolist()), i)
            if s >= similarity - 1e-12:
                found = (s, -int(first[w]), int(last[w] - first[w]), d)
                if i not in best or found > best[i]:
                    best[i] = found


def matches_of(index: ItemIndex, texts: pa.Array, similarity: float) -> pa.Array:
    """Per text the list of its matches, by item."""
    data, offsets = utf8(texts)
    out: list[list] = [[] for _ in range(len(texts))]
    for a, b in runs(offsets):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], _WORD)
        h, of_doc = words.hashes(), words.of_doc
        counts = np.diff(of_doc)
        # shingles of all documents of the run at once; those across two documents don't count
        wide = shingle_hashes(h) if len(h) >= SHINGLE else h[:0]
        doc = words.doc_index()
        at = index.hits(wide)
        at = at[doc[at] == doc[at + SHINGLE - 1]] if len(at) else at
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        for i in np.unique(np.concatenate([doc[at], short])).tolist():
            own = h[of_doc[i] : of_doc[i + 1]]
            hits = index.hits(shingle_hashes(own)) if counts[i] < SHINGLE else at[doc[at] == i] - of_doc[i]
            if len(hits):
                found = index.match(own, hits, similarity)
                out[a + i] = [
                    {"item_id": index.ids[k], "similarity": s, "first_word": -first, "n_words": n, "distance": d}
                    for k, (s, first, n, d) in sorted(found.items())
                ]
    return pa.array(out, pa.list_(_MATCH))


_MATCH = pa.struct(
    [("item_id", pa.int64()), ("similarity", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("distance", pa.int64())]
)
_MATCHES = T.ArrayType(from_arrow_type(_MATCH))


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", column: str = "leaks", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with an array column of the items of which the text holds a passage."""
    spark = docs.sparkSession
    items = items.select(F.col("item_id").cast("long"), "text")
    blocks = max(1, math.ceil(items.count() / ITEMS_AT_ONCE))
    weights, indexes = weights_of(items), []
    for k in range(blocks):
        # about ITEMS_AT_ONCE rows
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        rows = sorted(zip(*(block[c].to_pylist() for c in ("item_id", "text"))), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
        indexes.append(spark.sparkContext.broadcast(ItemIndex([r[0] for r in rows], [r[1] for r in rows], weights)))

    def match(texts: pa.Array) -> list[pa.Array]:
        found = [matches_of(index.value, texts, similarity).to_pylist() for index in indexes]
        return [pa.array([[m for part in row for m in part] for row in zip(*found)], pa.list_(_MATCH))]

    return with_python(docs, [text], {column: _MATCHES}, match)


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document and item it holds a passage of, with the most similar window."""
    found = find_leaks(docs.select("doc_id", "text"), items, similarity=similarity)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
