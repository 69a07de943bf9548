"""Removal of repeated passages by difference-cover sampled suffixes.

A byte goes where a string of ``LENGTH`` bytes that covers it also starts earlier: in a document
with a smaller id, or earlier in the same document. Only the first ``LENGTH`` bytes of a suffix
matter, so one round of names is enough and the recursion on names ends there:

1. Sample. ``COVER`` is a difference cover modulo ``PERIOD``: for any two places some distance
   below the period takes both to sampled places. So two equal strings always hold, at one
   distance from their starts, a pair of sampled places with equal bytes around them.
2. Name and sort. A sampled place gets two names: of the ``CORE`` bytes that follow it, which all
   strings through it share, and of its surroundings, all strings that hold it. Sorted by both
   and by place, every place but the first of equal surroundings is repeated as a whole; places
   whose core has one kind of surroundings only need no further work.
3. Merge the other suffixes. Around the first places of cores with several kinds of surroundings
   the strings that start at each distance before the sampled place are named, sorted by name and
   place, and compared with their neighbours: all but the first of equal strings are repeated.

Before the sampling, text that can't repeat is left out: the gram (``GRAM``-byte string) with the
smallest hash within a string (a function of its bytes) must occur at two places. Which grams do is
sent to the workers as a bit table sized by their number (``session.table_bits``). As the smallest of
61 hashes lie close to zero, grams are hashed once more before they are dealt out and entered there.

Names are 64-bit polynomial hashes; that of the surroundings, which only tells places of one core
apart, keeps 40 of them. Records travel as arrays, dealt out by name or by document
id, so a task holds its share of the names. Of the records of one name among about
``RECORDS_AT_ONCE`` of a task, all but the first are repeated whatever other tasks hold: they are
marked there, and one record goes on to be compared. Cores of about ``HOT`` places or more, estimated
from one row in ``HOT_SHARE``, are dealt out by core and surroundings and all their first places are
looked at; the strings around those are named before they are dealt out, by their own names. So
neither a passage nor an edge that many documents share meets in one task. Which cores count as hot
changes the work only, not the result.

Handling of odd input: a NULL text counts as empty; texts shorter than ``LENGTH`` bytes keep all;
rows that repeat count as one document; where an id has several texts, one of them (the smallest
by hash) is the document. Rows with another text of such an id, and rows with a NULL id, keep all
and make nothing else go. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm import kernels
from streamlab.llm.kernels import mix, runs, utf8
from streamlab.llm.session import IdTable, one_text_per_id, slices, table_bits, written

LENGTH = 100
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)  # a perfect difference set: all differences modulo 57
CORE = LENGTH - PERIOD + 1
BEFORE = PERIOD - 1  # bytes before a sampled place that a string through it can hold
GRAM = 40
LEAST_PART_BITS = 8  # records are dealt out in 256 parts at least, more for a wider shuffle
TABLE_BITS = 27  # of the table of hashes that occur twice, at least: 16 MB; sized by their number
PROBES = 4  # bits that each of them sets
RECORDS_AT_ONCE = 1 << 19  # of sampled places that are reduced together
HOT = 16_384
HOT_SHARE = 64
HOT_BITS = 22  # of the table of hot cores
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_PLACE = np.uint64((1 << 24) - 1)


class Hashes:
    """Hashes of all substrings of a run of documents, from sums of their bytes' codes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(kernels._BYTE_CODE[data] * kernels._power(kernels._BASE, len(data)), out=self.sums[1:])
        self.back = kernels._power(kernels._BASE_INVERSE, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all_of(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:n]) * self.back[:n]) if n > 0 else self.sums[:0]


def smallest_in(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        have += step
    return values


def _bytes(column: np.ndarray) -> bytes:
    """All first bytes of the values, then all second ones: small values and ids in order then
    compress well on their way."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes()


def _values(blob: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(kind).ravel()


def deal(part: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per part: its records, each column as bytes."""
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    cuts = [*first[1:], len(part)]
    # a column of byte strings (the surroundings) stays as it is
    code = [_bytes if c.ndim == 1 else np.ndarray.tobytes for c in columns]
    blobs = [[f(c[order[a:b]]) for a, b in zip(first, cuts)] for f, c in zip(code, columns)]
    names = ["part", *(f"c{k}" for k in range(len(columns)))]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)], names)


def _part(name: np.ndarray, bits: int) -> np.ndarray:
    return (name >> np.uint64(64 - bits)).astype(np.int32)


def _schema(columns: int) -> str:
    return ", ".join(["part int", *(f"c{k} binary" for k in range(columns))])


def gather(batches: Iterator[pa.RecordBatch], kinds: list) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The records of each part, from rows sorted by part."""
    held, now = [[] for _ in kinds], None
    for batch in batches:
        for k, part in enumerate(batch["part"].to_pylist()):
            if part != now:
                if now is not None:
                    yield now, [np.concatenate(h) for h in held]
                held, now = [[] for _ in kinds], part
            for c, (h, kind) in enumerate(zip(held, kinds)):
                h.append(_values(batch[c + 1][k].as_py(), kind))
    if now is not None:
        yield now, [np.concatenate(h) for h in held]


def _dealt(df: DataFrame, step: Callable, schema: str) -> DataFrame:
    return df.repartition("part").sortWithinPartitions("part").mapInArrow(step, schema)


def first_and_later(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of records (names, document, place): the first of each name, and all at a later place than it."""
    order = np.lexsort(columns[::-1])
    *names, doc, place = (c[order] for c in columns)
    new = np.ones(len(order), bool)
    new[1:] = False
    for name in names:
        new[1:] |= name[1:] != name[:-1]
    leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    first, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order], later[order] = new, (doc != doc[leader]) | (place != place[leader])
    return first, later


def _nothing(n: int) -> np.ndarray:
    """A column of n values of no bytes."""
    return np.zeros((n, 0), np.uint8)


def _hot_place(part: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Place in the table of hot cores, from a core's part and the 32 bits that travel with it."""
    key = (part.astype(np.uint64) << np.uint64(32)) | low.astype(np.uint64)
    return (mix(key) >> np.uint64(64 - HOT_BITS)).astype(np.int64)


def _low(core: np.ndarray) -> np.ndarray:
    return (core >> np.uint64(16)).astype(np.uint32)


def _is_hot(bits: int, hot: np.ndarray, core: np.ndarray) -> np.ndarray:
    at = _hot_place(_part(core, bits), _low(core))
    return (hot[at >> 3] >> (at & 7)) & 1 > 0


def _string_names(hashes: Hashes, n: int, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, smallest gram) of each string of ``LENGTH`` bytes within a document.

    A gram is 40 bits of its hash, then 24 bits of its place, so that the leftmost one wins. Smallest
    values lie close to zero: ``_gram_names`` makes names of them that are spread evenly.
    """
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    gram = hashes.all_of(GRAM)
    gram = (gram & ~_PLACE) | (np.arange(len(gram), dtype=np.uint64) & _PLACE)
    low = smallest_in(gram, LENGTH - GRAM + 1)
    inside = np.ones(len(low), bool)
    for end in offsets[1:]:
        inside[max(0, end - LENGTH + 1) : end] = False
    start = np.flatnonzero(inside)
    return start, low[start]


def _gram_names(hashes: Hashes, start: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Names, 40 bits of 64, of the smallest grams of strings that start there."""
    place = start + ((low - start.astype(np.uint64)) & _PLACE).astype(np.int64)
    return mix(hashes.of(place, place + GRAM)) & ~_PLACE


def _grams(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that stand for strings, once per place, cut to 32 bits below their part."""
    for batch in slices(batches):
        data, offsets = utf8(batch["text"])
        found = []
        for a, b in runs(offsets):
            own = offsets[a : b + 1] - offsets[a]
            hashes = Hashes(data[offsets[a] : offsets[b]])
            start, low = _string_names(hashes, int(own[-1]), own)
            if len(low):
                new = np.ones(len(low), bool)  # strings in a row can have the same gram
                new[1:] = low[1:] != low[:-1]
                found.append(_gram_names(hashes, start[new], low[new]))
        if found:
            h, count = np.unique(np.concatenate(found), return_counts=True)
            h = np.repeat(h, np.minimum(count, 2))
            yield deal(_part(h, bits), [(h << np.uint64(8) >> np.uint64(32)).astype(np.uint32)])


def _table_places(gram: np.ndarray, bits: int, size: int) -> Iterator[np.ndarray]:
    """Bits that stand for a gram in a table of 2 ** size bits: some within the share of its part."""
    share = (gram >> np.uint64(64 - bits)) << np.uint64(size - bits)
    for k in range(PROBES):
        within = mix(gram + np.uint64(k + 1)) >> np.uint64(64 - size + bits)
        yield (share | within).astype(np.int64)


def _twice(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part the hashes that occur at two places, and their number."""
    for part, (h,) in gather(batches, [np.uint32]):
        h = np.sort(h)
        h = np.unique(h[1:][h[1:] == h[:-1]]).astype(np.uint64)
        # the hash lacks its first 8 bits, which the part's number begins with
        h |= np.uint64(part >> (bits - 8) << 32)
        columns = [pa.array([part], pa.int32()), pa.array([(h << np.uint64(24)).tobytes()], pa.binary()), pa.array([len(h)], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "c0", "n"])


def _shares(bits: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part its share of the bit table."""
    for batch in batches:
        for part, blob in zip(batch["part"].to_pylist(), batch["c0"]):
            share = np.zeros(1 << (size - bits), bool)
            for at in _table_places(np.frombuffer(blob.as_py(), np.uint64), bits, size):
                share[at - (part << (size - bits))] = True
            packed = np.packbits(share, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([packed])], ["part", "c0"])


def _suspects(bits: int, table: np.ndarray, hashes: Hashes, n: int, offsets: np.ndarray) -> np.ndarray:
    """Sampled places, by their offset in the document, that hold a string that may repeat."""
    start, low = _string_names(hashes, n, offsets)
    new = np.ones(len(low), bool)  # strings in a row mostly have the same gram
    new[1:] = low[1:] != low[:-1]
    gram, size = _gram_names(hashes, start[new], low[new]), (8 * len(table)).bit_length() - 1
    known = np.ones(len(gram), bool)
    for at in _table_places(gram, bits, size):
        known &= (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
    start = start[known[np.cumsum(new) - 1]]
    near = np.zeros(n + PERIOD + 1, np.int32)
    near[: n + 1] += np.bincount(start, minlength=n + 1)[: n + 1].astype(np.int32)
    near[PERIOD:] -= near[: n + 1].copy()
    place = np.flatnonzero(np.cumsum(near)[:n] > 0)
    first = offsets[np.searchsorted(offsets, place, "right") - 1]
    keep = _IN_COVER[(place - first) % PERIOD]
    return place[keep]


def _bounds(place: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte, end) of the surroundings of sampled places."""
    doc = np.searchsorted(offsets, place, "right") - 1
    return doc, np.maximum(place - BEFORE, offsets[doc]), np.minimum(place + LENGTH, offsets[doc + 1])


def _sampled(bits: int, table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(core, surroundings, document, place) of the sampled places of each slice."""
    for batch in slices(batches):
        data, offsets = utf8(batch["text"])
        ids = batch["doc_id"].to_numpy()
        parts = []
        for a, b in runs(offsets):
            own = offsets[a : b + 1] - offsets[a]
            hashes = Hashes(data[offsets[a] : offsets[b]])
            place = _suspects(bits, table, hashes, int(own[-1]), own)
            if not len(place):
                continue
            doc, lo, hi = _bounds(place, own)
            use = (hi - lo >= LENGTH) & (place + CORE <= own[doc + 1])
            place, doc, lo, hi = place[use], doc[use], lo[use], hi[use]
            core = hashes.of(place, place + CORE)
            around = mix(hashes.of(lo, hi) + (place - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)
            parts.append((core, around, ids[a + doc], (place - own[doc]).astype(np.int32)))
        if parts:
            yield tuple(np.concatenate(c) for c in zip(*parts))


def _cores(bits: int, table: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for core, *_ in _sampled(bits, table, batches):
        yield deal(_part(core, bits), [_low(core)])


def _hot_places(least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, (core,) in gather(batches, [np.uint32]):
        core, count = np.unique(core, return_counts=True)
        core = core[count >= least]
        yield pa.RecordBatch.from_arrays([pa.array(_hot_place(np.full(len(core), part), core))], ["at"])


def _held(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """Records of several slices together: the more of them, the fewer names travel twice."""
    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= RECORDS_AT_ONCE:
            yield tuple(np.concatenate(c) for c in zip(*held))
            held, n = [], 0
    if n:
        yield tuple(np.concatenate(c) for c in zip(*held))


def _samples(bits: int, table: np.ndarray, hot: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First records of each name of some slices, those of hot cores in parts from 1 << bits on; places
    of the others, by document in parts from 2 << bits on."""
    for core, around, doc, place in _held(_sampled(bits, table, batches)):
        first, later = first_and_later(core, around, doc, place)
        if later.any():
            part, n = _part(mix(doc[later].astype(np.uint64)), bits), int(later.sum())
            yield deal(part + np.int32(2 << bits), [_nothing(n), _nothing(n), doc[later], place[later]])
        core, around, doc, place = core[first], around[first], doc[first], place[first]
        part, many = _part(core, bits), _is_hot(bits, hot, core)
        part[many] = _part(mix(core[many] ^ mix(around[many])), bits) + np.int32(1 << bits)
        yield deal(part, [_low(core), around, doc, place])


def _by_document(bits: int, doc: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    return deal(_part(mix(doc.astype(np.uint64)), bits), [doc, *columns])


def _classes(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places repeated as a whole (kind 0), and first places that need a closer look (kind 1)."""
    for part, (core, around, doc, place) in gather(batches, [np.uint32, np.uint64, np.int64, np.int32]):
        if part >= 2 << bits:
            yield _by_document(bits, doc, [place, np.zeros(len(doc), np.uint8)])
            continue
        first, later = first_and_later(core, around, doc, place)
        look = first
        if part < 1 << bits:  # else the core is hot
            _, at = np.unique(core, return_inverse=True)
            look = first & (np.bincount(at, first)[at] > 1)
        out = later | look
        if out.any():
            yield _by_document(bits, doc[out], [place[out], look[out].astype(np.uint8)])


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its places of either kind."""
    for _, (doc, place, kind) in gather(batches, [np.int64, np.int32, np.uint8]):
        ids, at = np.unique(doc, return_inverse=True)
        columns = []
        for k in (0, 1):
            own, places = at[kind == k], place[kind == k]
            order = np.lexsort((places, own))
            ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=len(ids)))])
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places[order], pa.int32())))
        yield pa.RecordBatch.from_arrays([pa.array(ids), *columns], ["doc_id", "whole", "look"])


_ROWS_AT_ONCE = 8_192


def _core_names(around: np.ndarray) -> np.ndarray:
    core = np.ascontiguousarray(around[:, BEFORE : BEFORE + CORE])
    return mix((kernels._BYTE_CODE[core] * kernels._power(kernels._BASE, CORE)).sum(1, dtype=np.uint64))


def _named(around: np.ndarray, doc: np.ndarray, place: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, document, start) of the strings at each distance before the places."""
    width = BEFORE + LENGTH
    power, back = kernels._power(kernels._BASE, width), kernels._power(kernels._BASE_INVERSE, width)
    sums = np.zeros((len(doc), width + 1), np.uint64)
    np.cumsum(kernels._BYTE_CODE[around] * power, axis=1, out=sums[:, 1:])
    first = np.arange(BEFORE + 1)  # strings start this far from the surroundings' start
    name = mix((sums[:, first + LENGTH] - sums[:, first]) * back[first])
    back_by = BEFORE - first
    real = (back_by <= left[:, None]) & (LENGTH - back_by <= right[:, None])
    r, c = np.nonzero(real)
    return name[r, c], doc[r], place[r] - back_by[c].astype(np.int32)


def _as_stretches(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first byte, end) of the strings that start there; starts in a row are one stretch."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    cut = np.ones(len(doc), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    last = np.concatenate([np.flatnonzero(cut)[1:] - 1, [len(doc) - 1]])
    return doc[cut], start[cut], start[last] + np.int32(LENGTH)


def _surroundings(bits: int, hot: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes around the places to look at, dealt out by their core.

    Of hot cores the first strings of each name of some rows, by name in parts from 1 << bits on,
    and stretches of the others, by document in parts from 2 << bits on.
    """
    width = BEFORE + LENGTH
    for batch in slices(batches):
        parts = []
        for k in range(batch.num_rows):
            text = batch["text"][k].as_py()
            raw = np.frombuffer((text or "").encode(), np.uint8)
            place = np.unique(batch["look"].slice(k, 1).flatten().to_numpy())
            place = place[place + CORE <= len(raw)]
            if not len(place):
                continue
            padded = np.concatenate([np.zeros(BEFORE, np.uint8), raw, np.zeros(LENGTH, np.uint8)])
            around = np.lib.stride_tricks.sliding_window_view(padded, width)[place]
            name = _core_names(around)
            left = np.minimum(place, BEFORE).astype(np.uint8)
            right = np.minimum(len(raw) - place, LENGTH).astype(np.uint8)
            doc = np.full(len(place), batch["doc_id"][k].as_py(), np.int64)
            parts.append((name, around, doc, place.astype(np.int32), left, right))
        if parts:
            name, *columns = (np.concatenate(c) for c in zip(*parts))
            many = _is_hot(bits, hot, name)
            if not many.all():
                yield deal(_part(name[~many], bits), [c[~many] for c in columns])
            columns = [c[many] for c in columns]
            for k in range(0, int(many.sum()), _ROWS_AT_ONCE):
                name, doc, start = _named(*(c[k : k + _ROWS_AT_ONCE] for c in columns))
                first, later = first_and_later(name, doc, start)
                if later.any():
                    own, begin, end = _as_stretches(doc[later], start[later])
                    none = _nothing(len(own))
                    part = _part(mix(own.astype(np.uint64)), bits) + np.int32(2 << bits)
                    yield deal(part, [end.view(np.uint8).reshape(-1, 4), own, begin, none, none])
                name, doc, start = name[first], doc[first], start[first]
                none = _nothing(len(name))
                yield deal(_part(name, bits) + np.int32(1 << bits), [name.view(np.uint8).reshape(-1, 8), doc, start, none, none])


def _strings(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of the strings that a name before them repeats: of whole cores, some rows at once, or of hot ones."""
    for part, (around, doc, place, left, right) in gather(batches, [np.uint8, np.int64, np.int32, np.uint8, np.uint8]):
        if part >= 2 << bits:
            yield _by_document(bits, doc, [place, around.view(np.int32)])
            continue
        if part >= 1 << bits:
            found = [(around.view(np.uint64), doc, place)]
        else:
            around = around.reshape(-1, BEFORE + LENGTH)  # rows of bytes
            core = np.concatenate([_core_names(around[k : k + _ROWS_AT_ONCE]) for k in range(0, len(doc), _ROWS_AT_ONCE)])
            order = np.argsort(core, kind="stable")
            core = core[order]
            cuts = [0]
            while cuts[-1] < len(core):
                cuts.append(int(np.searchsorted(core, core[min(cuts[-1] + _ROWS_AT_ONCE, len(core)) - 1], "right")))
            rows = (order[a:b] for a, b in zip(cuts, cuts[1:]))
            found = (_named(*(c[r] for c in (around, doc, place, left, right))) for r in rows)
        for name, own, start in found:
            _, later = first_and_later(name, own, start)
            if later.any():
                own, begin, end = _as_stretches(own[later], start[later])
                yield _by_document(bits, own, [begin, end])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (doc, first, end) in gather(batches, [np.int64, np.int32, np.int32]):
        order = np.argsort(doc, kind="stable")
        ids, cuts = np.unique(doc[order], return_index=True)
        ends = pa.array(np.append(cuts, len(doc)), pa.int32())
        columns = [pa.ListArray.from_arrays(ends, pa.array(c[order], pa.int32())) for c in (first, end)]
        yield pa.RecordBatch.from_arrays([pa.array(ids), *columns], ["doc_id", "first", "end"])


def removed_spans(n: int, whole: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of removed bytes of a text of n bytes."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.maximum(whole - BEFORE, 0), 1)
    np.add.at(change, np.minimum(whole + LENGTH, n), -1)
    np.add.at(change, first, 1)
    np.add.at(change, end, -1)
    gone = np.concatenate([[False], np.cumsum(change)[:n] > 0, [False]])
    edges = np.flatnonzero(gone[1:] != gone[:-1])
    return edges[::2], edges[1::2]


_RESULT = "doc_id long, n_bytes long, span_starts array<long>, span_ends array<long>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _RESULT; the columns whole, first and end may be missing."""
    none = np.zeros(0, np.int64)
    for batch in slices(batches):
        marked = "whole" in batch.schema.names
        rows = []
        for k in range(batch.num_rows):
            raw = (batch["text"][k].as_py() or "").encode()
            lists = [batch[c].slice(k, 1).flatten().to_numpy().astype(np.int64) for c in ("whole", "first", "end")] if marked else [none] * 3
            starts, ends = removed_spans(len(raw), *lists)
            kept = b"".join(raw[a:b] for a, b in zip([0, *ends.tolist()], [*starts.tolist(), len(raw)]))
            rows.append((batch["doc_id"][k].as_py(), len(raw), starts.tolist(), ends.tolist(), kept))
        types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        columns = list(zip(*rows)) if rows else [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "n_bytes", "span_starts", "span_ends", "kept"])


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, the removed spans (bytes) and the kept bytes of each row."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = min(TABLE_BITS - 3, max(LEAST_PART_BITS, (2 * width - 1).bit_length()))
    own, aside = one_text_per_id(docs)
    twice = written(_dealt(own.mapInArrow(partial(_grams, bits), _schema(1)), partial(_twice, bits), "part int, c0 binary, n long"), "twice")
    size = table_bits(twice.agg(F.sum("n")).first()[0] or 0, TABLE_BITS)
    table = np.zeros(1 << (size - 3), np.uint8)
    step = len(table) >> bits
    for part, share in twice.select("part", "c0").mapInArrow(partial(_shares, bits, size), _schema(1)).toLocalIterator():
        table[part * step : (part + 1) * step] = np.frombuffer(share, np.uint8)
    twice = spark.sparkContext.broadcast(table)  # 2 ** size bits

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _cores(bits, twice.value, batches)

    some_rows = own.sample(1 / HOT_SHARE, 7)
    places = _dealt(some_rows.mapInArrow(cores, _schema(1)), partial(_hot_places, max(1, HOT // HOT_SHARE)), "at long").distinct().toArrow()
    marked = np.zeros(1 << HOT_BITS, bool)
    marked[places["at"].to_numpy()] = True
    hot = spark.sparkContext.broadcast(np.packbits(marked, bitorder="little"))

    def samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _samples(bits, twice.value, hot.value, batches)

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _surroundings(bits, hot.value, batches)

    classes = _dealt(own.mapInArrow(samples, _schema(4)), partial(_classes, bits), _schema(3))
    marks = written(_dealt(classes, _marks, "doc_id long, whole array<int>, look array<int>"), "marks")

    look = marks.where(F.size("look") > 0).select("doc_id", "look")
    near = IdTable(look.select("doc_id")).split(own)[0].join(look, "doc_id")
    strings = _dealt(near.mapInArrow(surroundings, _schema(5)), partial(_strings, bits), _schema(3))
    more = written(_dealt(strings, _stretches, "doc_id long, first array<int>, end array<int>"), "stretches")

    touched, clean = IdTable(marks.select("doc_id").unionByName(more.select("doc_id"))).split(own)
    clean = clean.unionAll(aside)
    empty = F.array().cast("array<int>")
    joined = touched.join(marks.drop("look"), "doc_id", "left").join(more, "doc_id", "left")
    joined = joined.select("doc_id", "text", *(F.coalesce(c, empty).alias(c) for c in ("whole", "first", "end")))
    return joined.mapInArrow(_cut, _RESULT).unionByName(clean.mapInArrow(_cut, _RESULT))
