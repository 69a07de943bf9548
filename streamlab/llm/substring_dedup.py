"""Removal of word passages that occur more than once, by difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. Every word covered by a window whose
word sequence also starts anywhere else goes, all occurrences alike, the first one included.

1. Anchors. ``COVER`` is a difference cover modulo ``PERIOD``: for any two places some distance
   below the period takes both to places of the cover. Only the ``CORE`` words that follow such a
   place are hashed. Two equal windows hold, at one distance from their starts, the same core at
   a place of the cover, so a window that has no repeated core at any of its anchors occurs once.
2. Extension. Around the repeated anchors each window that holds one is named by all its words,
   once per place; windows of one name at two places are repeats. Names are dealt out by
   themselves, so the windows of a passage that many documents share spread over all tasks, and
   of the records of one name that a task meets among ``RECORDS_AT_ONCE`` only one travels.
3. Cut. Starts of repeated windows come back to their documents as stretches.

A core's name has 64 bits (a clash only extends an anchor in vain), a window's 128. Words are
hashed to 64 bits first. Which cores repeat is sent to the workers as a bit table sized by their
number (``session.table_bits``).

Handling of odd input: a NULL text has no words; documents shorter than a window keep all, however
long their words; very long texts are taken whole; rows that repeat count as one document; where
an id has several texts, the smallest by hash is the document; rows with another text of such an
id and rows with a NULL id keep all and make nothing else go. An empty table gives no rows. Other
columns are ignored, whatever their names. Ties don't arise: a window repeats or it doesn't.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.llm import kernels
from streamlab.llm.kernels import Words, mix, runs, utf8
from streamlab.llm.session import IdTable, one_text_per_id, slices, table_bits, written

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)  # a perfect difference set: all differences modulo 21
CORE = WINDOW - PERIOD + 1
RECORDS_AT_ONCE = 1 << 19
LEAST_PART_BITS = 8  # records are dealt out in 256 parts at least, more for a wider shuffle
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_BASES = (0xBF58476D1CE4E5B9, 0x94D049BB133111ED)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
_SALT = np.uint64(0xD6E8FEB86659FD93)
_WINDOW = np.dtype([("high", "u8"), ("low", "u8"), ("doc", "i8"), ("start", "i4")])


def word_hashes(words: Words) -> np.ndarray:
    """One 64-bit hash per word, letters as they are."""
    sums = np.zeros(len(words.data) + 1, np.uint64)
    np.cumsum(kernels._BYTE_CODE[words.data] * kernels._power(kernels._BASE, len(words.data)), out=sums[1:])
    back = kernels._power(kernels._BASE_INVERSE, len(words.data) + 1)
    return mix((sums[words.ends] - sums[words.starts]) * back[words.starts])


class Sequences:
    """Names of word sequences of a run of documents, from sums over its words' hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sums = [self._sums(hashes, 0), None]
        self.hashes = hashes

    @staticmethod
    def _sums(hashes: np.ndarray, lane: int) -> np.ndarray:
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * kernels._power(_BASES[lane], len(hashes)), out=sums[1:])
        return sums

    def name(self, start: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
        if self.sums[lane] is None:
            self.sums[lane] = self._sums(mix(self.hashes ^ _SALT), lane)
        sums, back = self.sums[lane], kernels._power(_INVERSES[lane], len(self.hashes) + 1)
        return mix((sums[start + length] - sums[start]) * back[start])


def anchors(of_doc: np.ndarray) -> np.ndarray:
    """Places of the cover, counted from their document's start, that a core follows in documents
    of a window or more; ``of_doc`` has the first word of each document, and the end."""
    size = np.diff(of_doc)
    place = np.arange(of_doc[-1])
    in_doc = place - np.repeat(of_doc[:-1], size)
    left = np.repeat(size, size) - in_doc
    return place[_IN_COVER[in_doc % PERIOD] & (left >= CORE) & (np.repeat(size, size) >= WINDOW)]


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    data, offsets = utf8(batch["text"])
    for a, b in runs(offsets):
        yield a, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])


def _part(name: np.ndarray, bits: int) -> np.ndarray:
    return (name >> np.uint64(64 - bits)).astype(np.int32)


def deal(part: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    """One row per part: its records, field by field, each field as planes of bytes."""
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    records = records[order]
    cuts = [*first[1:], len(part)]
    blobs = [b"".join(_planes(c[a:b]) for c in _fields(records)) for a, b in zip(first, cuts)]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(blobs, pa.binary())], ["part", "records"])


def _fields(records: np.ndarray) -> list[np.ndarray]:
    return [records[f] for f in records.dtype.names] if records.dtype.names else [records]


def _planes(column: np.ndarray) -> bytes:
    """All first bytes of the values, then all second ones: sorted ids and places compress well."""
    return np.ascontiguousarray(column).view(np.uint8).reshape(len(column), -1).T.tobytes()


def _records(blob: bytes, kind: np.dtype) -> np.ndarray:
    raw = np.frombuffer(blob, np.uint8)
    n = len(raw) // kind.itemsize
    out, at = np.empty(n, kind), 0
    for target in _fields(out):
        width = target.dtype.itemsize
        target[:] = np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(target.dtype).ravel()
        at += n * width
    return out


def gather(batches: Iterator[pa.RecordBatch], kind: np.dtype) -> Iterator[tuple[int, np.ndarray]]:
    """The records of each part, from rows sorted by part."""
    held, now = [], None
    for batch in batches:
        for part, blob in zip(batch["part"].to_pylist(), batch["records"]):
            if part != now:
                if held:
                    yield now, np.concatenate(held)
                held, now = [], part
            held.append(_records(blob.as_py(), kind))
    if held:
        yield now, np.concatenate(held)


_DEALT = "part int, records binary"


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition("part").sortWithinPartitions("part")


def _buffered(found: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    held, n = [], 0
    for records in found:
        held.append(records)
        n += len(records)
        if n >= RECORDS_AT_ONCE:
            yield np.concatenate(held)
            held, n = [], 0
    if n:
        yield np.concatenate(held)


def _cores(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of cores, at most twice per buffer, the 40 bits below their part."""

    def found() -> Iterator[np.ndarray]:
        for batch in slices(batches):
            for _, words in _runs(batch):
                place = anchors(words.of_doc)
                if len(place):
                    yield Sequences(word_hashes(words)).name(place, CORE)

    for names in _buffered(found()):
        names, count = np.unique(names, return_counts=True)
        names = np.repeat(names, np.minimum(count, 2))
        low = (names << np.uint64(bits)) >> np.uint64(24)
        yield deal(_part(names, bits), np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8)[:, :5]).view("V5").ravel())


_CORE = np.dtype("V5")


def _repeated_cores(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, records in gather(batches, _CORE):
        low = np.zeros((len(records), 8), np.uint8)
        low[:, :5] = records.view(np.uint8).reshape(-1, 5)
        low = np.sort(low.view(np.uint64).ravel())
        low = np.unique(low[1:][low[1:] == low[:-1]])
        name = (np.uint64(part) << np.uint64(64 - bits)) | (low << np.uint64(24) >> np.uint64(bits))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([name.tobytes()], pa.binary()), pa.array([len(name)], pa.int64())], ["part", "records", "n"])


def _table_share(bits: int, size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part its share of the table of 2 ** size bits."""
    for batch in batches:
        for part, blob in zip(batch["part"].to_pylist(), batch["records"]):
            at = (np.frombuffer(blob.as_py(), np.uint64) >> np.uint64(64 - size)).astype(np.int64) - (part << (size - bits))
            share = np.zeros(1 << (size - bits), bool)
            share[at] = True
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(share, bitorder="little").tobytes()], pa.binary())], ["part", "records"])


def candidates(table: np.ndarray, size: int, of_doc: np.ndarray, sequences: Sequences) -> np.ndarray:
    """Starts of the windows that hold a core of the table at one of their anchors."""
    place = anchors(of_doc)
    at = (sequences.name(place, CORE) >> np.uint64(64 - size)).astype(np.int64)
    place = place[(table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0]
    if not len(place):
        return place
    doc = np.searchsorted(of_doc, place, "right") - 1
    first = np.maximum(place - PERIOD + 1, of_doc[doc])
    last = np.minimum(place, of_doc[doc + 1] - WINDOW)
    some = first <= last
    change = np.zeros(of_doc[-1] + 1, np.int32)
    np.add.at(change, first[some], 1)
    np.add.at(change, last[some] + 1, -1)
    return np.flatnonzero(np.cumsum(change) > 0)


def repeats(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of windows: (which have a name that another place has too, one of each name)."""
    order = np.lexsort((records["start"], records["doc"], records["low"], records["high"]))
    r = records[order]
    new = np.ones(len(r), bool)
    new[1:] = (r["high"][1:] != r["high"][:-1]) | (r["low"][1:] != r["low"][:-1])
    lead = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    other = (r["doc"] != r["doc"][lead][group]) | (r["start"] != r["start"][lead][group])
    many = np.logical_or.reduceat(other, lead)[group] if len(r) else other
    out, one = np.zeros(len(r), bool), np.zeros(len(r), bool)
    out[order], one[order] = many, new
    return out, one


_STRETCH = np.dtype([("doc", "i8"), ("first", "i4"), ("last", "i4")])


def stretches(doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Starts in a row as one record: document, first and last start."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    cut = np.ones(len(doc), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + 1)
    first = np.flatnonzero(cut)
    out = np.empty(len(first), _STRETCH)
    out["doc"], out["first"] = doc[first], start[first]
    out["last"] = start[np.append(first[1:], len(doc)) - 1] if len(doc) else start
    return out


def _as_marks(bits: int, doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """Stretches dealt out by document, in parts from 1 << bits on."""
    found = stretches(doc, start)
    return deal(_part(mix(found["doc"].astype(np.uint64)), bits) + np.int32(1 << bits), found)


def _windows(bits: int, size: int, sent, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows around repeated anchors by name; stretches of those that already met another here."""

    def found() -> Iterator[np.ndarray]:
        for batch in slices(batches):
            ids = batch["doc_id"].to_numpy()
            for a, words in _runs(batch):
                sequences = Sequences(word_hashes(words))
                start = candidates(sent.value, size, words.of_doc, sequences)
                if not len(start):
                    continue
                records = np.empty(len(start), _WINDOW)
                records["high"], records["low"] = sequences.name(start, WINDOW), sequences.name(start, WINDOW, 1)
                doc = np.searchsorted(words.of_doc, start, "right") - 1
                records["doc"], records["start"] = ids[a + doc], start - words.of_doc[doc]
                yield records

    for records in _buffered(found()):
        many, one = repeats(records)
        if many.any():
            yield _as_marks(bits, records["doc"][many], records["start"][many])
        records = records[one]
        yield deal(_part(records["high"], bits), records)


def _repeated_windows(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    passed = []

    def own() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            settled = np.asarray(batch["part"].to_numpy()) >= 1 << bits
            if settled.any():
                passed.append(batch.filter(pa.array(settled)))
            yield batch.filter(pa.array(~settled))

    for _, records in gather(own(), _WINDOW):
        many, _ = repeats(records)
        if many.any():
            yield _as_marks(bits, records["doc"][many], records["start"][many])
        while passed:
            yield passed.pop()
    while passed:
        yield passed.pop()


def _by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its stretches of repeated starts."""
    for _, found in gather(batches, _STRETCH):
        found = found[np.argsort(found["doc"], kind="stable")]
        ids, first = np.unique(found["doc"], return_index=True)
        ends = pa.array(np.append(first, len(found)), pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.ascontiguousarray(found[f]))) for f in ("first", "last")]
        yield pa.RecordBatch.from_arrays([pa.array(ids), *lists], ["doc_id", "first", "last"])


_RESULT = "doc_id long, n_words long, span_starts array<long>, span_ends array<long>, kept string"


def removed_words(n: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which of n words a window covers that starts in one of the stretches."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + WINDOW, -1)
    return np.cumsum(change)[:n] > 0


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of _RESULT; the columns first and last may be missing."""
    types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
    for batch in slices(batches):
        marked = "first" in batch.schema.names
        rows = []
        for k in range(batch.num_rows):
            words = (batch["text"][k].as_py() or "").encode().split()  # at 0x20 and 0x09 to 0x0D
            starts = ends = np.zeros(0, np.int64)
            if marked and batch["first"][k].is_valid:
                gone = removed_words(len(words), batch["first"][k].values.to_numpy(), batch["last"][k].values.to_numpy())
                edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                starts, ends = edges[::2], edges[1::2]
                words = compress(words, ~gone)
                n = len(gone)
            else:
                n = len(words)
            rows.append((batch["doc_id"][k].as_py(), n, starts.tolist(), ends.tolist(), b" ".join(words).decode()))
        columns = zip(*rows) if rows else [()] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", "n_words", "span_starts", "span_ends", "kept"])


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, the removed spans (words) and the kept words of each row, joined by a space."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    bits = min(16, max(LEAST_PART_BITS, (2 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()))
    own, aside = one_text_per_id(docs)

    cores = _dealt(own.select("text").mapInArrow(partial(_cores, bits), _DEALT))
    cores = written(cores.mapInArrow(partial(_repeated_cores, bits), f"{_DEALT}, n long"), "cores")
    size = table_bits(cores.agg(F.sum("n")).first()[0] or 0, bits + 3)
    table = np.zeros(1 << (size - 3), np.uint8)
    step = len(table) >> bits
    for part, share in cores.select("part", "records").mapInArrow(partial(_table_share, bits, size), _DEALT).toLocalIterator():
        table[part * step : (part + 1) * step] |= np.frombuffer(share, np.uint8)
    sent = spark.sparkContext.broadcast(table)

    windows = _dealt(own.mapInArrow(partial(_windows, bits, size, sent), _DEALT)).mapInArrow(partial(_repeated_windows, bits), _DEALT)
    marks = _dealt(windows).mapInArrow(_by_document, "doc_id long, first array<int>, last array<int>")
    marks = written(marks, "marks")

    touched, clean = IdTable(marks.select("doc_id")).split(own)
    cut = touched.join(marks, "doc_id", "left").select("doc_id", "text", "first", "last").mapInArrow(_cut, _RESULT)
    return cut.unionByName(clean.unionAll(aside).mapInArrow(_cut, _RESULT))
