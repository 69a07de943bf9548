"""Packing of token ids into fixed-length rows for training, as binary columns.

``tokenized`` makes the ids with the tiktoken library; ids from elsewhere do as well.

Documents are packed best-fit-decreasing: longest first, each into the fullest row it still fits.
A segment tree over the free room 0..length finds that row in logarithmic time. A document longer
than a row is split without loss: full rows, and a rest that is packed like a document. Packing
works on runs of ``TOKENS_AT_ONCE`` tokens, so memory is bounded. ``dealt`` puts documents into runs
by a hash of id and text, in a fixed order: rows and row ids then follow from the documents alone.
Without it the runs are those of the partitions, and no data moves.

A packed row holds the id matrix row (little-endian, 2 bytes per id where the vocabulary allows),
padded; the cumulative segment lengths, starting with 0; the positions, which start again at 0
with each segment; and per segment its document and the offset of its first token in it.

Handling of odd input: documents without ids (NULL, empty) take no room and are left out, and so
do NULL ids; an id that doesn't fit the vocabulary is an error, as it would be cut; rows that repeat
are packed once each (equal ones are interchangeable); documents of equal length are taken in their
order; very long ones span rows; a NULL doc_id is carried; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.llm.session import with_python

LENGTH = 2048
TOKENS_AT_ONCE = 1 << 21
BYTES_AT_ONCE = 4 << 20  # of text in a run
RUN = "__packing_run"
PAD = 50_256
_NO_IDS = np.zeros(0, np.uint32)

SCHEMA = (
    "row_id long, input_ids binary, positions binary, cu_seqlens array<int>, doc_ids array<long>, "
    "doc_offsets array<long>, n_tokens int"
)


class Rooms:
    """Rows by free room: a segment tree of counts over 0..length finds the smallest that is enough."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.count = [0] * (2 * self.width)
        self.rows: dict[int, list[int]] = {}

    def add(self, room: int, row: int) -> None:
        self.rows.setdefault(room, []).append(row)
        self._change(room, 1)

    def _change(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the fullest row with at least ``need`` free; it is removed."""
        node = need + self.width
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        self._change(room, -1)
        return room, self.rows[room].pop()


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Items of each row; every size is 1..length. Equal sizes keep their order."""
    rooms, rows = Rooms(length), []
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = rooms.take(sizes[item])
        if found is None:
            found = (length, len(rows))
            rows.append([])
        room, row = found
        rows[row].append(item)
        if room > sizes[item]:
            rooms.add(room - sizes[item], row)
    return rows


def _packed(docs: list, ids: list[np.ndarray], length: int, kind: str, pad: int) -> Iterator[tuple]:
    """Rows (ids, positions, cu_seqlens, doc_ids, doc_offsets, tokens) of one run of documents."""
    pieces = [(d, a, x[a : a + length]) for d, x in zip(docs, ids) for a in range(0, len(x), length)]
    for items in best_fit([len(p[2]) for p in pieces], length):
        own = [pieces[i] for i in items]
        sizes = [len(p[2]) for p in own]
        row = np.full(length, pad, kind)
        at = np.zeros(length, kind)
        used = sum(sizes)
        row[:used] = np.concatenate([p[2] for p in own])
        at[:used] = np.concatenate([np.arange(n) for n in sizes])
        yield row.tobytes(), at.tobytes(), [0, *np.cumsum(sizes).tolist()], [p[0] for p in own], [p[1] for p in own], used


@functools.lru_cache(maxsize=2)
def _encoding(raw: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def tokenized(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` by the rank file at ``path`` (about 1 MB, read on the driver)."""
    with open(path, "rb") as f:
        raw = docs.sparkSession.sparkContext.broadcast(f.read())

    def encode(texts: pa.Array) -> list[pa.Array]:
        encoding = _encoding(raw.value, pattern)
        ids = [encoding.encode_to_numpy(t) if t else _NO_IDS for t in texts.to_pylist()]
        ends = np.cumsum([0, *map(len, ids)])
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*ids, _NO_IDS]).astype(np.int32)))]

    return with_python(docs, [text], {"ids": T.ArrayType(T.IntegerType())}, encode)


def dealt(docs: DataFrame, text: str = "text", bytes_at_once: int = BYTES_AT_ONCE) -> DataFrame:
    """``docs`` in runs of about ``bytes_at_once`` that don't depend on how they were partitioned."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    run = F.pmod(F.xxhash64("doc_id", text), F.lit(max(1, -(-total // bytes_at_once))))
    return docs.withColumn(RUN, run).repartition(RUN).sortWithinPartitions(RUN, "doc_id", text)


def pack(encoded: DataFrame, length: int = LENGTH, pad: int = PAD, vocabulary: int = 50_257, tokens_at_once: int = TOKENS_AT_ONCE) -> DataFrame:
    """Packed rows of ``encoded`` (doc_id, ids, and the run where ``dealt`` was used)."""
    largest = min(vocabulary, 1 << 32)
    kind = "<u2" if max(vocabulary, length, pad + 1) <= 1 << 16 else "<u4"
    types = [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()]
    names = ["row_id", "input_ids", "positions", "cu_seqlens", "doc_ids", "doc_offsets", "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = TaskContext.get().partitionId()
        next_row = now << 36
        docs, ids, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_row, docs, ids, held
            rows = list(_packed(docs, ids, length, kind, pad))
            docs, ids, held = [], [], 0
            for k in range(0, len(rows), 256):
                part = rows[k : k + 256]
                columns = [pa.array(c, t) for c, t in zip(zip(*part), types)]
                numbers = pa.array(range(next_row, next_row + len(part)), pa.int64())
                next_row += len(part)
                yield pa.RecordBatch.from_arrays([numbers, *columns], names)

        for batch in batches:
            column = batch["ids"]
            flat = column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *(len(x) if x.is_valid else 0 for x in column)])
            if len(flat) and not 0 <= flat.min() <= flat.max() < largest:
                raise ValueError(f"ids from {flat.min()} to {flat.max()} with a vocabulary of {vocabulary}")
            runs = batch[RUN].to_pylist() if RUN in batch.schema.names else [now] * batch.num_rows
            for k, (doc, of) in enumerate(zip(batch["doc_id"].to_pylist(), runs)):
                if of != now:
                    if docs:
                        yield from flush()
                    now, next_row = of, of << 36
                own = flat[ends[k] : ends[k + 1]]
                if len(own):
                    docs.append(doc)
                    ids.append(own.astype(kind))
                    held += len(own)
                    if held >= tokens_at_once:
                        yield from flush()
        if docs:
            yield from flush()

    own = [RUN] if RUN in encoded.columns else []
    return encoded.select(F.col("doc_id").cast("long"), F.array_compact("ids").alias("ids"), *own).mapInArrow(run, SCHEMA)


def unpack(packed: DataFrame, length: int = LENGTH, vocabulary: int = 50_257, pad: int = PAD) -> DataFrame:
    """doc_id, offset and ids of every segment: what was packed, in pieces."""
    kind = "<u2" if max(vocabulary, length, pad + 1) <= 1 << 16 else "<u4"

    @F.arrow_udf("array<array<int>>")
    def cut(rows: pa.Array, bounds: pa.Array) -> pa.Array:
        out = []
        for row, cu in zip(rows, bounds):
            ids, cu = np.frombuffer(row.as_py(), kind), cu.as_py()
            out.append([ids[a:b].tolist() for a, b in zip(cu, cu[1:])])
        return pa.array(out, pa.list_(pa.list_(pa.int32())))

    parts = packed.select(F.explode(F.arrays_zip("doc_ids", "doc_offsets", cut("input_ids", "cu_seqlens").alias("ids"))).alias("s"))
    return parts.select(F.col("s.doc_ids").alias("doc_id"), F.col("s.doc_offsets").alias("doc_offset"), F.col("s.ids").alias("ids"))


def write(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet; a re-run task replaces its own file only."""
    packed.write.mode("overwrite").parquet(path)
