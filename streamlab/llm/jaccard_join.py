"""Exact n-gram Jaccard self-join: sets of 5-word shingles with similarity 0.75 or more.

Light and heavy sets are treated differently, by size:

* A light (small) set is entered under every subset that a similar set of its kind must share:
  two sets of a and b shingles share at least ``needed(a, b)`` of them, so both hold a common
  subset of exactly that size. Few sets meet under a subset's key.
* A heavy (large) set, and a light one that a heavy set can be similar to, is entered in the
  inverted lists of its first shingles in a global order: two similar sets meet in one list.

The boundary is the size with the smallest cost: subsets written for light sets against list
entries, read as often as lists are long, for heavy ones. In the global order shingles that many
documents have come last, so passages that documents share fill no lists; the order is a fixed
table of counts per hash range and any table keeps the join exact.

Only one text of each equal set takes part. Sets are first compared with the hub they share most
lists with; what is similar becomes one group. Then lists that still hold two groups are compared
in full across groups. So no list is expanded within a group, and no link between groups is lost.
Two sets must be left enough shingles where they first meet; candidates whose parity sketches
differ in too many bits can't be similar; the others are compared. Equal sets are found by a
128-bit digest; similarities count 48-bit hashes.

Handling of odd input: NULL or empty texts, or texts without words, have an empty set and are
linked with nothing; rows with the same id count as one document with several texts; rows with a
NULL id are returned unlinked, component NULL; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlab.llm.components import components
from streamlab.llm.kernels import mix, shingle_sets
from streamlab.llm.session import written

NUMERATOR, DENOMINATOR = 75, 100
LARGEST_LIGHT = 14
TABLE_BITS = 20  # of the table of counts and of the table of documents that have candidates
_OFTEN_IN_BATCH, _OFTEN = 2, 6
_SUBSET = np.uint64(0xD6E8FEB86659FD93)


def needed(a: int, b: int) -> int:
    """Smallest intersection of similar sets of sizes a and b."""
    return -(-NUMERATOR * (a + b) // (NUMERATOR + DENOMINATOR))


def sizes_like(a: int) -> range:
    """Sizes of sets that can be similar to one of size a."""
    return range(-(-NUMERATOR * a // DENOMINATOR), a * DENOMINATOR // NUMERATOR + 1)


def prefix_length(a: int) -> int:
    """First shingles of a set of size a of which a similar set has one among its own first."""
    return a - (-(-NUMERATOR * a // DENOMINATOR)) + 1


def sizes_fit(a: str, b: str) -> Column:
    """Whether sets of these sizes can be similar."""
    return (F.col(a) * DENOMINATOR >= F.col(b) * NUMERATOR) & (F.col(b) * DENOMINATOR >= F.col(a) * NUMERATOR)


def first_met(x: str, y: str) -> Column:
    """Whether enough of both sets follows for this to be the first shingle that they share."""
    a, b = F.col(f"{x}.n"), F.col(f"{y}.n")
    share = F.ceil((a + b) * NUMERATOR / (NUMERATOR + DENOMINATOR))
    return (a - F.col(f"{x}.place") >= share) & (b - F.col(f"{y}.place") >= share)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one = int(np.add.reduce(shingles, dtype=np.uint64))
    two = int(np.add.reduce(mix(shingles ^ _SUBSET), dtype=np.uint64))
    return tuple((x + len(shingles)) % 2**64 - 2**63 for x in (one, two))


def sketch(shingles: np.ndarray) -> bytes:
    """One bit per shingle and more: the parity of the shingles that fall on each bit.

    Two sketches differ in no more bits than the sets do in shingles.
    """
    bits = max(64, 1 << len(shingles).bit_length())
    at = (mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits) & 1, bitorder="little").tobytes()


def sketches_differ(one: bytes, two: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length of the other."""
    x, y = sorted((np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)), key=len)
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def light_keys(shingles: np.ndarray, light: int) -> list[int]:
    """Keys of the subsets of a light set, for partners that are light too."""
    n = len(shingles)
    sizes = {needed(n, b) for b in sizes_like(n) if 0 < b <= light}
    out = []
    for size in sorted(sizes):
        chosen = np.array(list(itertools.combinations(range(n), size)))
        if len(chosen):
            total = np.add.reduce(shingles[chosen], axis=1, dtype=np.uint64)
            out.append(mix((total + np.uint64(size)) * _SUBSET))
    return out


def list_keys(shingles: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Rarest shingles of a set, as many as the prefix has."""
    order = np.argsort(levels[shingles >> np.uint64(64 - TABLE_BITS)], kind="stable")
    return shingles[order[: prefix_length(len(shingles))]]


def keys_of(shingles: np.ndarray, light: int, levels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(keys, places) of a set's entries; a place is that in the global order, 0 for subsets."""
    n, parts = len(shingles), []
    if n <= light:
        parts += [(k, np.zeros(len(k), np.int64)) for k in light_keys(shingles, light)]
    if n > light or sizes_like(n)[-1] > light:
        keys = list_keys(shingles, levels)
        parts.append((keys, np.arange(len(keys))))
    return parts


_ROWS_AT_ONCE = 2_048


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for k in range(0, batch.num_rows, _ROWS_AT_ONCE):
        yield batch.slice(k, _ROWS_AT_ONCE)
    pa.default_memory_pool().release_unused()  # workers live on after their task


def _signed(h) -> pa.Array:
    return pa.array(np.ascontiguousarray(h, np.uint64).view(np.int64))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, digest and sketch of each set, and counts of the shingles that are frequent in the batch."""
    names = ["kind", "doc_id", "n", "d1", "d2", "sketch"]
    for batch in batches:
        first, seen = [], set()
        for part in slices(batch):
            sizes, digests, sketches = [], [], []
            for s in shingle_sets(part["text"]):
                d = digest(s)
                sizes.append(len(s))
                digests.append(d)
                sketches.append(sketch(s))
                if d not in seen:
                    seen.add(d)
                    first.append(s)
            d1, d2 = zip(*digests)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(sizes), np.int32)), part["doc_id"].cast(pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sketches, pa.binary())], names)
        if first:
            every = np.concatenate(first)
            del first
            every.sort()
            start = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
            count = np.diff(np.append(start, len(every)))
            often = count >= _OFTEN_IN_BATCH
            h, count = every[start[often]], count[often]
            nothing = np.zeros(len(h), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(len(h), np.int32)), pa.array(nothing), pa.array(count, pa.int64()), _signed(h),
                 pa.array(nothing), pa.nulls(len(h), pa.binary())], names)


def boundary(sizes: dict[int, int], list_length: float) -> int:
    """Largest light size: the one for which subsets and list entries together cost least."""

    def cost(light: int) -> float:
        total = 0.0
        for a, sets in sizes.items():
            if a <= light:
                total += sets * sum(math.comb(a, c) for c in {needed(a, b) for b in sizes_like(a) if 0 < b <= light})
            if a > light or sizes_like(a)[-1] > light:
                total += sets * prefix_length(a) * list_length
        return total

    return min(range(LARGEST_LIGHT + 1), key=cost)


def _alike(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Whether sizes n <= m can belong to similar sets."""
    return n * DENOMINATOR >= m * NUMERATOR


_ENTRY = "h long, doc_id long, n int, place int"


def _with_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of lists sorted by (h, n): the entries with a neighbour of like size.

    One pass that keeps one entry of the list at hand, however long the list is.
    """
    last, linked = None, False  # the entry at hand, and whether the one before it is like it
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = batch if last is None else pa.concat_batches([last, batch])
        h, n = whole["h"].to_numpy(), whole["n"].to_numpy().astype(np.int64)
        like = (h[1:] == h[:-1]) & _alike(n[:-1], n[1:])
        has = np.concatenate([[linked], like])
        yield whole.slice(0, len(h) - 1).filter(pa.array(has[:-1] | like))
        last, linked = whole.slice(len(h) - 1), bool(has[-1])
    if last is not None and linked:
        yield last


def _bucket(doc_id: np.ndarray) -> np.ndarray:
    return (mix(doc_id.astype(np.uint64)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _packed(shingles: np.ndarray) -> bytes:
    """The upper 48 bits of each hash; enough to count what two sets share."""
    return np.ascontiguousarray(shingles, "<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    out = np.zeros((len(raw.as_buffer()) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _shared(one: pa.Array, two: pa.Array) -> pa.Array:
    out = []
    for a, b in zip(one, two):
        both = np.concatenate([_unpacked(a), _unpacked(b)])
        both.sort(kind="stable")
        out.append(int((both[1:] == both[:-1]).sum()))
    return pa.array(out, pa.int64())


def _differ(one: pa.Array, two: pa.Array) -> pa.Array:
    return pa.array([sketches_differ(a.as_py(), b.as_py()) for a, b in zip(one, two)], pa.int64())


def _places(ids: DataFrame) -> np.ndarray:
    """Table of which hash ranges of ids occur: 2 ** TABLE_BITS bits, whatever the number of ids."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_bucket(batch["doc_id"].to_numpy())))], ["at"])

    wanted = np.zeros(1 << TABLE_BITS, bool)
    wanted[ids.mapInArrow(places, "at long").distinct().toPandas()["at"].to_numpy(np.int64)] = True
    return np.packbits(wanted)


def similar(pairs: DataFrame, sketches: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose sets are similar.

    Sketches rule out most of the others; then the sets of the remaining documents are made once
    more from their texts, and compared.
    """
    spark = docs.sparkSession
    one, two = (sketches.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab")
    apart = F.arrow_udf(_differ, "long")("s_a", "s_b") * (DENOMINATOR + NUMERATOR)
    likely = pairs.join(one, "a").join(two, "b").where(apart <= (F.col("n_a") + F.col("n_b")) * (DENOMINATOR - NUMERATOR))
    likely = written(likely.select("a", "b", "n_a", "n_b"), "likely")
    ids = likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id")))
    chosen = spark.sparkContext.broadcast(_places(ids))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(chosen.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(bits[_bucket(batch["doc_id"].to_numpy())]))
            for part in slices(batch):
                sets = pa.array([_packed(s) for s in shingle_sets(part["text"])], pa.binary())
                yield pa.RecordBatch.from_arrays([part["doc_id"], sets], ["doc_id", "shingles"])

    sets = written(docs.where("doc_id is not null").mapInArrow(fetch, "doc_id long, shingles binary"), "shingles")
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
    both = F.arrow_udf(_shared, "long")("set_a", "set_b").alias("both")
    size = (F.octet_length("set_a") + F.octet_length("set_b")) / 6
    counted = likely.join(one, "a").join(two, "b").select("a", "b", size.alias("size"), both)
    return counted.where(F.col("both") * DENOMINATOR >= (F.col("size") - F.col("both")) * NUMERATOR).select("a", "b")


def link(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id (smallest id with an equal set) and
    component_id (smallest id that links lead to)."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col(text).alias("text"))
    described = written(docs.mapInArrow(_describe, "kind int, doc_id long, n long, d1 long, d2 long, sketch binary"), "sets")
    rows = described.where("kind = 0").drop("kind")
    classes = rows.where("n > 0").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("class_id")).where("class_id is not null")
    copies = written(
        rows.where("n > 0 and doc_id is not null").join(classes, ["n", "d1", "d2"]).where("doc_id <> class_id")
        .select("doc_id", "class_id").distinct(),
        "copies",
    )

    # counts per hash range: a table of 2 ** TABLE_BITS entries at most
    often = (
        described.where("kind = 1").groupBy("d1").agg(F.sum("n").alias("n")).where(F.col("n") >= _OFTEN)
        .groupBy(F.shiftrightunsigned("d1", 64 - TABLE_BITS).alias("at"))
        .agg(F.ceil(F.log2(F.max("n"))).cast("int").alias("level"), F.sum("n").alias("n"), F.count("*").alias("m"))
    ).toPandas()
    levels = np.zeros(1 << TABLE_BITS, np.uint8)
    levels[often["at"].to_numpy(np.int64)] = often["level"].to_numpy()
    sizes = {r["n"]: r["k"] for r in classes.where(F.col("n") <= 4 * LARGEST_LIGHT).groupBy("n").agg(F.count("*").alias("k")).collect()}
    light = boundary(sizes, 1 + math.log2(1 + often["n"].sum() / max(1, often["m"].sum())))
    table = spark.sparkContext.broadcast(levels)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for part in slices(batch):
                keys, places, sizes, at = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [0], [0]
                for i, s in enumerate(shingle_sets(part["text"])):
                    d = digest(s)
                    if len(s) and d not in seen:
                        seen.add(d)
                        for k, place in keys_of(s, light, table.value):
                            keys.append(k)
                            places.append(place)
                            sizes.append(len(s))
                            at.append(i)
                counts = np.array([len(k) for k in keys], np.int64)
                columns = [
                    _signed(np.concatenate(keys)), part["doc_id"].take(pa.array(np.repeat(np.array(at), counts))),
                    pa.array(np.repeat(np.array(sizes), counts), pa.int32()), pa.array(np.concatenate(places), pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["h", "doc_id", "n", "place"])

    entries = docs.where("doc_id is not null").mapInArrow(enter, _ENTRY)
    lists = written(entries.repartition("h").sortWithinPartitions("h", "n", "doc_id").mapInArrow(_with_neighbours, _ENTRY), "lists")
    once = F.broadcast if copies.count() <= 100_000 else (lambda df: df)  # checked size, 16 bytes each

    def of_class(df: DataFrame, column: str) -> DataFrame:
        to = copies.select(F.col("doc_id").alias(column), F.col("class_id").alias("to"))
        return df.join(once(to), column, "left").withColumn(column, F.coalesce("to", column)).drop("to")

    lists = of_class(lists, "doc_id")
    # the entry of a list whose document is in most lists: of near copies the one that most are like
    degree = lists.groupBy("doc_id").agg(F.count("*").alias("degree"))
    ranked = lists.join(degree, "doc_id").repartition("h")
    hubs = ranked.groupBy("h").agg(F.max_by(F.struct(F.col("doc_id").alias("hub"), F.col("n").alias("hub_n")), F.struct("degree", "doc_id")).alias("x"))
    near = ranked.join(hubs.select("h", "x.*"), "h").where("doc_id <> hub").where(sizes_fit("n", "hub_n"))
    near = near.groupBy("doc_id", "hub").agg(F.count("*").alias("k"))
    near = near.groupBy("doc_id").agg(F.max_by("hub", F.struct("k", "hub")).alias("hub"))
    near = near.select(F.greatest("doc_id", "hub").alias("a"), F.least("doc_id", "hub").alias("b")).distinct()
    near = written(near, "near")

    sketches = rows.where("n > 0").select("doc_id", "n", "sketch")
    first = written(similar(near, sketches, docs), "links")
    group = components(first)

    grouped = lists.join(group.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    grouped = grouped.withColumn("g", F.coalesce("component", "doc_id")).drop("component").repartition("h")
    # lists of the same documents are one list; a document's place in it is its first one
    grouped = grouped.groupBy("h", "doc_id", "n", "g").agg(F.min("place").alias("place"))
    of = F.xxhash64(F.bit_xor(F.xxhash64("doc_id")), F.bit_xor(F.xxhash64("doc_id", F.lit(1))), F.count(F.lit(1)))
    kept = grouped.groupBy("h").agg(of.alias("of"), F.min("g").alias("low"), F.max("g").alias("high"))
    mixed = grouped.join(kept.where("low < high").select("h", "of"), "h").groupBy(F.col("of").alias("h"), "doc_id", "n", "g")
    mixed = written(mixed.agg(F.min("place").alias("place")), "mixed")
    x, y = mixed.alias("x"), mixed.alias("y")
    apart = (F.col("x.h") == F.col("y.h")) & (F.col("x.g") < F.col("y.g"))
    met = x.join(y, apart & sizes_fit("x.n", "y.n") & first_met("x", "y"))
    across = met.select(F.greatest("x.doc_id", "y.doc_id").alias("a"), F.least("x.doc_id", "y.doc_id").alias("b")).distinct()
    across = written(across.join(near, ["a", "b"], "left_anti"), "across")
    more = written(similar(across, sketches, docs), "links")
    whole = components(first.unionByName(more))

    rows = rows.drop("sketch").join(classes, ["n", "d1", "d2"], "left").select("doc_id", "n", F.coalesce("class_id", "doc_id").alias("class_id"))
    return (
        rows.join(whole.withColumnRenamed("node", "class_id"), "class_id", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("class_id")).alias("class_id"),
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "class_id")).alias("component_id"))
    )
