"""Hard negatives of anchors by an STR-packed R-tree over integer vectors.

A row's score is its integer inner product with the anchor; higher scores come first, equal ones by
the smaller id. An anchor's positives are its first ``POSITIVES`` other rows of its label. For each
positive, the negatives are the first ``NEGATIVES`` rows of other labels whose score lies in the
window ``LOW * positive <= 100 * score <= HIGH * positive``.

* Packing. Sort-tile-recursive: Spark deals the rows into slabs along the coordinate that varies
  most (``repartitionByRange``, ties broken by id, so that a vector held by a third of all rows
  spans several slabs); within ``ROWS_AT_ONCE`` rows of a slab a task sorts and tiles along the next
  coordinates down to leaves of ``LEAF`` rows. A leaf with its minimum bounding box is one record of
  a written table; every row is in one. Boxes above the leaves (``FAN`` children each) are put up
  when a task reads its leaves.
* Search. The coordinates of a box give an interval of the inner product with an anchor: the sum,
  over the coordinates, of the smaller and of the larger of anchor x low and anchor x high. Boxes
  wait in a queue, best upper bound first. One that lies outside the score window is pruned, and so
  is one whose bound is strictly below the k-th score found so far (at the same score a smaller id
  may still win). A task carries what it found from one group of leaves to the next. First the
  positives are searched, then, with their windows, the negatives; each time the tasks' findings,
  at most k per anchor (and positive) and group of leaves, are merged by a window function.

Anchors are the stated query set: rows whose id is divisible by ``ANCHOR_STEP``. They are sent to
the workers in blocks of about ``ANCHOR_BYTES``, each block searching the whole index; nothing else
is sent. Bounds and scores are computed in 64-bit floats where all sums stay below 2^53, else in
Python integers: exact in both cases.

Handling of odd input: rows with a NULL id, a NULL label, a NULL vector, or a NULL or non-finite
component take no part. Of rows with the same id the one with the smallest (label, vector) counts,
so repeated rows count once. Vectors of different lengths are compared as if the shorter one ended
in zeros; an empty vector has score zero with all. Ties go to the smaller id. A component
that is 2^53 or more when scaled counts as not finite. An anchor without positives, or a positive
whose window is empty (as with a negative score), gives no rows; so does an empty table. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlab.config import work_dir
from streamlab.llm.session import written

ANCHOR_STEP = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SCALE = 256
LEAF = 256
FAN = 16
ROWS_AT_ONCE = 8_192
ROWS_PER_SLAB = 131_072
ROWS_FOR_AXES = 65_536  # about so many rows choose the order of the coordinates
ANCHOR_BYTES = 8 << 20
_EXACT = 2.0**53


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows that take part, labels shifted, components as whole numbers."""
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda v: v * SCALE)
    fine = F.forall(scaled, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < _EXACT))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    vector = F.transform(scaled, lambda v: F.floor(v).cast("double")).alias("vector")
    present = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    taken = rows.where(present & fine).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), vector)
    twice = taken.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("vec_id")
    twice = written(twice, "twice")
    if not twice.count():
        return taken
    one = taken.join(twice, "vec_id").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("row"))
    return taken.join(twice, "vec_id", "left_anti").unionAll(one.select("vec_id", "row.label", "row.vector"))


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``width`` coordinates; shorter vectors end in zeros."""
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def tiles(x: np.ndarray, axes: list[int], capacity: int) -> Iterator[np.ndarray]:
    """Sort-tile-recursive: row numbers of runs of at most ``capacity`` rows, cut along one axis after the other."""

    def cut(rows: np.ndarray, depth: int) -> Iterator[np.ndarray]:
        pages = -(-len(rows) // capacity)
        if pages <= 1:
            yield rows
            return
        rows = rows[np.argsort(x[rows, axes[depth % len(axes)]], kind="stable")]
        left = max(1, len(axes) - depth)
        slabs = max(2, round(pages ** (1 / left)))
        step = -(-pages // slabs) * capacity
        for k in range(0, len(rows), step):
            yield from cut(rows[k : k + step], depth + 1)

    if len(x):
        yield from cut(np.arange(len(x)), 0)


_LEAVES = "n int, ids binary, labels binary, vectors binary, low binary, high binary"


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= ROWS_AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _pack(axes: list[int], width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves of a slab, some rows at once."""
    names = ["n", "ids", "labels", "vectors", "low", "high"]
    for rows in _held(batches):
        x = matrix(_array(rows["vector"]), width)
        ids, labels = (rows[c].to_numpy() for c in ("vec_id", "label"))
        leaves = []
        for r in tiles(x, axes, LEAF):
            box = x[r].min(0), x[r].max(0)
            leaves.append((len(r), *(v.tobytes() for v in (ids[r], labels[r], x[r], *box))))
        types = [pa.int32(), *[pa.binary()] * 5]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*leaves), types)], names)


class Tree:
    """The leaves that a task holds at once, and boxes of boxes above them."""

    def __init__(self, ids: list[np.ndarray], labels: list[np.ndarray], vectors: list[np.ndarray], low: np.ndarray, high: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.levels = [(low, high)]  # from the leaves up; a node's children are FAN in a row below it
        while len(self.levels[-1][0]) > FAN:
            below = self.levels[-1]
            first = np.arange(0, len(below[0]), FAN)
            self.levels.append((np.minimum.reduceat(below[0], first), np.maximum.reduceat(below[1], first)))

    def bounds(self, anchors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per level (anchor x node): the smallest and the largest inner product in the box."""
        up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
        return [(up @ low.T + down @ high.T, up @ high.T + down @ low.T) for low, high in self.levels]


class Found:
    """The first k (score, id) so far, in order."""

    __slots__ = ("k", "scores", "ids")

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0), np.zeros(0, np.int64)

    def least(self) -> float | None:
        """The k-th score, if there are k."""
        return self.scores[-1] if len(self.ids) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        least = self.least()
        if least is not None:
            better = scores >= least
            scores, ids = scores[better], ids[better]
        if not len(ids):
            return
        if len(ids) > 4 * self.k:
            enough = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[enough], ids[enough]
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        if scores.dtype == object:
            order = np.array(sorted(range(len(ids)), key=lambda k: (-scores[k], ids[k]))[: self.k])
        else:
            order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def search(tree: Tree, bounds: list[tuple[np.ndarray, np.ndarray]], rows_of, found: Found, lowest: float | None, highest: float | None) -> None:
    """Best first through the tree: ``bounds`` are one anchor's, ``rows_of(leaf)`` its (scores, ids) there."""
    top = len(tree.levels) - 1

    def entries(level: int, first: int, end: int) -> Iterator[tuple]:
        low, high = bounds[level][0][first:end], bounds[level][1][first:end]
        fits = np.ones(len(low), bool)
        if lowest is not None:
            fits = (high >= lowest) & (low <= highest)
            high = np.minimum(high, highest)
        least = found.least()
        if least is not None:
            fits &= high >= least
        for k in np.flatnonzero(fits).tolist():
            yield -high[k], level, first + k

    queue = list(entries(top, 0, len(tree.levels[top][0])))
    heapq.heapify(queue)
    while queue:
        bound, level, node = heapq.heappop(queue)
        least = found.least()
        if least is not None and -bound < least:
            return
        if level:
            for entry in entries(level - 1, node * FAN, (node + 1) * FAN):
                heapq.heappush(queue, entry)
            continue
        scores, ids = rows_of(node)
        if lowest is not None:
            inside = (scores >= lowest) & (scores <= highest)
            scores, ids = scores[inside], ids[inside]
        found.add(scores, ids)


def exact(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 64-bit floats hold all inner products of rows of a and b exactly, in any order of summation."""
    return not (a.size and b.size) or float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[-1] < _EXACT


def as_integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x.tolist()], dtype=object).reshape(x.shape)


class Anchors:
    """A block of anchors, as sent to the workers; with ``windows``, those of its positives."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, windows: dict[int, list[tuple]] | None = None):
        self.ids, self.labels, self.x, self.windows = ids, labels, x, windows


def window(score: int) -> tuple[int, int]:
    """Lowest and highest whole score of a negative."""
    return -(-LOW * score // 100), HIGH * score // 100


def _trees(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[Tree]:
    """The leaves of some batches as trees, about ``ROWS_AT_ONCE`` rows each."""
    held, n = [], 0

    def tree() -> Tree:
        rows = [(np.frombuffer(i, np.int64), np.frombuffer(c, np.int64), np.frombuffer(v, np.float64).reshape(-1, width)) for i, c, v, *_ in held]
        boxes = (np.array([np.frombuffer(h[k], np.float64) for h in held]) for k in (3, 4))
        return Tree(*map(list, zip(*rows)), *boxes)

    for batch in batches:
        for leaf in zip(*(batch[c].to_pylist() for c in ("ids", "labels", "vectors", "low", "high"))):
            held.append(leaf)
            n += len(leaf[0]) // 8
            if n >= ROWS_AT_ONCE:
                yield tree()
                held, n = [], 0
    if held:
        yield tree()


def _searched(sent, width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, its label, positive, score of the positive, id, score) of what the task's leaves hold.

    Without windows: rows of the anchor's label (no positive). With them: rows of other labels.
    """
    block: Anchors = sent.value
    wanted = {}  # number of the anchor, positive -> what was found
    for tree in _trees(width, batches):
        x = block.x
        floats = exact(x, np.stack(tree.levels[0]))
        if not floats:
            x = as_integers(x)
            tree.vectors = [as_integers(v) for v in tree.vectors]
            tree.levels = [(as_integers(low), as_integers(high)) for low, high in tree.levels]
        for a in range(0, len(x), 256):
            bounds = tree.bounds(x[a : a + 256])
            for k in range(a, min(a + 256, len(x))):
                own = [(low[k - a], high[k - a]) for low, high in bounds]
                seen = {}

                def rows_of(leaf: int, k=k, seen=seen) -> tuple[np.ndarray, np.ndarray]:
                    if leaf not in seen:
                        use = tree.labels[leaf] == block.labels[k] if block.windows is None else tree.labels[leaf] != block.labels[k]
                        use &= tree.ids[leaf] != block.ids[k]
                        seen[leaf] = tree.vectors[leaf][use] @ x[k], tree.ids[leaf][use]
                    return seen[leaf]

                if block.windows is None:
                    search(tree, own, rows_of, wanted.setdefault((k, None, None), Found(POSITIVES)), None, None)
                    continue
                for positive, score in block.windows.get(int(block.ids[k]), ()):
                    lowest, highest = window(score)
                    if lowest <= highest:
                        search(tree, own, rows_of, wanted.setdefault((k, positive, score), Found(NEGATIVES)), lowest, highest)
    rows = [
        (int(block.ids[k]), positive, None if score is None else str(score), int(i), str(int(s)))
        for (k, positive, score), f in wanted.items()
        for s, i in zip(f.scores.tolist(), f.ids.tolist())
    ]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    columns = zip(*rows) if rows else [()] * len(types)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["anchor_id", "positive_id", "positive_score", "id", "score"])


_FOUND = "anchor_id long, positive_id long, positive_score string, id long, score string"
_WHOLE = "decimal(38,0)"


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    found = found.withColumn("score", F.col("score").cast(_WHOLE))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def index(rows: DataFrame) -> tuple[DataFrame, int]:
    """(leaves of the packed tree as a written table, number of coordinates) of ``usable`` rows."""
    n, width = rows.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    if not n:
        return rows.sparkSession.createDataFrame([], _LEAVES), 1
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(-(-n // ROWS_FOR_AXES))) == 0)
    spread = some.select(F.posexplode("vector").alias("axis", "x")).groupBy("axis").agg(F.var_pop("x").alias("v"))
    axes = [r["axis"] for r in spread.orderBy(F.desc("v"), "axis").collect()] or [0]  # one row per coordinate
    if width:
        parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        slabs = max(-(-n // ROWS_PER_SLAB), min(-(-n // ROWS_AT_ONCE), parts))
        along = F.coalesce(F.get("vector", F.lit(axes[0])), F.lit(0.0))
        rows = rows.withColumn("along", along).repartitionByRange(slabs, "along", "vec_id")
    return written(rows.select("vec_id", "label", "vector").mapInArrow(partial(_pack, axes[1:] or axes, max(width, 1)), _LEAVES), "leaves"), max(width, 1)


def mine(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    rows = usable(rows.select("vec_id", "label", "embedding"))
    leaves, width = index(rows)
    anchors = rows.where(F.col("vec_id") % ANCHOR_STEP == 0)
    blocks = max(1, -(-anchors.count() * width * 8 // ANCHOR_BYTES))
    anchors = written(anchors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "anchors")
    path = work_dir(spark, "negatives")
    for number in range(blocks):
        block = _block(anchors.where(F.col("block") == number), width)
        near = leaves.mapInArrow(partial(_searched, spark.sparkContext.broadcast(block), width), _FOUND)
        positives = _first(near, ["anchor_id"], POSITIVES).select("anchor_id", "id", "score")
        block.windows = {}
        for r in positives.toArrow().to_pylist():  # POSITIVES rows for each anchor of the block at most
            block.windows.setdefault(r["anchor_id"], []).append((r["id"], int(r["score"])))
        found = leaves.mapInArrow(partial(_searched, spark.sparkContext.broadcast(block), width), _FOUND)
        found = _first(found, ["anchor_id", "positive_id"], NEGATIVES).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
            F.col("positive_score").cast(_WHOLE).alias("positive_score"), F.col("score").alias("negative_score"),
        )
        found.write.parquet(f"{path}/block={number}")
    return spark.read.schema(found.schema).parquet(path).select(*found.columns)


def _block(anchors: DataFrame, width: int) -> Anchors:
    rows = anchors.select("vec_id", "label", "vector").toArrow().sort_by("vec_id").combine_chunks()
    return Anchors(rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(_array(rows["vector"]), width))


def _array(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
