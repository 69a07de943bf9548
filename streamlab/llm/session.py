"""Shared folders of the text operators, and columns computed by Python in small batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.config import work_dir


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: lineage ends there."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


ROWS_AT_ONCE = 1_024


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that what is made of one of them stays small."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
        pa.default_memory_pool().release_unused()  # workers live on after their task


def with_python(df: DataFrame, inputs: list[str], outputs: dict[str, T.DataType], make: Callable) -> DataFrame:
    """``df`` with the columns that ``make`` returns for slices of the input columns.

    Columns named like an output are replaced. Unlike a UDF's, the batches that go back may be
    smaller than those that came.
    """
    kept = [c for c in df.columns if c not in outputs]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(c, t) for c, t in outputs.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            made = make(*(part[c] for c in inputs))
            yield pa.RecordBatch.from_arrays([*(part[c] for c in kept), *made], [*kept, *outputs])

    return df.mapInArrow(run, schema)


def one_text_per_id(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose text is the document of their id, all other rows) of (doc_id, text, ...).

    Where an id has several texts, the smallest by hash is the document. Rows with a NULL id are
    among the others. Ids with one text, the usual case, are not shuffled.
    """
    own, aside = docs.where("doc_id is not null"), docs.where("doc_id is null")
    by_text = F.xxhash64("text")
    torn = own.groupBy("doc_id").agg(F.min(by_text).alias("_low"), F.max(by_text).alias("_high")).where("_low < _high")
    torn = written(torn.select("doc_id", "_low"), "torn")
    if torn.count():
        split = own.join(torn, "doc_id", "left").withColumn("_main", F.coalesce(by_text == F.col("_low"), F.lit(True)))
        own, aside = split.where("_main").select(*docs.columns), aside.unionAll(split.where("not _main").select(*docs.columns))
    return own, aside


MOST_BITS = 31  # of a table that is sent to the workers: 256 MB
BITS_EACH = 16


def table_bits(entries: int, least: int = 16) -> int:
    """Size (as a power of two) of a bit table of so many hashes: at most one bit in 16 is set.

    Beyond 2^27 entries the table fills up; what it lets through is then looked at in vain.
    """
    return min(MOST_BITS, max(least, (BITS_EACH * entries).bit_length()))


_PAGE_BITS = 13


def bit_table(places: DataFrame, bits: int) -> np.ndarray:
    """Packed bits, 2 ** bits of them, set at the values of the only column (long).

    Pages of the table are put together by tasks; no more than the table itself comes to the driver.
    """
    page, at = F.shiftright("place", _PAGE_BITS), F.col("place").bitwiseAND(F.lit((1 << _PAGE_BITS) - 1)).cast("short")
    pages = places.toDF("place").groupBy(page.alias("page")).agg(F.collect_set(at).alias("at"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_of = []
            for at in batch["at"]:
                marked = np.zeros(1 << _PAGE_BITS, bool)
                marked[at.values.to_numpy()] = True
                bytes_of.append(np.packbits(marked, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch["page"], pa.array(bytes_of, pa.binary())], ["page", "bits"])

    table, step = np.zeros((1 << bits) >> 3, np.uint8), (1 << _PAGE_BITS) >> 3
    for page, found in pages.mapInArrow(packed, "page long, bits binary").toLocalIterator():
        table[page * step : (page + 1) * step] = np.frombuffer(found, np.uint8)
    return table


def is_set(table: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (table[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0


class IdTable:
    """Rows whose id may be among ``ids``: a bit table sized by their number, sent to the workers.

    Ids in it are always let through; others with a chance of one in 16. NULL ids are in no table.
    """

    def __init__(self, ids: DataFrame):
        self.bits = table_bits(ids.count())
        self.sent = ids.sparkSession.sparkContext.broadcast(bit_table(ids.select(self._place()), self.bits))

    def _place(self) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long")), 64 - self.bits)

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(rows that may be in it, rows that are not), without a shuffle."""
        place = F.when(F.col("doc_id").isNotNull(), self._place()).otherwise(F.lit(-1))
        known = df.withColumn(_PLACE, place)
        return tuple(known.mapInArrow(partial(_kept, self.sent, wanted), known.schema).drop(_PLACE) for wanted in (True, False))


_PLACE = "__place_in_id_table"


def _kept(sent, wanted: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        at = batch[_PLACE].to_numpy()
        inside = (at >= 0) & is_set(sent.value, np.maximum(at, 0))
        yield batch.filter(pa.array(inside == wanted))
