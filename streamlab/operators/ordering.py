"""Top-n reports: per-task top-n, then one merge of at most tasks x n rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def latest(df: DataFrame, time: str = "coletado_em", n: int = 10, tie: str = "ticker") -> DataFrame:
    """The newest ``n`` rows; rows of equal time are ordered by ``tie``."""
    return df.orderBy(F.desc(time), F.asc(tie)).limit(n)


FIRST, LAST = "primeiros", "ultimos"


def both_ends(df: DataFrame, key: str, n: int = 5, part: str = "parte") -> DataFrame:
    """The first and the last ``n`` rows in the order of ``key``, in one pass over ``df``.

    Each task keeps n rows of either end; at most 2 n per task are merged. The order is Spark's:
    NULL before all values, NaN after them. A row can be at both ends of a small table.
    """
    schema = StructType([StructField(part, StringType()), *df.schema.fields])

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, pa.Table] = {}
        for batch in batches:
            for end, way in ((FIRST, "ascending"), (LAST, "descending")):
                rows = pa.Table.from_batches([batch])
                rows = pa.concat_tables([held[end], rows]) if end in held else rows
                values = rows[key]
                nan = pc.is_nan(values) if pa.types.is_floating(values.type) else pc.is_null(values)
                by = pa.table([pc.is_valid(values).cast(pa.int8()), pc.fill_null(nan, False).cast(pa.int8()), values], ["set", "nan", "value"])
                order = pc.sort_indices(by, sort_keys=[(c, way) for c in by.column_names])
                held[end] = rows.take(order[:n])
        for end, rows in held.items():
            yield from rows.add_column(0, part, pa.array([end] * len(rows), pa.string())).combine_chunks().to_batches()

    kept = df.mapInArrow(ends, schema)
    place = {c: F.row_number().over(Window.partitionBy(part).orderBy(o)) for c, o in (("_de", F.asc(key)), ("_ate", F.desc(key)))}
    wanted = F.when(F.col(part) == FIRST, F.col("_de")).otherwise(F.col("_ate")) <= n
    return kept.withColumns(place).where(wanted).drop("_de", "_ate")


def preview(df: DataFrame, key: str, n: int = 5, last: bool = False) -> DataFrame:
    """The first, or the last, ``n`` rows in the order of ``key``."""
    return df.orderBy(F.desc(key) if last else F.asc(key)).limit(n)
