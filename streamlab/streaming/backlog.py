"""A backlog as many micro-batches in the order of its events."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlab.sinks.paths import Record, numbered
from streamlab.streaming.runtime import run_stream

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
_PARTS = 8  # tasks that write a slice


def to_bytes(text: str) -> int:
    """Bytes of a volume such as ``512m`` or ``1g``."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([bkmgt]?)b?\s*", text.lower()).groups()
    return int(number) * _UNITS[unit]


def drain_in_order(
    rows: DataFrame,
    time: str,
    path: str,
    slices: int,
    start: Callable[[DataFrame], StreamingQuery],
) -> list[StreamingQuery]:
    """Deliver bounded ``rows`` to a stream in ``slices`` micro-batches of about equal size.

    Files of a backlog overlap in time, so whatever the order of files, cutting them into batches
    would make rows late. The rows are dealt out by event time once, to ``path/fatia=<k>``; rows
    without a time come first. ``start`` then runs on one slice after the other with one checkpoint.
    No row is older than a slice before its own, so none is late. Times that many rows share may
    span slices: a window is open at least until its own time has passed.

    A record beside the slices says how many are done; a drain that was interrupted goes on with the
    slice it was in, whose files the checkpoint knows.
    """
    spark = rows.sparkSession
    record = Record(spark, f"{path}/_registro")
    done = record.read()
    if done is None:
        order = [F.col(time), F.monotonically_increasing_id()]
        dealt = rows.repartitionByRange(slices * _PARTS, *order)
        number = F.floor(F.spark_partition_id() / F.lit(_PARTS)).cast("int")
        dealt.withColumn("fatia", number).write.mode("overwrite").partitionBy("fatia").parquet(path)
        done = {"feitas": 0}
        record.write(done)
    queries = []
    for k in numbered(spark, path, "fatia", committed=False):
        if k < done["feitas"]:
            continue
        queries.append(run_stream(start(spark.readStream.schema(rows.schema).parquet(f"{path}/fatia={k}"))))
        record.write({"feitas": k + 1})
    return queries
