"""Rows that come too late for their window, kept beside the rows that don't."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlab.sinks.paths import Record, observed, remove

ON_TIME, LATE, NO_TIME = "no_prazo", "atrasada", "sem_hora"


def micros(spark: SparkSession, interval: str) -> int:
    return spark.sql(f"SELECT unix_micros(timestamp_seconds(0) + INTERVAL {interval})").first()[0]


def _window_end(time: str, size: int) -> Column:
    """End of the tumbling window, in microseconds; NULL without a time."""
    at = F.unix_micros(F.col(time))
    return at - F.pmod(at, F.lit(size)) + size


class LateSplit:
    """``foreachBatch`` handler: splits arrivals by the watermark, ahead of any aggregation.

    The watermark of a batch is the largest event time of all batches before it, less ``delay``;
    a row is late once its window of ``size`` ends at or before it. Every row is written once, to
    ``lote=<batch>/situacao=<no_prazo | atrasada | sem_hora>``, with the watermark as ``limite``:
    nothing is dropped and no count is an estimate. The rows are computed once.

    A small record holds the newest batch and the largest time. A batch that it names is not
    written again, one that it doesn't name is, so ``then``, which runs after each batch, only ever
    meets whole batches: a query that it drains over ``on_time`` sees every row exactly once, and
    its own watermark, being later than none of these, drops none of them.
    """

    def __init__(self, spark: SparkSession, path: str, time: str, delay: str, size: str, then: Callable[[], None] | None = None):
        self.spark, self.path, self.time, self.then = spark, path.rstrip("/"), time, then
        self.delay, self.size = micros(spark, delay), micros(spark, size)
        self._record = Record(spark, f"{self.path}/_registro")

    def record(self) -> dict:
        """Newest batch, largest event time (microseconds) and rows so far, by situation."""
        return self._record.read() or {"lote": -1, "maior": None, "linhas": 0, "atrasadas": 0, "sem_hora": 0}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        record = self.record()
        if batch_id > record["lote"]:
            self._record.write(self._split(batch, batch_id, record))
        if self.then and self.record()["linhas"]:
            self.then()

    def _split(self, batch: DataFrame, batch_id: int, record: dict) -> dict:
        limit = F.lit(None if record["maior"] is None else record["maior"] - self.delay).cast("long")
        late = F.coalesce(_window_end(self.time, self.size) <= limit, F.lit(False))
        kind = F.when(F.col(self.time).isNull(), NO_TIME).when(late, LATE).otherwise(ON_TIME)
        seen, folder = Observation(), f"{self.path}/lote={batch_id}"
        out = batch.withColumns({"limite": F.timestamp_micros(limit), "situacao": kind}).observe(
            seen,
            F.count(F.lit(1)).alias("linhas"),
            F.count_if(F.col("situacao") == LATE).alias("atrasadas"),
            F.count_if(F.col("situacao") == NO_TIME).alias("sem_hora"),
            F.max(F.unix_micros(F.col(self.time))).alias("maior"),
        )
        out.write.mode("overwrite").partitionBy("situacao").parquet(folder)
        found = observed(seen)
        if not found.get("linhas"):
            remove(self.spark, folder)
        largest = [t for t in (record["maior"], found.get("maior")) if t is not None]
        counts = {c: record[c] + (found.get(c) or 0) for c in ("linhas", "atrasadas", "sem_hora")}
        return {"lote": batch_id, "maior": max(largest, default=None)} | counts

    def on_time(self, schema: StructType) -> DataFrame:
        """The rows in time, as a stream; its files appear batch by batch."""
        return self.spark.readStream.schema(schema).parquet(f"{self.path}/lote=*/situacao={ON_TIME}")

    def rows(self, schema: StructType, kind: str = LATE) -> DataFrame:
        """The rows of one situation with ``lote`` and ``limite``, the watermark they met."""
        whole = StructType(list(schema.fields)).add("limite", "timestamp").add("lote", "long").add("situacao", "string")
        return self.spark.read.schema(whole).parquet(self.path).where(F.col("situacao") == kind).drop("situacao")
