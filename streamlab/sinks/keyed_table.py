"""A table with one current row per key, fed by micro-batches of absolute values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from streamlab.config import small_frame
from streamlab.sinks.paths import Record, observed, remove

_VERSION = "_versao"
_BUCKET = "_balde"
KEPT_RECORDS = 2  # replaced folders stay for so many further batches


class KeyedTable:
    """Upserts by key over plain Parquet folders, the keys hashed to buckets.

    A batch writes only its own rows, to ``lote=<batch id>`` with a folder per bucket it touches.
    Once a bucket consists of ``compact_every`` folders it is rewritten as one, and only it: the
    others stay as they are. One small record names the folders of every bucket. Readers take, per
    key, the values of the newest batch among them, so nothing is ever listed and the cost of a
    batch doesn't depend on how many came before.

    A batch counts once the record names it; replaying it overwrites its folder and changes
    nothing else. Folders that a rewrite replaced are deleted ``KEPT_RECORDS`` batches later, so a
    reader has that long to finish.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        schema: StructType,
        compact_every: int = 50,
        files: int | None = None,
        buckets: int = 8,
    ):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema, self.compact_every, self.files, self.buckets = schema, compact_every, files, buckets
        self.values = [f.name for f in schema.fields if f.name not in self.keys]
        self._stored = StructType([*schema.fields, *StructType().add(_VERSION, LongType()).fields])
        self._record = Record(spark, f"{self.path}/registro")

    def record(self) -> dict:
        """What the table consists of: run, newest batch, bucket -> folders, replaced folders."""
        return self._record.read() or self._empty(0)

    def _empty(self, run: int) -> dict:
        return {"rodada": run, "lote": -1, "de": self.buckets, "baldes": {}, "trocadas": [], "juntos": 0}

    def _root(self, record: dict) -> str:
        return f"{self.path}/rodada={record['rodada']}"

    def upsert(self, rows: DataFrame, batch_id: int, order_by: str | None = None) -> None:
        """Write one batch. Keys must be unique in it unless ``order_by`` picks the last.

        The rows are computed once. A batch that the record already counts is computed all the
        same, where no reader looks: skipping it would leave the state of a stateful stream
        uncommitted. An empty batch leaves no folder.
        """
        record = self.record()
        root, old = self._root(record), batch_id <= record["lote"]
        if order_by:
            last = [F.max_by(c, F.col(order_by)).alias(c) for c in self.values]
            rows = rows.groupBy(*self.keys).agg(*last)
        seen = Observation()
        version, bucket = F.lit(batch_id).cast("long").alias(_VERSION), self._bucket(record).alias(_BUCKET)
        out = rows.select(*self.schema.names, version, bucket)
        out = out.observe(seen, F.count(F.lit(1)).alias("linhas"), F.collect_set(_BUCKET).alias("baldes"))
        folder = f"{'repetido' if old else 'lote'}={batch_id}"
        self._write(out, f"{root}/{folder}")
        found = observed(seen)
        if old or not found.get("linhas"):
            remove(self.spark, f"{root}/{folder}")
        if old:
            return
        for b in found.get("baldes", ()):
            record["baldes"].setdefault(str(b), []).append(folder)
        record["lote"] = batch_id
        full = [b for b, folders in record["baldes"].items() if len(folders) >= self.compact_every]
        self._replace(record, full)

    def _write(self, df: DataFrame, folder: str) -> None:
        # without a fixed count, adaptive execution sizes the files of a bucket
        df = df.repartition(self.files, _BUCKET) if self.files else df.hint("rebalance", _BUCKET)
        df.write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)

    def _replace(self, record: dict, buckets: list[str]) -> None:
        """Rewrite some buckets as one folder each and count what ``record`` holds."""
        root, batch = self._root(record), record["lote"]
        if buckets:
            record["juntos"] += 1
            folder = f"junto={record['juntos']}"
            merged = self._rows(record, buckets)
            self._write(merged, f"{root}/{folder}")
            for b in buckets:
                record["trocadas"] += [[f, b, batch] for f in record["baldes"][b]]
                record["baldes"][b] = [folder]
        due = [t for t in record["trocadas"] if t[2] <= batch - KEPT_RECORDS]
        record["trocadas"] = [t for t in record["trocadas"] if t[2] > batch - KEPT_RECORDS]
        self._record.write(record)
        used = {f for folders in record["baldes"].values() for f in folders} | {t[0] for t in record["trocadas"]}
        for f, b, _ in due:
            remove(self.spark, f"{root}/{f}" if f not in used else f"{root}/{f}/{_BUCKET}={b}")

    def _rows(self, record: dict, buckets: list[str]) -> DataFrame:
        """Newest values of each key of these buckets, with version and bucket."""
        root = self._root(record)
        folders = [f"{root}/{f}/{_BUCKET}={b}" for b in buckets for f in record["baldes"][b]]
        if not folders:
            return small_frame(self.spark, [], self._stored).withColumn(_BUCKET, F.lit(0))
        rows = self.spark.read.schema(self._stored).parquet(*folders)
        if any(len(record["baldes"][b]) > 1 for b in buckets):
            newest = [F.max_by(c, _VERSION).alias(c) for c in self.values]
            rows = rows.groupBy(*self.keys).agg(*newest, F.max(_VERSION).alias(_VERSION))
        return rows.withColumn(_BUCKET, self._bucket(record))

    def _bucket(self, record: dict) -> Column:
        # the number of buckets stays what it was when the table began
        return F.pmod(F.xxhash64(*self.keys), F.lit(record["de"])).cast("int")

    def read_current(self) -> DataFrame:
        """One row per key: the newest committed values."""
        record = self.record()
        return self._rows(record, list(record["baldes"])).select(*self.schema.names)

    def compact(self) -> None:
        """Rewrite every bucket that has more than one folder."""
        record = self.record()
        self._replace(record, [b for b, folders in record["baldes"].items() if len(folders) > 1])

    def reset(self) -> None:
        """Start an empty run; the folders of the run before it are deleted."""
        record = self.record()
        self._record.write(self._empty(record["rodada"] + 1))
        remove(self.spark, self._root(record))
