"""Versioned models with their metrics: one Parquet row per version, no pickles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.config import small_frame
from streamlab.operators.linear import Model, Scaler
from streamlab.sinks.paths import Record, numbered, remove

_MODEL = (
    "versao long, atributos array<string>, media array<double>, desvio array<double>, "
    "pesos array<double>, vies double, lotes long, vistos long, acuracia double, ts timestamp"
)
_METRICS = (
    T.StructType().add("lote", "long").add("pacientes_vistos", "long").add("acuracia", "double")
)
RANGE = 100  # versions per folder


class ModelStore:
    """A row holds a model and the metrics it was stored with, so neither exists without the other.

    Versions are numbers; those of one range of ``RANGE`` lie under ``abertas/faixa=<k>``. When the
    first version of the next range comes, the rows of a range are folded into one file under
    ``fechadas``. A small record names the two newest versions and the first open range: a version
    counts once it is named, saving and loading one list nothing, and a reader lists one range.
    Saving a version again replaces it; one of a folded range, as after an older checkpoint was
    restored, is kept aside and named in the record.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._record = Record(spark, f"{self.path}/registro")

    def record(self) -> dict:
        """``versoes`` (the newest two, ascending), ``aberta`` (the first range that isn't folded) and
        ``limpa`` (the first range whose single folders weren't deleted), ``dobradas`` (folded
        ranges that hold versions) and ``emendas`` (versions saved after their range was folded)."""
        return self._record.read() or {"versoes": [], "aberta": 0, "limpa": 0, "dobradas": 0, "emendas": []}

    def _folder(self, version: int, record: dict) -> str:
        part = "emendas" if version in record["emendas"] else f"abertas/faixa={version // RANGE}"
        return f"{self.path}/{part}/versao={version}"

    def save(self, model: Model, accuracy: float | None) -> None:
        """One write and one record: a crash in between leaves neither model nor metrics."""
        record = self.record()
        if model.version // RANGE < record["aberta"]:
            record["emendas"] = sorted({*record["emendas"], model.version})

        def doubles(values):
            return F.array(*[F.lit(float(v)) for v in values])

        row = {
            "versao": F.lit(model.version).cast("long"),
            "atributos": F.array(*[F.lit(f) for f in model.scaler.features]),
            "media": doubles(model.scaler.mean),
            "desvio": doubles(model.scaler.std),
            "pesos": doubles(model.weights),
            "vies": F.lit(model.bias),
            "lotes": F.lit(model.batches).cast("long"),
            "vistos": F.lit(model.seen).cast("long"),
            "acuracia": F.lit(accuracy).cast("double"),
            "ts": F.current_timestamp(),
        }
        df = self.spark.range(0, 1, 1, 1).select(*[c.alias(n) for n, c in row.items()])
        df.write.mode("overwrite").parquet(self._folder(model.version, record))
        record["versoes"] = sorted({*record["versoes"], model.version})[-2:]
        self._record.write(record)
        if record["versoes"][-1] // RANGE > record["aberta"]:
            self._fold(record)

    def _fold(self, record: dict) -> None:
        """Fold the ranges before the newest version's; folders of ranges before both versions' go."""
        first, end = record["aberta"], record["versoes"][-1] // RANGE
        for k in range(first, end):
            versions = numbered(self.spark, f"{self.path}/abertas/faixa={k}", "versao")
            if versions:
                rows = self._read([f"{self.path}/abertas/faixa={k}/versao={v}" for v in versions])
                rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/fechadas/faixa={k}")
                record["dobradas"] += 1
        gone = range(record["limpa"], record["versoes"][0] // RANGE)
        self._record.write(record | {"aberta": end, "limpa": max(record["limpa"], gone.stop)})
        for k in gone:
            remove(self.spark, f"{self.path}/abertas/faixa={k}")

    def _read(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(_MODEL).parquet(*folders)

    def rows(self) -> DataFrame:
        """One row per version that counts."""
        record = self.record()
        if not record["versoes"]:
            return small_frame(self.spark, [], T.StructType.fromDDL(_MODEL))
        parts = []
        if record["dobradas"]:
            folded = self.spark.read.schema(_MODEL).parquet(f"{self.path}/fechadas/faixa=*")
            parts.append(folded.where((F.col("versao") < record["aberta"] * RANGE) & ~F.col("versao").isin(record["emendas"])))
        parts += [self._read([self._folder(v, record) for v in record["emendas"]])] if record["emendas"] else []
        last = record["versoes"][-1]
        for k in range(record["aberta"], last // RANGE + 1):
            found = numbered(self.spark, f"{self.path}/abertas/faixa={k}", "versao")
            folders = [self._folder(v, record) for v in found if v <= last]
            parts += [self._read(folders)] if folders else []
        return reduce(DataFrame.unionByName, parts)

    def latest(self, before: int | None = None) -> Model | None:
        """Newest model, or the newest one older than version ``before``."""
        record = self.record()
        named = [v for v in record["versoes"] if before is None or v < before]
        if named:
            r = self._read([self._folder(named[-1], record)]).first()
        elif before is None:
            return None
        else:  # older than both: an old checkpoint was restored
            r = self.rows().where(F.col("versao") < before).orderBy(F.desc("versao")).first()
        if r is None:
            return None
        scaler = Scaler(tuple(r["atributos"]), tuple(r["media"]), tuple(r["desvio"]))
        return Model(scaler, tuple(r["pesos"]), r["vies"], r["versao"], r["lotes"], r["vistos"])

    def history(self) -> DataFrame:
        """(batch, rows seen, accuracy) of every version, oldest first."""
        names = [F.col(c).alias(n) for c, n in zip(("versao", "vistos", "acuracia"), _METRICS.names)]
        return self.rows().select(*names).orderBy("lote")

    def artifact_counts(self) -> DataFrame:
        """Stored models and metrics, and the training rows that the newest one has seen."""
        kinds = F.explode(F.array(F.lit("models"), F.lit("metrics"))).alias("tipo")
        counted = self.rows().select(kinds, "vistos").groupBy("tipo")
        return counted.agg(F.count(F.lit(1)).alias("total"), F.max("vistos").alias("vistos"))
