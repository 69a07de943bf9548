"""Patients: online logistic training on a stream, a model version and metrics per batch."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlab.config import JobSettings, build_session
from streamlab.functions import drop_zero_missing
from streamlab.operators.linear import (
    FEATURES, Model, Scaler, accuracy, fit_scaler, predict, train_step,
)
from streamlab.operators.sampling import assign_minibatch, stratified_split
from streamlab.schemas import PATIENT, PATIENT_BASE
from streamlab.sinks import ModelStore
from streamlab.sources import read_csv_named, read_json_stream
from streamlab.streaming import run_stream, start_batches

# Classes, test share and split seed.
CLASSES = (0, 1)
TEST_SHARE = 0.25
SPLIT_SEED = 42
CHUNK = 30


def split_base(patients: DataFrame, key: str, path: str) -> DataFrame:
    """Clean the base, write it to ``path`` and mark the test rows.

    The split reads its input three times, so it starts from the few written columns
    instead of repeating whatever plan ``patients`` stands for.
    """
    clean = drop_zero_missing(patients, FEATURES)
    clean.write.mode("overwrite").parquet(path)
    clean = patients.sparkSession.read.schema(clean.schema).parquet(path)
    row = F.concat_ws(":", "_metadata.file_name", "_metadata.row_index")
    return stratified_split(clean, "outcome", key, CLASSES, TEST_SHARE, SPLIT_SEED, row)


def write_split(patients: DataFrame, key: str, path: str) -> tuple[DataFrame, DataFrame]:
    """Clean, split and write the base once; (training rows, test rows) as read back.

    Every later batch scores the test rows, so they are a table, not a plan to repeat.
    """
    split = split_base(patients, key, f"{path}/limpos")
    split.write.mode("overwrite").partitionBy("em_teste").parquet(f"{path}/divididos")
    written = patients.sparkSession.read.schema(split.schema).parquet(f"{path}/divididos")
    return tuple(written.where(F.col("em_teste") == t).drop("em_teste") for t in (False, True))


def deliver(train: DataFrame, key: str, path: str, arrivals: str, size: int = CHUNK) -> None:
    """The training part as the arrivals of the stream: seeded chunks of ``size`` records, JSON files
    under ``arrivals/lote=<k>``. A chunk lies in one file, or in a few where it is split by ranges."""
    chunks = assign_minibatch(train, key, path, size)
    chunks.select("lote", *PATIENT.names).write.mode("overwrite").partitionBy("lote").json(arrivals)


@dataclass
class Trainer:
    """``foreachBatch`` handler: one model version per micro-batch.

    The starting point is the newest version below the batch number, so a restart goes on
    from the stored model and a replayed batch repeats its own step.
    """

    store: ModelStore
    scaler: Scaler
    test_set: DataFrame
    steps: int = 5
    rate: float = 0.5

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        start = self.store.latest(before=batch_id) or Model.untrained(self.scaler)
        rows = batch.select(*FEATURES, "outcome")
        if self.steps > 1:
            rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        model = train_step(rows, start, rate=self.rate, steps=self.steps)
        rows.unpersist()
        if model is start:
            return
        model = replace(model, version=batch_id)
        score = accuracy(predict(self.test_set, model)).first()["acuracia"]
        self.store.save(model, score)


def start_training(
    patients: DataFrame, trainer: Trainer, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    return start_batches(patients, trainer, checkpoint, seconds=seconds)


def start(spark: SparkSession, settings: JobSettings) -> StreamingQuery:
    out = settings.output_dir
    base = read_csv_named(spark, settings.base_csv, PATIENT_BASE)
    # the base carries no id: the row content stands in for one
    keyed = base.withColumn("chave", F.sha2(F.to_json(F.struct(*base.columns)), 256))
    train, test = write_split(keyed, "chave", f"{out}/base")
    trainer = Trainer(ModelStore(spark, out), fit_scaler(train), test)
    stream = read_json_stream(spark, settings.stream_dir, PATIENT, *settings.pace())
    checkpoint = settings.checkpoint_dir or f"{out}/checkpoint"
    return start_training(stream, trainer, checkpoint, settings.trigger_seconds or None)


def main() -> None:
    settings = JobSettings.from_env(trigger_seconds=4)
    run_stream(start(build_session("diabetes", settings), settings))


if __name__ == "__main__":
    main()
