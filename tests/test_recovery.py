"""A batch that fails after its sink has written is replayed; the effect stays exactly once."""

import pytest
from conftest import rows

from streamlab.operators import linear
from streamlab.operators.tally import running_count
from streamlab.plans.patients import Trainer
from streamlab.plans.votes import stamped, tally_table
from streamlab.schemas import PATIENT, POST, VOTE
from streamlab.sinks import ModelStore, append_batch, append_csv, read_csv_results
from streamlab.sources import read_json_stream
from streamlab.streaming import run_stream, start_batches


class Crash:
    """Run the sink, then fail the first time batch ``at`` comes by."""

    def __init__(self, sink, at):
        self.sink, self.at, self.calls = sink, at, []

    def __call__(self, batch, batch_id):
        self.sink(batch, batch_id)
        self.calls.append(batch_id)
        if self.calls.count(self.at) == 1 and batch_id == self.at:
            raise RuntimeError("executor lost")


def run_twice(stream, handler, checkpoint, mode="append"):
    with pytest.raises(Exception, match="executor lost"):
        run_stream(start_batches(stream, handler, checkpoint, mode))
    run_stream(start_batches(stream, handler, checkpoint, mode))
    assert handler.calls.count(handler.at) == 2


def test_append_sinks(spark, deliver, tmp_path):
    for n in range(3):
        folder = deliver("p", *[{"id": f"{n}{i}", "texto": "a\nb"} for i in range(4)])
    stream = read_json_stream(spark, folder, POST, max_files=1)
    parquet, csv = str(tmp_path / "parquet"), str(tmp_path / "csv")
    run_twice(stream, Crash(lambda b, n: append_batch(b, parquet, n), 1), str(tmp_path / "c1"))
    run_twice(stream, Crash(lambda b, n: append_csv(b, csv, n), 1), str(tmp_path / "c2"))
    want = sorted(f"{n}{i}" for n in range(3) for i in range(4))
    assert [r.id for r in spark.read.parquet(parquet).orderBy("id").collect()] == want
    assert [r.id for r in read_csv_results(spark, csv, POST).orderBy("id").collect()] == want


def test_running_count_with_compaction(spark, deliver, tmp_path):
    for n in range(5):
        folder = deliver("v", *[{"estado": "SP", "candidato": "AB"[(n + i) % 2]} for i in range(3)], {"estado": f"E{n}", "candidato": "A"})
    stream = running_count(read_json_stream(spark, folder, VOTE, max_files=1), ["estado", "candidato"])
    table = tally_table(spark, str(tmp_path / "t"), compact_every=2)
    run_twice(stream, Crash(lambda b, n: table.upsert(stamped(b), n), 3), str(tmp_path / "c"), "update")
    want = {f"E{n}|A": 1 for n in range(5)} | {"SP|A": 8, "SP|B": 7}
    assert {r._id: r.votos for r in table.read_current().collect()} == want


def test_training_matches_an_undisturbed_run(spark, deliver, tmp_path):
    data = [(100.0 + 7 * i, 25.0 + i, int(i > 5)) for i in range(12)]
    for n in range(3):
        folder = deliver("s", *[dict(zip(PATIENT.names, p)) for p in data[n::3]])
    base = spark.createDataFrame(data, PATIENT.simpleString())
    scaler, stream = linear.fit_scaler(base), read_json_stream(spark, folder, PATIENT, max_files=1)
    models = []
    for name, at in (("calm", None), ("crash", 1)):
        store = ModelStore(spark, str(tmp_path / name))
        trainer = Trainer(store, scaler, base, steps=2)
        checkpoint = str(tmp_path / f"{name}_ck")
        if at is None:
            run_stream(start_batches(stream, trainer, checkpoint))
        else:
            run_twice(stream, Crash(trainer, at), checkpoint)
        models.append(store.latest())
        assert rows(store.history().select("lote", "pacientes_vistos")) == [(0, 4), (1, 8), (2, 12)]
    assert models[0].weights == pytest.approx(models[1].weights) and models[0].seen == 12
