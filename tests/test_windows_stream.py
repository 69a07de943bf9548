from datetime import datetime, timedelta

import pytest
from conftest import rows

from streamlab.config import JobSettings
from streamlab.functions import parse_event_time
from streamlab.operators.quotes import price_drop_alerts
from streamlab.operators.windows import flight_windows
from streamlab.plans import flights as plan
from streamlab.schemas import FLIGHT, QUOTE
from streamlab.sources import read_json, read_json_stream
from streamlab.streaming import ProgressLog, progress_frame, run_stream, show_batch, start_batches, start_table

T0 = datetime(2024, 1, 1)


def flight(second, company="GOL", passengers=10, delay=1.0, **kw):
    stamp = (T0 + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S")
    return {"companhia": company, "passageiros": passengers, "atraso_min": delay, "event_time": stamp} | kw


def windows_of(df):
    return flight_windows(parse_event_time(df, "event_time"))


def offsets(df):
    """(airline, window start in seconds, flights), sorted."""
    return sorted(
        ((r.companhia, int((r.janela_inicio - T0).total_seconds()), r.total_voos) for r in df.collect()),
        key=repr,
    )


class Recorder:
    """Handler that writes each batch and remembers it as rows."""

    def __init__(self):
        self.batches = {}

    def __call__(self, batch, batch_id):
        self.batches[batch_id] = offsets(batch)


def test_boundary_null_time_and_null_airline(spark, deliver):
    folder = deliver(
        "f", flight(0), flight(29), flight(30), flight(31, None, None, None), "{broken", flight(1, event_time="?")
    )
    df = windows_of(read_json(spark, folder, FLIGHT))
    assert offsets(df) == sorted([("GOL", 0, 2), ("GOL", 30, 1), (None, 30, 1)], key=repr)
    first = df.where("companhia = 'GOL' and total_voos = 2").first()
    assert (first.janela_fim - first.janela_inicio).total_seconds() == 30
    assert (first.passageiros, first.atraso_medio_min) == (20, 1.0)
    unknown = df.where("companhia is null").first()
    assert (unknown.passageiros, unknown.atraso_medio_min) == (None, None)


def test_late_rows_are_dropped_and_reported(spark, deliver, tmp_path):
    for batch in ([5], [300], [330], [6], [7, 360]):
        folder = deliver("f", *[flight(s) for s in batch])
    stream = windows_of(read_json_stream(spark, folder, FLIGHT, max_files=1))
    seen = Recorder()
    query = run_stream(start_batches(stream, seen, str(tmp_path / "ck")))
    emitted = [w for n in sorted(seen.batches) for w in seen.batches[n]]
    assert ("GOL", 0, 1) in emitted
    assert len(emitted) == len(set((a, s) for a, s, _ in emitted))
    dropped = {r.lote: r.grupos_atrasados for r in progress_frame(spark, query).collect()}
    assert dropped[3] == 1 and dropped[4] == 1
    assert {r.consulta for r in progress_frame(spark, query).collect()} == {str(query.id)}
    written = {r.lote: r.linhas_saida for r in progress_frame(spark, query).collect()}
    assert {n: len(b) for n, b in seen.batches.items()} == written


def test_lateness_within_the_delay_is_counted(spark, deliver, tmp_path):
    for batch in ([10, 35], [25, 49], [100]):
        folder = deliver("f", *[flight(s) for s in batch])
    seen = Recorder()
    stream = windows_of(read_json_stream(spark, folder, FLIGHT, max_files=1))
    run_stream(start_batches(stream, seen, str(tmp_path / "ck")))
    emitted = [w for b in seen.batches.values() for w in b]
    assert ("GOL", 0, 2) in emitted and ("GOL", 30, 2) in emitted
    assert not [w for w in emitted if w[1] == 90]  # the tail window never closes


def test_stream_equals_batch_for_closed_windows(spark, deliver, tmp_path):
    for n in range(4):
        folder = deliver("f", *[flight(n * 40 + s, c) for s in range(0, 40, 7) for c in ("GOL", "TAP")])
    batch = windows_of(read_json(spark, folder, FLIGHT))
    stream = windows_of(read_json_stream(spark, folder, FLIGHT))
    run_stream(start_table(stream, str(tmp_path / "out"), str(tmp_path / "ck")))
    closed = {(c, s, n) for c, s, n in offsets(batch) if s + 30 <= 3 * 40 + 35 - 20}
    assert set(offsets(spark.read.parquet(str(tmp_path / "out")))) == closed and closed


def test_restart_resumes_state_and_emits_a_window_once(spark, deliver, tmp_path):
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for batch in ([1, 2], [3, 100], [200]):
        folder = deliver("f", *[flight(s) for s in batch])
        stream = windows_of(read_json_stream(spark, folder, FLIGHT))
        run_stream(start_table(stream, out, ck))
    assert offsets(spark.read.parquet(out)) == [("GOL", 0, 3), ("GOL", 90, 1)]


def test_processing_time_trigger_timeout_and_listener(spark, deliver, tmp_path):
    log = ProgressLog()
    spark.streams.addListener(log)
    try:
        folder = deliver("f", flight(1), flight(200))
        settings = JobSettings(
            stream_dir=folder, checkpoint_dir=str(tmp_path / "ck"), output_dir=str(tmp_path), trigger_seconds=1
        )
        seen = Recorder()
        query = plan.start(spark, settings, handler=seen)
        run_stream(query, timeout=4)
        assert not query.isActive
        assert ("GOL", 0, 1) in [w for b in seen.batches.values() for w in b]
        frame = log.frame(spark)
        assert frame.agg({"linhas_entrada": "sum"}).first()[0] == 2
    finally:
        spark.streams.removeListener(log)


def test_failure_is_raised_and_the_query_stopped(spark, deliver, tmp_path):
    folder = deliver("f", flight(1))
    stream = read_json_stream(spark, folder, FLIGHT)

    def fail(batch, batch_id):
        raise ValueError("sink down")

    query = start_batches(stream, fail, str(tmp_path / "ck"))
    with pytest.raises(Exception, match="sink down"):
        run_stream(query)
    assert not query.isActive


def test_alerts_run_on_a_stream(spark, deliver, tmp_path):
    folder = deliver("q", {"ticker": "A", "preco": 97.0, "abertura": 100.0}, {"ticker": "B", "preco": 98.0, "abertura": 100.0})
    stream = price_drop_alerts(read_json_stream(spark, folder, QUOTE))
    run_stream(start_table(stream, str(tmp_path / "out"), str(tmp_path / "ck")))
    assert [r.ticker for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["A"]


def test_report_is_ordered_and_rounded(spark, deliver):
    folder = deliver("f", flight(40, "TAP", 1, 0.2), flight(41, "TAP", 1, 0.3), flight(40), flight(1))
    report = plan.report(windows_of(read_json(spark, folder, FLIGHT)))
    assert [(r.companhia, r.atraso_medio_min) for r in report.collect()] == [("GOL", 1.0), ("GOL", 1.0), ("TAP", 0.3)]
    assert rows(report.selectExpr("count(*)")) == [(3,)]


def test_show_batch_is_sorted(spark, capsys):
    show_batch(spark.createDataFrame([(2, "b"), (1, "a")], "n int, s string"), "n")
    shown = capsys.readouterr().out
    assert 0 < shown.index("|1") < shown.index("|2")
