"""Late rows kept beside the windows, backlogs drained in order, progress that lasts."""

import os
import random
from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from streamlab.config import JobSettings
from streamlab.operators.windows import flight_windows
from streamlab.plans import flights as plan
from streamlab.sinks import append_batch
from streamlab.sources import read_json_stream
from streamlab.schemas import FLIGHT, POST
from streamlab.streaming import LateSplit, ProgressTable, drain_in_order, progress_frame, run_stream, start_batches, to_bytes

T0 = datetime(2024, 1, 1)


def flight(second, company="GOL", **kw):
    stamp = (T0 + timedelta(seconds=second)).strftime("%Y-%m-%d %H:%M:%S")
    return {"voo": str(second), "companhia": company, "passageiros": 1, "atraso_min": 1.0, "event_time": stamp} | kw


def second(time):
    return int((time - T0).total_seconds())


def expected(deliveries):
    """(late rows with the watermark they met, windows of the others that are closed in the end)."""
    late, kept, newest = [], {}, None
    for n, batch in enumerate(deliveries):
        limit = None if newest is None else newest - 20
        for s in batch:
            end = s - s % 30 + 30
            if limit is not None and end <= limit:
                late.append((n, str(s), limit))
            else:
                kept[end - 30] = kept.get(end - 30, 0) + 1
        newest = max([*batch, *([] if newest is None else [newest])], default=None)
    return sorted(late), {s: k for s, k in kept.items() if s + 30 <= newest - 20}


def run(spark, folder, out, handler=None):
    settings = JobSettings(stream_dir=folder, output_dir=out, trigger_seconds=0)
    query, split = plan.keep_late(spark, settings, handler or (lambda b, n: append_batch(b, f"{out}/janelas", n)))
    run_stream(query)
    return split


def schema_of(spark, folder):
    from streamlab.functions import parse_event_time

    return parse_event_time(read_json_stream(spark, folder, FLIGHT), "event_time").schema


def late_rows(spark, split, folder):
    return sorted((r.lote, r.voo, second(r.limite)) for r in split.rows(schema_of(spark, folder)).collect())


def kept_windows(spark, out):
    return {second(r.janela_inicio): r.total_voos for r in spark.read.parquet(f"{out}/janelas").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_late_rows_and_windows_hold_every_row_once(spark, deliver, tmp_path, seed):
    rnd = random.Random(seed)
    deliveries = [[rnd.randrange(200) + 60 * n for _ in range(12)] for n in range(4)]
    deliveries.insert(2, [149, 150, 151])
    for batch in deliveries:
        folder = deliver("f", *[flight(s) for s in batch])
        split = run(spark, folder, str(tmp_path / "o"))
    late, windows = expected(deliveries)
    assert late_rows(spark, split, folder) == late and late
    assert kept_windows(spark, str(tmp_path / "o")) == windows
    assert split.record()["linhas"] == sum(map(len, deliveries)) and split.record()["atrasadas"] == len(late)


def test_rows_without_a_time_and_empty_batches(spark, deliver, tmp_path):
    out = str(tmp_path / "o")
    folder = deliver("f", flight(5), flight(6, event_time="?"), "{broken")
    split = run(spark, folder, out)
    for record in (flight(300), "", flight(1)):
        split = run(spark, deliver("f", record), out)
    schema = schema_of(spark, folder)
    assert sorted(str(r.voo) for r in split.rows(schema, "sem_hora").collect()) == ["6", "None"]
    assert [r.voo for r in split.rows(schema).collect()] == ["1"]
    assert split.record()["sem_hora"] == 2 and not (tmp_path / "o/chegadas/lote=2/situacao=no_prazo").exists()


@pytest.mark.parametrize("where", ["write", "after"])
def test_a_crash_neither_loses_nor_doubles_rows(spark, deliver, tmp_path, monkeypatch, where):
    deliveries = [[5, 40], [300, 301], [6, 310, 7]]
    out = str(tmp_path / "o")
    for n, batch in enumerate(deliveries):
        folder = deliver("f", *[flight(s) for s in batch])
        if n == 2 and where == "write":  # rows are written, the record is not
            with monkeypatch.context() as m:
                m.setattr("streamlab.sinks.paths.Record.write", lambda *a: 1 / 0)
                with pytest.raises(Exception, match="division by zero"):
                    run(spark, folder, out)
        if n == 2 and where == "after":  # the windows were written, the batch was not committed
            real = LateSplit.__call__

            def crash(self, b, k):
                real(self, b, k)
                raise RuntimeError("driver lost")

            with monkeypatch.context() as m:
                m.setattr(LateSplit, "__call__", crash)
                with pytest.raises(Exception, match="driver lost"):
                    run(spark, folder, out)
        split = run(spark, folder, out)
    late, windows = expected(deliveries)
    assert late_rows(spark, split, folder) == late and kept_windows(spark, out) == windows


def test_backlog_in_order_makes_no_row_late(spark, deliver, tmp_path):
    rnd = random.Random(3)
    seconds = [rnd.randrange(3_000) for _ in range(300)] + [77] * 60
    rnd.shuffle(seconds)
    for k in range(0, 360, 40):  # every file holds rows from all over the time
        folder = deliver("f", *[flight(s) for s in seconds[k : k + 40]], flight(1, event_time=None))
    out = str(tmp_path / "o")
    settings = JobSettings(stream_dir=folder, output_dir=out, trigger_seconds=0, max_bytes="6k")
    done = plan.drain(spark, settings, lambda b, n: append_batch(b, f"{out}/janelas", n))
    reports = [r for q in done for r in progress_frame(spark, q).collect()]
    assert len(done) > 4 and sum(r.linhas_entrada for r in reports) == 369 and sum(r.grupos_atrasados for r in reports) == 0
    assert kept_windows(spark, out) == expected([seconds])[1]
    assert plan.drain(spark, settings, lambda b, n: 1 / 0) == []  # nothing is delivered twice


def test_interrupted_drain_goes_on(spark, tmp_path):
    data = spark.range(100).select(F.timestamp_seconds("id").alias("event_time"), F.lit("GOL").alias("companhia"), F.lit(1).alias("passageiros"), F.lit(1.0).alias("atraso_min"))
    out, calls = str(tmp_path / "o"), []

    def start(stream):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost")
        return start_batches(flight_windows(stream), lambda b, n: append_batch(b, f"{out}/janelas", n), f"{out}/ck")

    with pytest.raises(RuntimeError):
        drain_in_order(data, "event_time", f"{out}/fatias", 4, start)
    assert len(drain_in_order(data, "event_time", f"{out}/fatias", 4, start)) == 2
    got = {r.janela_inicio.second + 60 * r.janela_inicio.minute: r.total_voos for r in spark.read.parquet(f"{out}/janelas").collect()}
    assert got == {0: 30, 30: 30}


def test_volumes():
    assert [to_bytes(v) for v in ("17", "2k", "3 MB", "1g")] == [17, 2048, 3 << 20, 1 << 30]


def report(query, batch, n=1):
    return (query, batch, 5, n, n, 0, 0, None)


def test_progress_rows_last_and_replays_replace_them(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ProgressTable, "RANGE", 20)
    log = ProgressTable(spark, str(tmp_path / "p"))
    assert log.frame().count() == 0
    for n in range(247):
        log.add(report("a", n, n))
        if n % 20 == 10:
            log.add(report("b", n // 20))
        if n == 140:
            log = ProgressTable(spark, str(tmp_path / "p"))  # a new driver
            log.add(report("a", 140, 140))
            log.add(report("a", 139, 139))  # of a range that is closed
    totals = log.frame().groupBy("consulta").agg(F.count("lote"), F.sum("linhas_entrada"), F.max("lote"))
    assert rows(totals, "consulta") == [("a", 247, sum(range(247)), 246), ("b", 12, 12, 11)]
    assert len(list((tmp_path / "p" / "fechadas").glob("*.json"))) == 12
    assert ProgressTable(spark, str(tmp_path / "p")).frame().count() == 259


def test_a_long_drain_sums_exactly(spark, tmp_path):
    # 1,010 batches take five minutes: LONG_TESTS=1 runs them
    n_files = 1_010 if os.environ.get("LONG_TESTS") else 120
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(n_files):
        (folder / f"{n:04d}.json").write_text("".join('{"id": "%d", "texto": "a"}\n' % k for k in range(n % 3 + 1)))
    log = ProgressTable(spark, str(tmp_path / "p"))
    spark.streams.addListener(log)
    try:
        stream = read_json_stream(spark, str(folder), POST, max_files=1)
        done = run_stream(start_batches(stream, lambda b, n: b.write.format("noop").mode("overwrite").save(), str(tmp_path / "ck")))
        log.wait(done)
    finally:
        spark.streams.removeListener(log)
    found = log.frame().where(F.col("consulta") == str(done.id)).agg(F.count("lote"), F.sum("linhas_entrada"), F.sum("linhas_saida"), F.max("lote"))
    total = sum(n % 3 + 1 for n in range(n_files))
    assert rows(found) == [(n_files, total, total, n_files - 1)]
