import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.plans.votes import final_result, partial_result, start_counts, tally_table
from streamlab.schemas import VOTE
from streamlab.sinks import KeyedTable, paths
from streamlab.sinks.paths import Record
from streamlab.sources import read_json_stream
from streamlab.streaming import run_stream

SCHEMA = T.StructType().add("k", "string").add("n", "long").add("s", "string")


def batch(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def current(table):
    return {r.k: (r.n, r.s) for r in table.read_current().collect()}


def test_upsert_replaces_and_inserts(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA)
    assert current(t) == {}
    t.upsert(batch(spark, ("a", 1, "x"), ("b", 1, None), (None, 5, "n")), 0)
    t.upsert(batch(spark, ("a", 2, None), ("c", 1, "z")), 1)
    want = {"a": (2, None), "b": (1, None), "c": (1, "z"), None: (5, "n")}
    assert current(t) == want
    t.upsert(batch(spark, ("a", 2, None), ("c", 1, "z")), 1)  # replay
    assert current(t) == want
    t.upsert(batch(spark, ("a", 1, "x"), ("b", 1, None), (None, 5, "n")), 0)  # older batch again
    assert current(t) == want


def test_compaction_keeps_values_and_ignores_old_replays(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA, compact_every=3, files=2)
    rng, want = random.Random(5), {}
    for n in range(8):
        data = {rng.choice("abcdefgh"): (n * 10 + i, f"v{n}") for i in range(4)}
        t.upsert(batch(spark, *[(k, *v) for k, v in data.items()]), n)
        want |= data
        assert current(t) == want
    baldes = t.record()["baldes"]
    assert any(f[0].startswith("junto=") for f in baldes.values()) and all(len(f) < 3 for f in baldes.values())
    t.upsert(batch(spark, ("a", -1, "old")), 5)
    assert current(t) == want
    t.compact()
    assert all(len(f) == 1 for f in t.record()["baldes"].values()) and current(t) == want


def test_order_by_picks_the_last_row_of_a_key(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA)
    t.upsert(batch(spark, ("a", 1, "x"), ("a", 9, "y"), ("a", 4, "z")), 0, order_by="n")
    assert current(t) == {"a": (9, "y")}


def test_unfinished_write_is_invisible(spark, tmp_path, monkeypatch):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA)
    t.upsert(batch(spark, ("a", 1, "x")), 0)
    with monkeypatch.context() as m:
        m.setattr(t._record, "write", lambda value: 1 / 0)  # the driver dies before the batch counts
        with pytest.raises(ZeroDivisionError):
            t.upsert(batch(spark, ("a", 2, "y")), 1)
    assert current(t) == {"a": (1, "x")}
    t.upsert(batch(spark, ("a", 3, "z")), 1)
    assert current(t) == {"a": (3, "z")}


def test_a_record_cut_short_leaves_the_one_before(spark, tmp_path):
    r = Record(spark, str(tmp_path / "r"))
    assert r.read() is None
    for n in range(3):
        r.write({"n": n})
        assert Record(spark, str(tmp_path / "r")).read() == {"n": n}
    newest = tmp_path / "r.0.json"  # written first and third
    newest.write_text(newest.read_text()[:9])  # the checksum no longer fits either
    assert r.read() == {"n": 1}
    (tmp_path / ".r.0.json.crc").unlink()
    assert r.read() == {"n": 1}
    again = Record(spark, str(tmp_path / "r"))  # the job after the crash
    again.write({"n": 7})
    assert again.read() == r.read() == {"n": 7}


def test_only_touched_buckets_are_rewritten_and_old_folders_go(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA, compact_every=3, buckets=16)
    t.upsert(batch(spark, *((f"k{i}", i, "first") for i in range(200))), 0)
    assert len(t.record()["baldes"]) == 16
    for n in range(1, 9):
        t.upsert(batch(spark, ("k7", n, "x")), n)
    folders = t.record()["baldes"].values()
    assert sum(f == ["lote=0"] for f in folders) == 15  # never rewritten
    got = current(t)
    assert len(got) == 200 and got["k7"] == (8, "x") and got["k8"] == (8, "first")
    named = {f for fs in folders for f in fs} | {f for f, _, _ in t.record()["trocadas"]}
    kept = {p.name for p in (tmp_path / "t" / "rodada=0").iterdir() if not p.name.startswith(".")}
    assert kept == named and len(kept) < 7


def test_an_empty_batch_leaves_no_folder(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA)
    t.upsert(batch(spark), 0)
    t.upsert(batch(spark, ("a", 1, "x")), 1)
    t.upsert(batch(spark).where("n > 3"), 2)
    assert {p.name for p in (tmp_path / "t" / "rodada=0").iterdir()} == {"lote=1"}
    assert current(t) == {"a": (1, "x")} and t.record()["lote"] == 2


def test_cost_of_a_batch_is_constant(spark, tmp_path, monkeypatch):
    """Nothing is listed, and the folders on disk stay few (LONG_TESTS=1: over 200 batches)."""
    n_batches = 200 if os.environ.get("LONG_TESTS") else 46
    monkeypatch.setattr(paths, "numbered", lambda *a, **k: 1 / 0)
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA, compact_every=5, buckets=2)
    data = spark.range(0, 3, 1, 1).select(F.col("id").cast("string").alias("k"), F.col("id").alias("n"), F.lit("v").alias("s"))
    sizes = []
    for n in range(n_batches):
        t.upsert(data.where(f"n <> {n % 3}").withColumn("n", F.lit(n).cast("long")), n)
        sizes.append(len(list((tmp_path / "t" / "rodada=0").iterdir())))
    assert max(sizes[n_batches // 2 :]) <= max(sizes[15 : n_batches // 2]) < 15
    # batch n leaves out key n % 3
    assert current(t) == {str(k): (max(n for n in range(n_batches) if n % 3 != k), "v") for k in range(3)}


def test_reset_starts_empty(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], SCHEMA)
    t.upsert(batch(spark, ("a", 1, "x")), 7)
    t.reset()
    assert current(t) == {}
    t.upsert(batch(spark, ("b", 1, "x")), 0)
    assert current(t) == {"b": (1, "x")}


def test_votes_update_mode_restart_and_changed_groups_only(spark, deliver, tmp_path):
    table = tally_table(spark, str(tmp_path / "tally"))

    def vote(uf, name):
        return {"id_urna": 1, "estado": uf, "candidato": name, "event_time": "t"}

    def run(folder):
        run_stream(start_counts(read_json_stream(spark, folder, VOTE, max_files=1), table, str(tmp_path / "ck")))

    run(deliver("v", vote("CE", "H"), vote("CE", "H"), vote("SP", "S")))
    assert {r._id: r.votos for r in table.read_current().collect()} == {"CE|H": 2, "SP|S": 1}
    run(deliver("v", vote("CE", "H"), "{garbage"))
    assert {r._id: r.votos for r in table.read_current().collect()} == {"CE|H": 3, "SP|S": 1, "None|None": 1}
    changed = spark.read.parquet(str(tmp_path / "tally" / "rodada=0" / "lote=1"))
    assert rows(changed.select("_id", "votos"), "_id") == [("CE|H", 3), ("None|None", 1)]
    assert table.read_current().where("atualizado_em is null").count() == 0


def test_vote_reports(spark, tmp_path):
    table = tally_table(spark, str(tmp_path / "tally"))
    votes = [("SP", "HOMER SIMPSON", 3), ("SP", "SPOCK", 3), ("RJ", "SPOCK", 1), ("RJ", "OUTRO", 8)]
    data = [(f"{e}|{c}", e, c, n, None) for e, c, n in votes]
    table.upsert(spark.createDataFrame(data, table.schema.simpleString()), 0)
    assert rows(partial_result(table)) == [(3, 4, "SPOCK")]
    board, states, winner = final_result(table)
    assert rows(board) == [("RJ", 0, 1, "SPOCK"), ("SP", 3, 3, "EMPATE")]
    assert rows(states) == [(0, 1, 1)] and rows(winner) == [(3, 4, "SPOCK")]
