import math
import random

import numpy as np
import pytest
from conftest import rows

from streamlab.operators import linear
from streamlab.plans import patients as plan
from streamlab.schemas import PATIENT
from streamlab.sinks import ModelStore, model_store
from streamlab.sources import read_json_stream
from streamlab.streaming import run_stream


def patients(n, seed=0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        sick = rng.random() < 0.35
        out.append((rng.gauss(160 if sick else 100, 20), rng.gauss(36 if sick else 27, 5), int(sick)))
    return out


def frame(spark, data):
    return spark.createDataFrame(data, PATIENT.simpleString())


@pytest.fixture
def base(spark):
    return frame(spark, patients(600))


def test_scaler_uses_population_deviation_and_constant_feature(spark):
    df = frame(spark, [(1.0, 5.0, 0), (3.0, 5.0, 1)])
    scaler = linear.fit_scaler(df)
    assert scaler.mean == (2.0, 5.0) and scaler.std == (1.0, 1.0)
    assert rows(linear.apply_scaler(df, scaler).select("glucose", "bmi"), "glucose") == [(-1.0, 0.0), (1.0, 0.0)]


def test_gradient_and_step_match_numpy(spark):
    data = patients(200, seed=2)
    df = frame(spark, data).repartition(5)
    scaler = linear.fit_scaler(df)
    model = linear.Model(scaler, (0.3, -0.2), 0.1)
    a = np.array(data)
    x, y = (a[:, :2] - a[:, :2].mean(0)) / a[:, :2].std(0), a[:, 2]
    error = 1 / (1 + np.exp(-(x @ [0.3, -0.2] + 0.1))) - y
    row = linear.gradient_sums(df, model).first()
    assert np.allclose([row.g_glucose, row.g_bmi, row.g_bias], [*(error @ x), error.sum()])
    assert row.n == 200
    stepped = linear.train_step(df, model, rate=0.5, alpha=0.01)
    assert np.allclose(stepped.weights, np.array([0.3, -0.2]) - 0.5 * (error @ x / 200 + 0.01 * np.array([0.3, -0.2])))
    assert math.isclose(stepped.bias, 0.1 - 0.5 * error.mean())
    assert (stepped.seen, stepped.batches) == (200, 1)


def test_rows_with_null_are_left_out_and_empty_batch_changes_nothing(spark, base):
    model = linear.Model.untrained(linear.fit_scaler(base))
    mixed = frame(spark, [(100.0, None, 0), (None, 20.0, 1), (100.0, 20.0, None), (100.0, 20.0, 1)])
    assert linear.gradient_sums(mixed, model).first().n == 1
    assert linear.train_step(base.limit(0), model) is model


def test_training_beats_the_majority_and_ranks_the_two_probes(spark, base):
    test = frame(spark, patients(300, seed=9))
    model = linear.train_step(base, linear.Model.untrained(linear.fit_scaler(base)), steps=20)
    score = linear.accuracy(linear.predict(test, model)).first()[0]
    share = linear.class_share(test).first()[0]
    assert score > max(share, 1 - share) + 0.1
    healthy, risky = linear.risk_of(model, 85, 22), linear.risk_of(model, 180, 38)
    assert healthy[1] < risky[1] and healthy[2] == "NÃO diabético" and risky[2] == "DIABÉTICO"
    scored = rows(linear.predict(frame(spark, [(85.0, 22.0, 0)]), model).select("classe", "probabilidade", "rotulo"))[0]
    assert scored[0] == healthy[0] and math.isclose(scored[1], healthy[1]) and scored[2] == healthy[2]


def test_single_class_batch_still_trains(spark, base):
    start = linear.Model.untrained(linear.fit_scaler(base))
    model = linear.train_step(base.where("outcome = 1"), start)
    assert model.bias > 0


def test_grid_covers_the_widened_extent(spark, base):
    model = linear.train_step(base, linear.Model.untrained(linear.fit_scaler(base)), steps=5)
    grid = linear.decision_grid(base, model, n=20)
    assert grid.count() == 400
    r = linear.feature_range(linear.apply_scaler(base, model.scaler)).first()
    low, high = grid.selectExpr("min(glucose)", "max(bmi)").first()
    assert math.isclose(low, r.min_glucose) and math.isclose(high, r.max_bmi)
    assert {c for (c,) in rows(grid.select("classe").distinct())} == {0, 1}


def test_store_compares_versions_as_numbers(spark, tmp_path):
    store = ModelStore(spark, str(tmp_path / "m"))
    assert store.latest() is None and store.history().count() == 0
    scaler = linear.Scaler(("glucose", "bmi"), (1.0, 2.0), (3.0, 4.0))
    for version in (999, 1000, 2):
        store.save(linear.Model(scaler, (0.1, 0.2), 0.3, version, version, 10 * version), 0.5)
    assert store.latest() == linear.Model(scaler, (0.1, 0.2), 0.3, 1000, 1000, 10000)
    assert store.latest(before=1000).version == 999
    assert rows(store.history()) == [(2, 20, 0.5), (999, 9990, 0.5), (1000, 10000, 0.5)]
    assert rows(store.artifact_counts().select("tipo", "total"), "tipo") == [("metrics", 3), ("models", 3)]


def test_stream_restart_and_replay(spark, deliver, tmp_path, base):
    def record(p):
        return dict(zip(PATIENT.names, p))

    store = ModelStore(spark, str(tmp_path / "artifacts"))
    scaler = linear.fit_scaler(base)
    trainer = plan.Trainer(store, scaler, base, steps=2)

    def run(folder):
        stream = read_json_stream(spark, folder, PATIENT, max_files=1)
        run_stream(plan.start_training(stream, trainer, str(tmp_path / "ck")))

    chunks = [patients(30, seed=s) for s in range(4)]
    deliver("s", *map(record, chunks[0]))
    run(deliver("s", *map(record, chunks[1])))
    run(deliver("s", *map(record, chunks[2])))  # restart goes on from the stored model
    assert [r.lote for r in store.history().collect()] == [0, 1, 2]
    last = store.latest()
    assert (last.seen, last.batches) == (90, 3)
    trainer(frame(spark, chunks[2]), 2)  # replay repeats its own step
    again = store.latest()
    assert np.allclose(again.weights, last.weights) and again.seen == 90
    want = linear.Model.untrained(scaler)
    for c in chunks[:3]:
        want = linear.train_step(frame(spark, c), want, steps=2)
    assert np.allclose(last.weights, want.weights) and np.isclose(last.bias, want.bias)
    trainer(frame(spark, []), 3)
    assert [r.lote for r in store.history().collect()] == [0, 1, 2]


def test_base_split_is_written_once(spark, tmp_path):
    data = [(n, float(g), float(b), o) for n, (g, b, o) in enumerate(patients(200))] + [(900, 0.0, 30.0, 1), (901, 90.0, 0.0, 0)]
    df = spark.createDataFrame(data, "id long, glucose double, bmi double, outcome int")
    train, test = plan.write_split(df, "id", str(tmp_path / "base"))
    assert train.count() + test.count() == 200
    assert test.intersect(train).count() == 0


def test_risk_far_from_the_boundary():
    from streamlab.operators.linear import Model, Scaler, risk_of

    steep = Model(Scaler(("glucose", "bmi"), (0.0, 0.0), (1.0, 1.0)), (1000.0, 0.0))
    assert risk_of(steep, -5.0, 0.0)[:2] == (0, 0.0) and risk_of(steep, 5.0, 0.0)[:2] == (1, 1.0)


def stored(store, version, seen=None):
    scaler = linear.Scaler(("glucose", "bmi"), (1.0, 2.0), (3.0, 4.0))
    store.save(linear.Model(scaler, (0.5, float(version)), 0.1, version, version + 1, seen or version), version / 1000)


def test_model_and_metrics_are_one_commit(spark, tmp_path, monkeypatch):
    store = ModelStore(spark, str(tmp_path / "m"))
    stored(store, 0)
    with monkeypatch.context() as m:
        m.setattr("streamlab.sinks.paths.Record.write", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            stored(store, 1)
    again = ModelStore(spark, str(tmp_path / "m"))
    assert again.latest().version == 0 and [r.lote for r in again.history().collect()] == [0]
    assert {r.total for r in again.artifact_counts().collect()} == {1}
    stored(again, 1)
    stored(again, 1, seen=7)  # a replay replaces it
    assert again.latest().seen == 7 and again.latest(before=1).version == 0 and again.history().count() == 2


def test_many_versions_list_nothing_and_fold(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(model_store, "RANGE", 5)
    store, listed = ModelStore(spark, str(tmp_path / "m")), []
    real = model_store.numbered
    monkeypatch.setattr(model_store, "numbered", lambda *a, **k: listed.append(a[1]) or real(*a, **k))
    for n in range(23):
        stored(store, n)
        assert store.latest().version == n and (n == 0 or store.latest(before=n).version == n - 1)
    assert len(listed) == 4  # once for each range that was folded
    assert [(r.lote, r.acuracia) for r in store.history().collect()] == [(n, n / 1000) for n in range(23)]
    open_ = {p.name for p in (tmp_path / "m" / "abertas").iterdir()}
    assert open_ <= {"faixa=3", "faixa=4"} and len(list((tmp_path / "m" / "fechadas").iterdir())) == 4
    assert store.latest(before=8).version == 7 and store.latest(before=0) is None
    stored(store, 3, seen=77)  # after an older checkpoint was restored
    stored(store, 9, seen=78)
    assert [(r.lote, r.pacientes_vistos) for r in store.history().collect()] == [(n, {3: 77, 9: 78}.get(n, n)) for n in range(23)]
    assert store.latest(before=4).seen == 77 and store.latest().version == 22


def test_newton_steps_reach_the_minimum(spark):
    data = patients(400, seed=3)
    df = spark.createDataFrame(data, PATIENT.simpleString())
    scaler = linear.fit_scaler(df)
    model = linear.Model.untrained(scaler)
    for _ in range(10):
        model = linear.newton_step(df, model)
    sums = linear.gradient_sums(df, model).first()
    rest = [sums[f"g_{f}"] / sums["n"] + linear.L2_ALPHA * w for f, w in zip(scaler.features, model.weights)]
    assert max(map(abs, [*rest, sums["g_bias"] / sums["n"]])) < 1e-9 and model.seen == 4000
    slow = linear.train_step(df, linear.Model.untrained(scaler), steps=60)
    assert np.sign(slow.weights[0]) == np.sign(model.weights[0])
    assert linear.newton_step(df.limit(0), model) is model
    one = df.where("outcome = 1").limit(1)  # a Hessian of rank one
    assert all(map(math.isfinite, linear.newton_step(one, linear.Model.untrained(linear.fit_scaler(one))).weights))
