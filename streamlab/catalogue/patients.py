"""Patient queries: labelled documents as patients (length and blanks as the two measures)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlab.catalogue import tables as t
from streamlab.config import work_dir
from streamlab.functions import drop_zero_missing, round_decimal
from streamlab.operators import linear
from streamlab.operators.ordering import both_ends
from streamlab.operators.sampling import assign_minibatch, hash_minibatch
from streamlab.plans import patients as plan
from streamlab.schemas import PATIENT
from streamlab.sinks import ModelStore
from streamlab.sources import read_csv_named, read_json, read_json_stream
from streamlab.streaming import run_stream

QUERIES, ORACLES, query = t.registry()

_RATE = 0.5
_GRID = 200
_DELIVERIES, _STEPS = 3, 2


def _clean(spark, sf_dir):
    return drop_zero_missing(t.patients(spark, sf_dir), linear.FEATURES)


def _split(spark, sf_dir):
    return plan.split_base(t.patients(spark, sf_dir), t.SPLIT_KEY, work_dir(spark, "patients"))


def _written_split(spark, sf_dir):
    return plan.write_split(t.patients(spark, sf_dir), t.SPLIT_KEY, work_dir(spark, "patients"))


def _trained(spark, sf_dir):
    """(training rows, test rows, model after two steps over the training rows)."""
    train, test = _written_split(spark, sf_dir)
    model = linear.Model.untrained(linear.fit_scaler(train))
    return train, test, linear.train_step(train, model, rate=_RATE, steps=2)


def _gradient_sql(name: str, model: str, rows: str = "true") -> str:
    z = "b + w1 * (glucose - m1) / s1 + w2 * (bmi - m2) / s2"
    return f"""{name} AS (SELECT sum(e * (glucose - m1) / s1) AS g1, sum(e * (bmi - m2) / s2) AS g2,
      sum(e) AS g0, count(*) AS n
      FROM (SELECT *, 1 / (1 + exp(-({z}))) - outcome AS e FROM train, scaler, {model}
            WHERE {rows}))"""


def _step_sql(name: str, model: str, gradient: str) -> str:
    def moved(w, g):
        return f"{w} - {_RATE} * ({g} / n + {linear.L2_ALPHA} * {w}) AS {w}"

    return f"""{name} AS (SELECT {moved('w1', 'g1')}, {moved('w2', 'g2')}, b - {_RATE} * g0 / n AS b
      FROM {model}, {gradient})"""


_START_SQL = """scaler AS (SELECT avg(glucose) AS m1, avg(bmi) AS m2, stddev_pop(glucose) AS s1,
                    stddev_pop(bmi) AS s2 FROM train),
  model0 AS (SELECT 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS b)"""
_MODEL_SQL = f"""WITH split AS ({t.SPLIT_SQL}),
  train AS (SELECT * FROM split WHERE NOT em_teste), test AS (SELECT * FROM split WHERE em_teste),
  {_START_SQL},
  {_gradient_sql('grad0', 'model0')}, {_step_sql('model1', 'model0', 'grad0')},
  {_gradient_sql('grad1', 'model1')}, {_step_sql('model2', 'model1', 'grad1')}"""


def _r(expr: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DECIMAL(38,10)), {digits})::DOUBLE"


@query(f"SELECT * FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0")
def patient_filter(spark, sf_dir):
    return _clean(spark, sf_dir)


@query(f"SELECT glucose, bmi, outcome FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0")
def patient_csv_base(spark, sf_dir):
    """The base written as headerless CSV and read back under a declared schema."""
    path = work_dir(spark, "patient_csv")
    t.patients(spark, sf_dir).select(*PATIENT.names).write.csv(path)
    return drop_zero_missing(read_csv_named(spark, path, PATIENT), linear.FEATURES)


@query(f"SELECT doc_id, outcome, em_teste FROM ({t.SPLIT_SQL})")
def patient_split(spark, sf_dir):
    return _split(spark, sf_dir).select("doc_id", "outcome", "em_teste")


@query(
    f"SELECT {_r('avg(outcome)')} AS proporcao FROM ({t.SPLIT_SQL}) WHERE NOT em_teste"
)
def patient_class_share(spark, sf_dir):
    shares = linear.class_share(_split(spark, sf_dir).where(~F.col("em_teste")))
    return shares.select(round_decimal("proporcao", 4).alias("proporcao"))


@query(
    f"""SELECT doc_id, (row_number() OVER (ORDER BY md5(doc_id || '|7')) - 1) // 30 + 1 AS lote
    FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0"""
)
def patient_minibatches(spark, sf_dir):
    ids = _clean(spark, sf_dir).select(t.SPLIT_KEY)
    return assign_minibatch(ids, t.SPLIT_KEY, work_dir(spark, "patient_chunks"))


@query(
    f"""SELECT doc_id, (row_number() OVER (ORDER BY md5((doc_id % 7) || '|7'), lpad(doc_id::VARCHAR, 12, '0')) - 1) // 30 + 1 AS lote
    FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0"""
)
def patient_minibatches_repeated(spark, sf_dir):
    """Chunks by a key that repeats: rows of one key follow in the order of their content."""
    ids = _clean(spark, sf_dir).select((F.col("doc_id") % 7).alias("grupo"), F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("id"))
    chunks = assign_minibatch(ids, "grupo", work_dir(spark, "patient_chunks"))
    return chunks.select(F.col("id").cast("bigint").alias("doc_id"), "lote")


@query(
    f"""SELECT outcome, count(*)::BIGINT AS linhas, floor(count(*) * 0.25 + 0.5)::BIGINT AS em_teste
    FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0 GROUP BY 1"""
)
def patient_split_repeated(spark, sf_dir):
    """Class sizes and test shares of a split by a key that repeats."""
    rows = t.patients(spark, sf_dir).withColumn("grupo", F.col("doc_id") % 7)
    split = plan.split_base(rows, "grupo", work_dir(spark, "patients"))
    return split.groupBy("outcome").agg(F.count("*").alias("linhas"), F.count_if("em_teste").alias("em_teste"))


@query(
    f"""SELECT doc_id, ('0x' || substr(md5(doc_id || '|7'), 1, 8))::BIGINT % 20 + 1 AS lote
    FROM ({t.PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0"""
)
def patient_hash_batches(spark, sf_dir):
    """Twenty chunks of about equal size, assigned row by row."""
    return hash_minibatch(_clean(spark, sf_dir), t.SPLIT_KEY, 20).select("doc_id", "lote")


@query(
    f"""(SELECT 'primeiros' AS parte, doc_id, glucose, bmi, outcome FROM ({t.PATIENTS_SQL}) ORDER BY doc_id LIMIT 5)
    UNION ALL
    (SELECT 'ultimos', doc_id, glucose, bmi, outcome FROM ({t.PATIENTS_SQL}) ORDER BY doc_id DESC LIMIT 5)"""
)
def patient_preview(spark, sf_dir):
    """First and last five patients by id, in one pass."""
    return both_ends(t.patients(spark, sf_dir).select("doc_id", *PATIENT.names), "doc_id", 5)


@query(
    f"""WITH split AS ({t.SPLIT_SQL}), scaler AS (SELECT avg(glucose) AS m1, avg(bmi) AS m2,
      stddev_pop(glucose) AS s1, stddev_pop(bmi) AS s2 FROM split WHERE NOT em_teste)
    SELECT doc_id, {_r('(glucose - m1) / s1')} AS glucose, {_r('(bmi - m2) / s2')} AS bmi
    FROM split, scaler"""
)
def patient_scaler(spark, sf_dir):
    """All rows scaled with the statistics of the training part."""
    split = _split(spark, sf_dir)
    scaler = linear.fit_scaler(split.where(~F.col("em_teste")))
    scaled = linear.apply_scaler(split, scaler)
    return scaled.select(
        "doc_id", *[round_decimal(f, 4).alias(f) for f in linear.FEATURES]
    )


@query(f"{_MODEL_SQL} SELECT {_r('g1')} AS g_glucose, {_r('g2')} AS g_bmi, {_r('g0')} AS g_bias, n FROM grad1")
def patient_gradient_step(spark, sf_dir):
    """Gradient sums at the model reached after the first step."""
    train, _ = _written_split(spark, sf_dir)
    model = linear.Model.untrained(linear.fit_scaler(train))
    sums = linear.gradient_sums(train, linear.train_step(train, model, rate=_RATE))
    return sums.select(
        *[round_decimal(c, 4).alias(c) for c in ("g_glucose", "g_bmi", "g_bias")], "n"
    )


def _newton_sql() -> str:
    """Two Newton steps from the untrained model; each solves three equations by determinants."""
    a, parts, model = linear.L2_ALPHA, [], "model0"
    for k in range(2):
        parts.append(f"""h{k} AS (SELECT sum(p * (1 - p) * x * x) / count(*) + {a} AS a, sum(p * (1 - p) * x * y) / count(*) AS b,
          sum(p * (1 - p) * x) / count(*) AS c, sum(p * (1 - p) * y * y) / count(*) + {a} AS d, sum(p * (1 - p) * y) / count(*) AS e,
          sum(p * (1 - p)) / count(*) AS f, sum((p - outcome) * x) / count(*) + {a} * any_value(w1) AS u,
          sum((p - outcome) * y) / count(*) + {a} * any_value(w2) AS v, sum(p - outcome) / count(*) AS w
        FROM (SELECT outcome, x, y, w1, w2, 1 / (1 + exp(-(b + w1 * x + w2 * y))) AS p
              FROM (SELECT outcome, (glucose - m1) / s1 AS x, (bmi - m2) / s2 AS y FROM train, scaler), {model})),
        n{k} AS (SELECT w1 - (u * (d * f - e * e) - v * (b * f - c * e) + w * (b * e - c * d)) / q AS w1,
          w2 - (v * (a * f - c * c) - u * (b * f - c * e) - w * (a * e - b * c)) / q AS w2,
          z.b0 - (w * (a * d - b * b) + u * (b * e - c * d) - v * (a * e - b * c)) / q AS b
        FROM (SELECT *, a * (d * f - e * e) - b * (b * f - c * e) + c * (b * e - c * d) AS q FROM h{k}),
             (SELECT w1, w2, b AS b0 FROM {model}) z)""")
        model = f"n{k}"
    return f"""WITH split AS ({t.SPLIT_SQL}), train AS (SELECT * FROM split WHERE NOT em_teste), {_START_SQL}, {", ".join(parts)}"""


@query(f"{_newton_sql()} SELECT {_r('w1')} AS peso_glucose, {_r('w2')} AS peso_bmi, {_r('b')} AS vies FROM n1")
def patient_newton(spark, sf_dir):
    """Weights after two second-order steps over the training rows, one pass each."""
    train, _ = _written_split(spark, sf_dir)
    model = linear.Model.untrained(linear.fit_scaler(train))
    for _ in range(2):
        model = linear.newton_step(train, model)
    values = dict(zip(("peso_glucose", "peso_bmi", "vies"), (*model.weights, model.bias)))
    one = spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
    return one.select(*[round_decimal(c, 4).alias(c) for c in values])


@query(
    f"""{_MODEL_SQL}, z AS (SELECT doc_id, b + w1 * (glucose - m1) / s1 + w2 * (bmi - m2) / s2 AS z
      FROM test, scaler, model2)
    SELECT doc_id, (z > 0)::INTEGER AS classe, {_r('1 / (1 + exp(-z))')} AS probabilidade,
    CASE WHEN z > 0 THEN 'DIABÉTICO' ELSE 'NÃO diabético' END AS rotulo FROM z"""
)
def patient_predict(spark, sf_dir):
    """Test rows scored by a model trained on the training rows."""
    _, test, model = _trained(spark, sf_dir)
    return linear.predict(test, model).select(
        "doc_id", "classe", round_decimal("probabilidade", 4).alias("probabilidade"), "rotulo"
    )


@query(
    f"""{_MODEL_SQL} SELECT {_r('avg((outcome = (z > 0)::INTEGER)::INTEGER)')} AS acuracia
    FROM (SELECT outcome, b + w1 * (glucose - m1) / s1 + w2 * (bmi - m2) / s2 AS z
          FROM test, scaler, model2)"""
)
def patient_accuracy(spark, sf_dir):
    _, test, model = _trained(spark, sf_dir)
    score = linear.accuracy(linear.predict(test, model))
    return score.select(round_decimal("acuracia", 4).alias("acuracia"))


@query(
    f"""SELECT min(glucose) - 1 AS min_glucose, min(bmi) - 1 AS min_bmi,
    max(glucose) + 1 AS max_glucose, max(bmi) + 1 AS max_bmi FROM ({t.SPLIT_SQL}) WHERE em_teste"""
)
def patient_feature_range(spark, sf_dir):
    return linear.feature_range(_split(spark, sf_dir).where("em_teste"))


@query(
    f"""{_MODEL_SQL}, r AS (SELECT min((glucose - m1) / s1) - 1 AS x0, max((glucose - m1) / s1) + 1 AS x1,
      min((bmi - m2) / s2) - 1 AS y0, max((bmi - m2) / s2) + 1 AS y1 FROM test, scaler),
    g AS (SELECT ix, iy, x0 + ix * (x1 - x0) / {_GRID - 1} AS gx, y0 + iy * (y1 - y0) / {_GRID - 1} AS gy
      FROM r, range({_GRID}) a(ix), range({_GRID}) b(iy))
    SELECT ix, iy, {_r('gx')} AS glucose, {_r('gy')} AS bmi, (b + w1 * gx + w2 * gy > 0)::INTEGER AS classe
    FROM g, model2"""
)
def patient_grid(spark, sf_dir):
    """Decision surface over the extent of the test rows."""
    _, test, model = _trained(spark, sf_dir)
    grid = linear.decision_grid(test, model, _GRID)
    return grid.select(
        "ix", "iy", *[round_decimal(f, 4).alias(f) for f in linear.FEATURES], "classe"
    )


@query(
    f"""SELECT (row_number() OVER (ORDER BY md5(doc_id || '|7')) - 1) // 30 + 1 AS lote, glucose, bmi, outcome
    FROM ({t.SPLIT_SQL}) WHERE NOT em_teste"""
)
def patient_arrivals(spark, sf_dir):
    """The training part as delivered to the stream: JSON records in chunks of 30."""
    base = work_dir(spark, "patient_arrivals")
    train, _ = _written_split(spark, sf_dir)
    plan.deliver(train, t.SPLIT_KEY, f"{base}/ordem", f"{base}/in")
    arrived = StructType(list(PATIENT.fields)).add("lote", "long")
    return read_json(spark, f"{base}/in", arrived).select("lote", *PATIENT.names)


def _streamed_training(spark, sf_dir):
    """Training rows in three deliveries of JSON files, the query restarted for each.

    A delivery is one micro-batch: one model version, two gradient steps.
    """
    base = work_dir(spark, "patient_training")
    train, test = _written_split(spark, sf_dir)
    arrivals = hash_minibatch(train, t.SPLIT_KEY, _DELIVERIES)
    arrivals.select("lote", *PATIENT.names).write.partitionBy("lote").json(f"{base}/in")
    store = ModelStore(spark, f"{base}/artifacts")
    trainer = plan.Trainer(store, linear.fit_scaler(train), test, steps=_STEPS, rate=_RATE)
    for n in range(1, _DELIVERIES + 1):
        stream = read_json_stream(spark, f"{base}/in/lote=[1-{n}]", PATIENT)
        run_stream(plan.start_training(stream, trainer, f"{base}/checkpoint"))
    return store, test


def _training_sql() -> str:
    parts, model = [], "model0"
    for n in range(1, _DELIVERIES + 1):
        for k in range(_STEPS):
            grad, moved = f"grad_{n}_{k}", f"model_{n}_{k}"
            parts += [_gradient_sql(grad, model, f"lote = {n}"), _step_sql(moved, model, grad)]
            model = moved
    versions = " UNION ALL ".join(
        f"SELECT {n - 1} AS lote, * FROM model_{n}_{_STEPS - 1}" for n in range(1, _DELIVERIES + 1)
    )
    chunk = f"('0x' || substr(md5(doc_id || '|7'), 1, 8))::BIGINT % {_DELIVERIES} + 1"
    return f"""WITH split AS ({t.SPLIT_SQL}), test AS (SELECT * FROM split WHERE em_teste),
  train AS (SELECT *, {chunk} AS lote FROM split WHERE NOT em_teste),
  {_START_SQL}, {", ".join(parts)}, versions AS ({versions}),
  history AS (SELECT v.lote::BIGINT AS lote,
      (SELECT count(*) FROM train r WHERE r.lote <= v.lote + 1)::BIGINT AS pacientes_vistos,
      {_r("avg((outcome = (b + w1 * (glucose - m1) / s1 + w2 * (bmi - m2) / s2 > 0)::INTEGER)::INTEGER)")}
      AS acuracia
    FROM versions v, test, scaler GROUP BY v.lote)"""


@query(f"{_training_sql()} SELECT * FROM history")
def patient_train_stream(spark, sf_dir):
    """Rows seen and accuracy on the fixed test rows after every batch of the stream."""
    history = _streamed_training(spark, sf_dir)[0].history()
    return history.withColumn("acuracia", round_decimal("acuracia", 4))


@query(f"{_training_sql()} SELECT lote AS versao, pacientes_vistos, acuracia FROM history ORDER BY lote DESC LIMIT 1")
def patient_model_latest(spark, sf_dir):
    """The newest stored model, loaded back from its table and scored again."""
    store, test = _streamed_training(spark, sf_dir)
    model = store.latest()
    scored = linear.accuracy(linear.predict(test, model))
    return scored.select(
        F.lit(model.version).cast("long").alias("versao"),
        F.lit(model.seen).cast("long").alias("pacientes_vistos"),
        round_decimal("acuracia", 4).alias("acuracia"),
    )


@query(f"{_training_sql()} SELECT tipo, count(*)::BIGINT AS total, max(pacientes_vistos)::BIGINT AS vistos FROM history, (VALUES ('models'), ('metrics')) k(tipo) GROUP BY 1")
def artifact_counts(spark, sf_dir):
    return _streamed_training(spark, sf_dir)[0].artifact_counts()
