import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from streamlab.llm import toxicity as T


def rows(seed, n):
    """Toxic is an insult beside a group name; neither alone is."""
    rnd = random.Random(seed)
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)]
    docs, labels = [], []
    for k in range(n):
        text = [rnd.choice(words) for _ in range(rnd.randrange(5, 60))]
        insult, group = rnd.random() < 0.4, rnd.random() < 0.4
        text += ["grimsel"] * insult + ["velorian"] * group
        rnd.shuffle(text)
        docs.append((k, " ".join(text), "clash"))
        labels.append((k, int(insult and group)))
    return docs, labels


def test_learns_interactions(spark):
    docs, labels = rows(1, 3000)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = T.fit(d, T.training_labels(lab), n_terms=64)
    got = T.score(d, machine).withColumn("held_out", T.held_out(F.col("doc_id"))).join(lab, "doc_id").where("held_out").toPandas()
    assert 500 < len(got) < 1000 and ((got.score >= 0.3) == (got.predicted == 1)).all()
    assert (got.predicted == got.toxic).mean() > 0.97


def test_odd_input(spark):
    docs, labels = rows(2, 400)
    odd = [(5000, None, ""), (5001, "", ""), (5002, "grimsel velorian " * 20_000, ""), (None, "grimsel", ""), (3, docs[3][1], "")]
    d = spark.createDataFrame(docs + odd, "doc_id long, text string, extra string")
    lab = spark.createDataFrame(labels + [(9999, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    machine = T.fit(d, T.training_labels(lab), n_terms=32)
    got = T.score(d, machine).toPandas()
    assert len(got) == 405 and got.score.between(0, 1).all()
    assert got[got.doc_id == 5000].score.iloc[0] == got[got.doc_id == 5001].score.iloc[0]
    assert got[got.doc_id == 3].score.nunique() == 1
    assert T.score(d.limit(0), machine).count() == 0
    nothing = T.fit(d, lab.limit(0))
    assert T.score(d, nothing).where("predicted = 1").count() == 0


def test_score_equals_the_formula():
    rng = np.random.default_rng(1)
    texts = pa.array(["aa bb aa cc", "", None, "dd aa"])
    known = np.unique(np.concatenate([t for _, t, _, _ in T.bags(texts)]))
    machine = T.Machine(known, 0.1, rng.normal(size=len(known) + 1), rng.normal(size=(len(known) + 1, 3)))
    want = []
    table = np.full(1 << T.BITS, -1)
    table[known] = np.arange(len(known))
    row, term, count, words = (np.concatenate(c) for c in zip(*T.bags(texts, table)))
    for i in range(4):
        x = np.zeros(len(known) + 1)
        x[term[row == i]] = np.log1p(count[row == i])
        x[-1] = np.log1p(words[i]) / 4
        pairs = sum(x[a] * x[b] * machine.factors[a] @ machine.factors[b] for a in range(len(x)) for b in range(a + 1, len(x)))
        want.append(1 / (1 + np.exp(-(0.1 + machine.linear @ x + pairs))))
    assert np.allclose(machine.score_batch(texts), want)


def test_held_out_rule(spark):
    got = {r.id: r.h for r in spark.range(200).select("id", T.held_out(F.col("id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(200)}
