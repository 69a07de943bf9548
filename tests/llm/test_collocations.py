import random
import re
from collections import Counter, defaultdict
from decimal import Decimal

import pytest

from streamlab.llm import collocations as C

NAMES = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least=10, top=2000):
    """Counts of every phrase in dictionaries, every candidate and cut one by one."""
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {g: a for g, a in counts.items() if len(g) > 1 and a >= least}
        dropped = {g for t, b in candidates.items() if len(t) == 3 for g in (t[:2], t[1:]) if g in candidates and 100 * b >= 50 * candidates[g]}
        found = []
        for g, a in candidates.items():
            if g not in dropped:
                cuts = [(10**6 * a * a // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
                s, k = min(cuts)
                found.append((-s, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (s, a, g, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, g.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r[c] for c in NAMES) for r in C.collocations(df, **options).collect())


def texts(seed, n=250):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["A", "é", "É", "a\x01b", "a", "Ab", "ab"]
    fixed = ["new york city", "Of the", "one\ttwo  three", "a a a a", "日本 語", "w1. w2", "x;y", "end\nof line"]
    rows = []
    for _ in range(n):
        parts = [rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words) for _ in range(rnd.randrange(40))]
        rows.append((rnd.choice([" ", " ", "\t"]).join(p + (rnd.choice(".,!?") if rnd.random() < 0.1 else "") for p in parts), rnd.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(None, "en"), ("", "fr"), (None, None), (" .,\n", "it"), ("zz " * 30_000, "en"), ("y" * 100_000 + " z", "de"), *[("same row again", "es")] * 12]


def frame(spark, rows):
    names = "text string, lang string, n string, w1 int, x1 int, kind int, p1 int, ext int"
    return spark.createDataFrame([(*r, "n", 1, 2, 3, 4, 5) for r in rows], names).repartition(6)


@pytest.mark.parametrize("seed,least,top", [(1, 10, 2000), (2, 2, 40), (3, 1, 10**6)])
def test_result_equals_brute_force(spark, seed, least, top):
    rows = texts(seed)
    want = brute(rows, least, top)
    assert found(frame(spark, rows), least=least, top=top) == want and len(want) > 20


def test_streams_cut_anywhere_give_the_same(spark):
    # many tasks and tiny batches: words and pairs that begin a stretch of rows end up in other tasks
    rows = [(f"hub {a} {b}. hub {a}. {b} hub {a}", "en") for a in "abc" for b in ["x", "y", "z", *"mnopq"] for _ in range(3)]
    want = brute(rows, 2)
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for parts, size in ((2, 1), (9, 10_000), (23, 2)):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            assert found(frame(spark, rows), least=2) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_small_runs_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "RUN_BYTES", 64)
    rows = texts(5, 60)[:-12]
    assert found(frame(spark, rows), least=3) == brute(rows, 3)


def test_empty_table(spark):
    assert found(frame(spark, [])) == [] and found(frame(spark, [(None, None)])) == []


def test_scores_are_exact_beyond_64_bits(spark):
    values = [(10**15, 10**15, 10**15), (10**15 - 1, 10**15, 10**15), (999_999_999_999_937, 10**15 - 3, 10**15 - 7), (7, 10**15, 9), (10, 10, 30)]
    df = spark.createDataFrame(values, "a long, l long, r long").select("*", C.score("a", "l", "r").alias("s"))
    for r in df.collect():
        assert r.s == int(Decimal(10**6 * r.a * r.a // (r.l * r.r)))
