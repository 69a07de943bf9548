import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from streamlab.llm import quality as Q


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {k + i for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for i in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


TEXTS = [
    None, "", " \n\t", "a", "a b c d e", "a b c d e a b c d e", "x " * 50, "one\ntwo\none\n \n \none", "é🙂 # * $%& |<>", "a\x0bb\x0cc\r\nd",
    "p q r s t u v p q r s t u w p q r s t", " ".join(f"w{k % 700}" for k in range(5000)), "  nbsp is no space here a b c d",
]


def test_measures_equal_brute_force(spark):
    df = spark.createDataFrame([(k, t, 7) for k, t in enumerate(TEXTS)], "doc_id long, text string, n_words int")
    for r in Q.measures(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text), r.text
    assert Q.measures(df.limit(0)).count() == 0


@pytest.mark.parametrize("n,k,alpha", [(10, 0, 0.02), (500, 3, 0.02), (5000, 60, 0.02), (40, 40, 0.5), (1, 0, 0.3)])
def test_tail_is_the_exact_binomial(spark, n, k, alpha):
    want = math.fsum(math.comb(n, i) * alpha**i * (1 - alpha) ** (n - i) for i in range(k + 1))
    got = spark.range(1).select(Q.tail(F.lit(n), F.lit(k), alpha).alias("p")).first().p
    assert got == pytest.approx(want, rel=1e-9)


def test_cut_offs_follow_the_labels(spark):
    clean = "plain words of a text that is long enough to pass the base rules number {}"
    junk = "".join(f" ###{k} $$${k}" for k in range(12))
    rows = [(k, clean.format(k), "a") for k in range(900)] + [(1000 + k, clean.format(k) + junk, "a") for k in range(100)]
    rows += [(2000 + k, clean.format(k) + junk, "b") for k in range(20)] + [(3000, None, None), (3001, clean.format(1), None), (3001, clean.format(1), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(k, 1) for k in range(900)] + [(2000 + k, 1) for k in range(20)] + [(None, 1), (9, None)], "doc_id long, quality int")
    got = {}
    for r in Q.judge(docs, labels).collect():
        got.setdefault(r.doc_id, []).append(r.kept)
    assert all(got[k] == [True] for k in range(900)) and all(got[1000 + k] == [False] for k in range(100))
    assert all(got[2000 + k] == [True] for k in range(20))  # too few labels to cut anything
    assert got[3000] == [False] and got[3001] == [True, True]
    nobody = Q.judge(docs, labels.limit(0)).collect()  # without labels the base rules alone
    assert all(r.kept == (not r.base_failed) for r in nobody)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    plan = Q.judge(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_small_sources_are_judged_together(spark):
    clean = "plain words of a text that is long enough to pass the base rules number {}"
    junk = "".join(f" ###{k} $$${k}" for k in range(12))
    # twenty sources of 45 good documents: none could bound two percent by itself
    rows = [(k, clean.format(k), f"s{k % 20}") for k in range(900)] + [(1000 + k, clean.format(k) + junk, f"s{k % 20}") for k in range(60)]
    rows += [(5000, clean.format(1) + junk, "unlabelled")]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, source string, _stratum int, _words string, _level int")
    labels = spark.createDataFrame([(k, 1) for k in range(900)], "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.judge(docs, labels).collect()}
    assert all(got[k].kept for k in range(900)) and not any(got[1000 + k].kept for k in range(60))
    assert got[5000].kept  # nothing is known of its source
    assert (got[3]._stratum, got[3]._words, got[3]._level) == (1, "x", 2)
    few = Q.judge(docs, labels.where("doc_id < 100")).collect()
    assert all(r.kept for r in few)
