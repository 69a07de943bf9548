import random
from collections import defaultdict

import numpy as np
import pytest

from streamlab.llm import substring_dedup as S


def brute(rows):
    """What is left of each document, all windows taken one by one."""
    texts = {d: (t or "").encode().split() for d, t in rows}
    places = defaultdict(set)
    for d, w in texts.items():
        for i in range(len(w) - S.WINDOW + 1):
            places[tuple(w[i : i + S.WINDOW])].add((d, i))
    gone = {d: [False] * len(w) for d, w in texts.items()}
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                gone[d][i : i + S.WINDOW] = [True] * S.WINDOW
    out = {}
    for d, w in texts.items():
        spans = [[i, i + 1] for i, g in enumerate(gone[d]) if g]
        merged = []
        for s in spans:
            if merged and merged[-1][1] == s[0]:
                merged[-1][1] = s[1]
            else:
                merged.append(s)
        out[d] = (len(w), merged, b" ".join(x for x, g in zip(w, gone[d]) if not g).decode())
    return out


def removed(df):
    return {r.doc_id: (r.n_words, [list(s) for s in zip(r.span_starts, r.span_ends)], r.kept) for r in S.dedup(df).collect()}


def corpus(seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["é", "Ab", "ab", "日本"]
    base = [rnd.choice(vocabulary) for _ in range(700)]
    rows = [
        (0, " ".join(base)), (1, "\t".join(base)), (2, " ".join(base[100:134])), (3, " ".join(base[100:135])), (4, "x " * 100), (5, "x " * 34),
        (6, None), (7, ""), (8, " \n\t "), (9, " ".join(["y", "z"] * 40)), (10, " ".join(base).upper()), (11, "a" * 200_000 + " b"),
        (12, " ".join(f"u{k}" for k in range(20_000))), (13, " ".join(f"u{k}" for k in range(10_000, 10_040))),
    ]
    for k in range(14, 60):
        words = list(base)
        for _ in range(rnd.randrange(25)):
            a = rnd.randrange(len(words))
            words[a : a + rnd.randrange(3)] = [rnd.choice(vocabulary)]
        a = rnd.randrange(500)
        rows.append((k, rnd.choice([" ", "  ", "\n"]).join(words[a : a + rnd.randrange(300)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_result_equals_brute_force(spark, seed):
    rows = corpus(seed)
    names = "doc_id long, text string, first string, last int, part int, records string, __place_in_id_table string"
    df = spark.createDataFrame([(d, t, "c", 1, 2, "r", "p") for d, t in rows], names).repartition(5)
    assert removed(df) == brute(rows)


@pytest.mark.parametrize("at_once", [1, 50])
def test_small_buffers_change_nothing(spark, monkeypatch, at_once):
    monkeypatch.setattr(S, "RECORDS_AT_ONCE", at_once)
    rows = [r for r in corpus(4) if r[0] != 12]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert removed(df) == brute(rows)


def test_odd_ids_and_repeated_rows(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(50)) for c in "ab")
    rows = [(1, a), (1, a), (2, b), (3, b + " c"), (3, b), (3, b), (None, a), (None, b), (4, None), (4, None)]
    got = sorted(((r.doc_id or 0, r.kept) for r in S.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got.count((1, a)) == 2 and got.count((4, "")) == 2  # a row that repeats is no other place
    assert got.count((0, a)) == got.count((0, b)) == 1 and len(got) == 10
    assert (2, "") in got  # the document of 3 holds b, whichever of its texts it is


def test_empty_table(spark):
    assert S.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert S.dedup(spark.createDataFrame([(1, None)], "doc_id int, text string")).first().n_words == 0


def test_cover_meets_every_difference():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))
    assert S.CORE + S.PERIOD - 1 == S.WINDOW


def test_a_name_in_all_documents_sends_one_record_per_buffer():
    records = np.zeros(1000, S._WINDOW)
    records["doc"] = np.arange(1000)
    many, one = S.repeats(records)
    assert many.all() and one.sum() == 1
