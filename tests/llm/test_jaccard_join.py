import random
import re
from collections import defaultdict

import numpy as np
import pytest

from streamlab.llm import jaccard_join as J
from streamlab.llm.components import components
from streamlab.llm.kernels import shingle_sets


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    base = [[rnd.choice(words) for _ in range(rnd.choice([5, 6, 7, 9, 12, 16, 18, 40, 90]))] for _ in range(25)]
    passage = [rnd.choice(words) for _ in range(30)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "a b c"), (4, "A  b\tC"), (5, "a b"), (6, "x"), (7, "x")]
    for k in range(8, 220):
        text = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 1, 2])):
            at = rnd.randrange(len(text) + 1)
            text[at : at + rnd.randrange(2)] = [rnd.choice(words)]
        if k % 5 == 0:
            text += passage
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("seed,light", [(1, None), (2, 14), (3, 0)])
def test_components_equal_brute_force(spark, monkeypatch, seed, light):
    if light is not None:
        monkeypatch.setattr(J, "boundary", lambda *_: light)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, component_id string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(df).collect()}
    assert got == brute(rows)


def test_many_near_copies(spark):
    rnd = random.Random(9)
    base = [f"v{k}" for k in range(120)]
    rows = []
    for k in range(300):
        text = list(base)
        for at in rnd.sample(range(120), rnd.randrange(4)):
            text[at] = f"n{rnd.random()}"
        rows.append((k, " ".join(text)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute(rows)


def test_odd_ids_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.link(df).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (2, 1, 2)], key=str)
    assert J.link(df.limit(0)).collect() == []


def test_bounds():
    rnd = random.Random(3)
    for _ in range(300):
        a, b = (set(rnd.sample(range(40), rnd.randrange(1, 30))) for _ in "ab")
        similar = 100 * len(a & b) >= 75 * len(a | b)
        assert similar == (len(a & b) >= J.needed(len(a), len(b)))
        if similar:
            assert len(b) in J.sizes_like(len(a))
            order = sorted(a)[: J.prefix_length(len(a))], sorted(b)[: J.prefix_length(len(b))]
            assert set(order[0]) & set(order[1])
            first = min(a & b)
            assert len(a) - sorted(a).index(first) >= J.needed(len(a), len(b))
        x, y = (np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in (a, b))
        assert J.sketches_differ(J.sketch(x), J.sketch(y)) <= len(a ^ b)


def test_sketches_of_different_lengths_fold():
    rng = np.random.default_rng(4)
    x = np.unique(rng.integers(0, 2**63, 900, np.uint64))
    assert J.sketches_differ(J.sketch(x), J.sketch(x[:700])) <= len(x) - 700


def test_shingle_counts():
    import pyarrow as pa

    texts = [t for _, t in corpus(5)]
    assert [len(s) for s in shingle_sets(pa.array(texts))] == [len(shingles(t)) for t in texts]


def test_components(spark):
    rnd = random.Random(2)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (None, 3)]
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    want, seen = {}, set()
    for start in sorted(near):
        todo = [start]
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                want[x] = start
                todo += near[x]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
