import math
import random
from fractions import Fraction

import numpy as np
import pytest

from streamlab.llm import hard_negatives as H


def brute(rows):
    """Plain loops over all pairs, in Python integers."""
    taken = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) * 256 >= 2**53 for x in v):
            continue
        row = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(Fraction(float(np.float64(x))) * 256) for x in v])
        taken[i] = min(taken.get(i, row), row)
    out = []
    for a, (label, x) in taken.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, c) for i, (c, y) in taken.items() if i != a)
        for s, i, _ in [r for r in scored if r[2] == label][:5]:
            near = [r for r in scored if r[2] != label and 30 * -s <= 100 * -r[0] <= 90 * -s][:10]
            out += [(a, i, k, j, -s, -t) for k, (t, j, _) in enumerate(near, 1)]
    return sorted(out)


def mined(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(int(r[c]) for c in names) for r in H.mine(df).collect())


SCHEMA = "vec_id long, embedding array<double>, label int, along string, block int, vector int, n int, id int, score int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], SCHEMA).repartition(4)


def vectors(rnd, n, width=6, first=0):
    middles = [[rnd.uniform(-1, 1) for _ in range(width)] for _ in range(8)]
    for i in range(first, first + n):
        yield i, [round(m + rnd.gauss(0, 0.2), 2) for m in rnd.choice(middles)], rnd.randrange(10)


@pytest.mark.parametrize("seed,leaf,at_once", [(1, 4, 40), (2, 256, 8_192), (3, 1, 3)])
def test_result_equals_brute_force(spark, monkeypatch, seed, leaf, at_once):
    monkeypatch.setattr(H, "LEAF", leaf)
    monkeypatch.setattr(H, "ROWS_AT_ONCE", at_once)
    monkeypatch.setattr(H, "FAN", 3)
    rnd = random.Random(seed)
    rows = list(vectors(rnd, 420, first=-5))
    # ties: one vector in a third of all rows; then vectors that take no part, short, empty and repeated ones
    rows = [(i, rows[7][1] if i % 3 == 0 else v, label) for i, v, label in rows]
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 1), (501, [1.0, None], 1), (600, [nan, 0.0], 2), (601, [inf], 2), (700, [0.5] * 6, None), (None, [0.5] * 6, 2)]
    rows += [(800, [0.9, 0.1], 3), (801, [], 3), (900, [], 3), (1000, [0.4] * 9, 3), rows[8], rows[8], (1000, [0.3] * 9, 2), (1100, [1e300], 3)]
    got, want = mined(frame(spark, rows)), brute(rows)
    assert got == want and len(want) > 50


def test_large_components_are_exact(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([2.0**44, 2.0**44 - 1 / 256, 2.0**43 + 1 / 256]), rnd.uniform(0, 3), 1 / 256], rnd.randrange(3)) for i in range(60)]
    rows += [(60 + k, [2.0**43.5 * rnd.random(), 1.0, 0.0], 3 + k % 2) for k in range(60)]
    got = mined(frame(spark, rows))
    assert got == brute(rows) and got


def test_more_blocks_change_nothing(spark, monkeypatch):
    rows = list(vectors(random.Random(5), 700))
    whole = mined(frame(spark, rows))
    monkeypatch.setattr(H, "ANCHOR_BYTES", 100)
    assert whole == mined(frame(spark, rows)) == brute(rows)


def test_empty_tables(spark):
    assert mined(frame(spark, [])) == []
    assert mined(frame(spark, [(1, [0.5], 1), (100, [0.5], 2)])) == []  # no positive
    assert mined(frame(spark, [(200, [], 1), (1, [], 1), (2, [], 2)])) == [(200, 1, 1, 2, 0, 0)]


def test_tree_holds_every_row_and_prunes():
    x = np.random.default_rng(6).normal(size=(2_000, 3)).round(2)
    parts = list(H.tiles(x, [0, 1, 2], 16))
    assert sorted(np.concatenate(parts)) == list(range(2_000)) and max(map(len, parts)) <= 16
    low, high = (np.array([f(x[r], axis=0) for r in parts]) for f in (np.min, np.max))
    tree = H.Tree(parts, [r * 0 for r in parts], [x[r] for r in parts], low, high)
    anchor, read = x[5], []

    def rows_of(leaf):
        read.append(leaf)
        return tree.vectors[leaf] @ anchor, tree.ids[leaf]

    found = H.Found(5)
    H.search(tree, [(a[0], b[0]) for a, b in tree.bounds(anchor[None])], rows_of, found, None, None)
    assert list(found.ids) == sorted(range(2_000), key=lambda k: (-(x[k] @ anchor), k))[:5]
    assert len(read) < len(parts) / 4
