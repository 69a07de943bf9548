import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from streamlab.llm import decontaminate as D


def words(text):
    raw = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", raw)


def shingles(w):
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(docs, items):
    """Every window of every document against every item."""
    sets = {i: shingles(words(t)) for i, t in items}
    seen = {}
    for s in sets.values():
        for x in s:
            seen[x] = seen.get(x, 0) + 1
    weight = lambda x: math.log1p(len(items) / seen[x]) if x in seen else math.log1p(len(items))
    out = {}
    for d, t in docs:
        w = words(t)
        for i, text in items:
            size = len(words(text))
            if 0 < size < 5:
                out.update({(d, i): (1.0, 0)} if w == words(text) else {})
                continue
            for a in range(len(w)) if size else ():
                window = shingles(w[a : a + size])
                union = sum(map(weight, window | sets[i]))
                s = sum(map(weight, window & sets[i])) / union
                if s >= 0.75 - 1e-12 and s > out.get((d, i), (0,))[0] + 1e-12:
                    out[d, i] = (s, a)
    return out


def table(seed):
    rnd = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in "bcdfg" for b in ("a", "e", "io", "un")]
    sentence = lambda n: [rnd.choice(vocabulary) + rnd.choice(["", "", "ta"]) for _ in range(n)]
    own = [sentence(rnd.choice([12, 12, 25, 40])) for _ in range(12)]
    own[5] = own[4][:20] + own[5][20:] if len(own[5]) > 20 else own[5]
    items = [(k, " ".join(w)) for k, w in enumerate(own)] + [(100, None), (101, ""), (102, "only three words"), (103, " ".join(own[0]))]
    docs = [(0, None), (1, ""), (2, "ba"), (3, "Only THREE words!")]
    for k in range(4, 60):
        text = sentence(rnd.randrange(150))
        for _ in range(rnd.randrange(3)):
            passage = list(rnd.choice(own))
            for _ in range(rnd.randrange(3)):
                passage[rnd.choice([0, -1])] = "new"
            at = rnd.randrange(len(text) + 1)
            text[at:at] = [w.upper() if k % 2 else w + "," for w in passage]
        docs.append((k, " ".join(text)))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_leaks_equal_brute_force(spark, monkeypatch, seed):
    docs, items = table(seed)
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, leaks int")
    b = spark.createDataFrame(items, "item_id long, text string")
    if seed == 3:
        monkeypatch.setattr(D, "ITEMS_AT_ONCE", 10**6)
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in D.leaks(d, b).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and len(want) > 20
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_items_in_blocks(spark, monkeypatch):
    docs, items = table(4)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in D.leaks(d, b).where("similarity > 0.9").collect()}
    monkeypatch.setattr(D, "ITEMS_AT_ONCE", 5)
    # shingle weights are those of a block, so only clear cases are the same
    assert {(r.doc_id, r.item_id) for r in D.leaks(d, b).where("similarity > 0.9").collect()} == whole
    assert D.leaks(d, b.limit(0)).collect() == [] and D.leaks(d.limit(0), b).collect() == []
    again = D.leaks(d.unionAll(d.where("doc_id = 10")), b)
    assert again.where("doc_id = 10").count() == 2 * D.leaks(d, b).where("doc_id = 10").count()


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    _, items = table(5)
    index = D.ItemIndex([i for i, _ in items], [t for _, t in items])
    size = next(s for s in index.by_size if len(index.by_size[s][0]) > 2)
    which, prints, _ = index.by_size[size]
    noisy = prints[rng.integers(0, len(prints), 400)]
    for _ in range(25):
        flips = (np.uint64(1) << rng.integers(0, 64, noisy.shape, np.uint64)) * (rng.random(noisy.shape) < 0.9).astype(np.uint64)
        noisy = noisy ^ flips
    window, item, distance = index.within(size, noisy)
    want = {(w, which[i]) for w in range(len(noisy)) for i in range(len(prints)) if D.distances(noisy[w : w + 1], prints[i : i + 1])[0] <= D.RADIUS}
    assert set(zip(window.tolist(), item.tolist())) == want and (distance <= D.RADIUS).all()


def test_long_text():
    _, items = table(6)
    index = D.ItemIndex([i for i, _ in items], [t for _, t in items])
    text = "lorem " * 60_000 + items[3][1] + " ipsum" * 60_000
    (found,) = D.matches_of(index, pa.array([text]), 0.75).to_pylist()
    assert [(m["item_id"], m["first_word"]) for m in found if m["similarity"] > 0.999] == [(3, 60_000)]


@pytest.mark.parametrize("at_once", [1, 4, 7])
def test_blocks_change_no_match(spark, monkeypatch, at_once):
    docs, items = table(7)
    # items that share half their words, so that weights decide who passes
    items += [(200 + k, " ".join(items[k % 4][1].split()[:7] + items[k][1].split()[-6:])) for k in range(12)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: sorted(tuple(r) for r in D.leaks(d, b).collect())
    whole = found()
    monkeypatch.setattr(D, "ITEMS_AT_ONCE", at_once)
    assert found() == whole and {(d, i) for d, i, *_ in whole} == brute(docs, items).keys()
