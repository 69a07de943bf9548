import random

import numpy as np
import pyarrow as pa
import pytest

from streamlab.llm import suffix_dedup as S


def brute(rows):
    first, out = {}, {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - S.LENGTH + 1):
            w = raw[i : i + S.LENGTH]
            if first.setdefault(w, (d, i)) < (d, i):
                gone[i : i + S.LENGTH] = b"\1" * S.LENGTH
        spans = []
        for i in range(len(raw)):
            if gone[i]:
                if spans and spans[-1][1] == i:
                    spans[-1][1] = i + 1
                else:
                    spans.append([i, i + 1])
        out[d] = (len(raw), spans, bytes(x for x, g in zip(raw, gone) if not g))
    return out


def removed(df):
    return {r.doc_id: (r.n_bytes, [list(s) for s in zip(r.span_starts, r.span_ends)], bytes(r.kept)) for r in S.dedup(df).collect()}


@pytest.mark.parametrize("seed", [5, 6])
def test_spans_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    base = "".join(rnd.choice("abcdefghij é") for _ in range(3000))
    rows = [
        (0, base), (1, base), (2, base[100:250]), (3, "x" * 57 + base[1000:1100] + "y" * 57), (4, base[1000:1099]), (5, "z" * 1000), (6, "z" * 150),
        (7, "ab" * 300), (8, None), (9, ""), (10, base[:500] + "é" + base[500:1500] + "Q" + base[1500:]), (11, base[37:300] + base[37:300]),
        (12, "q" * 99), (13, "q" * 100), (14, "q" * 101), (15, "abcdefghijklmnopqrstuvwxyz" * 9),
    ]
    for k in range(16, 60):
        text = base
        for _ in range(rnd.randrange(12)):
            a = rnd.randrange(len(text))
            text = text[:a] + rnd.choice(["", "X", "yy"]) + text[a + rnd.randrange(3) :]
        a = rnd.randrange(2000)
        rows.append((k, text[a : a + rnd.randrange(1500)]))
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, kept string").repartition(5)
    assert removed(df) == brute(rows)


def test_odd_ids(spark):
    a, b = "".join(chr(97 + k * k % 23) + str(k) for k in range(90)), "".join(chr(65 + k * k % 19) + str(k) for k in range(90))
    df = spark.createDataFrame([(1, a), (1, a), (2, a), (3, b), (3, b + a), (None, a)], "doc_id long, text string")
    got = [(r.doc_id, bytes(r.kept).decode()) for r in S.dedup(df).collect()]
    assert got.count((1, a)) == 2 and (2, "") in got and (None, a) in got and len(got) == 6
    assert S.dedup(df.limit(0)).collect() == []


def test_cover_meets_every_difference():
    assert {(a - b) % S.PERIOD for a in S.COVER for b in S.COVER} == set(range(S.PERIOD))


@pytest.mark.parametrize("hot,share", [(1, 1), (40, 1), (100, 2)])
def test_hot_cores_give_the_same_spans(spark, monkeypatch, hot, share):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "HOT_SHARE", share)
    rnd = random.Random(8)
    line, edge = ("".join(rnd.choice("abcdefghij ") for _ in range(n)) for n in (260, 70))
    rows = []
    for k in range(120):
        own = "".join(rnd.choice("klmnopqrst ") for _ in range(120))
        rows.append((k, own[: k % 60] + (line if k % 3 else edge) + own[60:] + rnd.choice(["", line[:130] + "!"])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert removed(df) == brute(rows)


def records(batches, bits, kinds):
    """Records of each part, apart from places and stretches that are already settled."""
    rows = sorted(((p, [c[k].as_py() for c in b.columns[1:]]) for b in batches for k, p in enumerate(b["part"].to_pylist())), key=lambda r: r[0])
    merged = pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in rows], pa.int32()), *(pa.array(c, pa.binary()) for c in zip(*(r for _, r in rows)))], ["part", *(f"c{k}" for k in range(len(kinds)))]
    )
    return {p: c for p, c in S.gather(iter([merged]), kinds) if p < 2 << bits}


def test_a_core_of_many_places_spreads():
    bits, full = 8, np.full(1 << (S.TABLE_BITS - 3), 255, np.uint8)
    none, all_hot = np.zeros(1 << (S.HOT_BITS - 3), np.uint8), np.full(1 << (S.HOT_BITS - 3), 255, np.uint8)
    rnd = random.Random(9)
    text = "".join(rnd.choice("abcdefghij ") for _ in range(300))
    kinds = [np.uint32, np.uint64, np.int64, np.int32]

    def batch(texts):
        return iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["doc_id", "text"])])

    # equal surroundings: one record per name, not one per document
    same = records(S._samples(bits, full, none, batch([text] * 500)), bits, kinds)
    assert sum(len(c[2]) for c in same.values()) < 300
    # one core with many surroundings
    texts = ["".join(rnd.choice("klmnopqrst ") for _ in range(57)) + text[:60] + "".join(rnd.choice("klmnopqrst ") for _ in range(57)) for _ in range(500)]
    parts = records(S._samples(bits, full, all_hot, batch(texts)), bits, kinds)
    assert max(len(c[2]) for c in parts.values()) < 100
    look = pa.array([[57, 58, 60]] * 500, pa.list_(pa.int32()))
    near = [pa.RecordBatch.from_arrays([*b.columns, look], [*b.schema.names, "look"]) for b in batch(texts)]
    strings = records(S._surroundings(bits, all_hot, iter(near)), bits, [np.uint8, np.int64, np.int32, np.uint8, np.uint8])
    assert len(strings) > 200 and max(len(c[1]) for c in strings.values()) < 2_000


def test_filter_lets_little_pass_that_does_not_repeat():
    bits, rnd = 8, random.Random(10)
    texts = ["".join(rnd.choice("abcdefghij ") for _ in range(600)) for _ in range(2000)]

    def batch(own):
        return iter([pa.RecordBatch.from_arrays([pa.array(range(len(own)), pa.int64()), pa.array(own)], ["doc_id", "text"])])

    grams = [b for _ in range(2) for b in S._grams(bits, batch(texts[:1000]))]
    dealt = {p: c[0] for p, c in records(grams, bits, [np.uint32]).items()}
    assert len(dealt) > 250 and max(map(len, dealt.values())) < 4 * np.mean([len(c) for c in dealt.values()])
    rows = [S.deal(np.full(len(c), p, np.int32), [c]) for p, c in sorted(dealt.items())]
    twice = list(S._twice(bits, iter(rows)))
    size = S.table_bits(sum(b["n"][0].as_py() for b in twice))
    table = np.zeros(1 << (size - 3), np.uint8)
    step = len(table) >> bits
    for b in S._shares(bits, size, iter(twice)):
        table[b["part"][0].as_py() * step :][:step] = np.frombuffer(b["c0"][0].as_py(), np.uint8)

    def passed(table, own):
        data, offsets = S.utf8(pa.array(own))
        return len(S._suspects(bits, table, S.Hashes(data), len(data), offsets))

    full = np.full(len(table), 255, np.uint8)
    assert passed(table, texts[:1000]) == passed(full, texts[:1000])  # all of them repeat
    assert passed(table, texts[1000:]) < 0.1 * passed(full, texts[1000:])
