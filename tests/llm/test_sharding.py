import zlib
from collections import defaultdict

import numpy as np

from streamlab.llm import sharding as S


def test_bytes_are_even_and_slots_gapless(spark):
    texts = ["word " * (1 + k * k % 97) + str(k % 1500) for k in range(4000)] + [None, "", "", "x" * 9_000] + ["hot copy of a text"] * 3000
    rows = list(enumerate(texts)) + [(5, texts[5]), (None, "no id")]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, shard string").repartition(7)
    got = S.shard(df, units=256).collect()
    assert len(got) == len(rows)
    size, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    text_of = dict(rows)
    for r in got:
        raw = (text_of[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        homes[text_of[r.doc_id]].add(r.shard)
    assert set(size) == set(range(16)) and max(size.values()) < 1.05 * min(size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    hot = homes.pop("hot copy of a text")  # 43 % of the rows: cut into parts
    assert len(hot) > 1 and all(len(h) == 1 for h in homes.values())


def test_place_uses_the_room_left():
    weights = np.random.default_rng(1).random((500, 3))
    weights /= weights.sum(0)
    home = S.place(weights, 5)
    sums = np.array([weights[home == k].sum(0) for k in range(5)])
    assert abs(sums - 0.2).max() < 0.02 and abs(sums[:, 0] - 0.2).max() < 0.002


def test_empty_and_single(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert S.shard(df.limit(0)).collect() == []
    assert [(r.doc_id, r.slot) for r in S.shard(df).collect()] == [(1, 0)]
    same = spark.range(40).selectExpr("id as doc_id", "'same' as text")
    assert S.shard(same).count() == 40
