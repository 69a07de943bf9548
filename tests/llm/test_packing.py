import random
from collections import defaultdict

import numpy as np
import pytest

from streamlab.llm import packing as P


def fullest(sizes, length):
    """Best fit decreasing by looking at every row."""
    rooms = []
    for s in sorted(sizes, reverse=True):
        fit = [k for k, r in enumerate(rooms) if r >= s]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= s
        else:
            rooms.append(length - s)
    return sorted(rooms)


@pytest.mark.parametrize("length", [16, 100, 128])
def test_best_fit_equals_brute_force(length):
    rnd = random.Random(length)
    sizes = [rnd.randrange(1, length + 1) for _ in range(400)]
    rows = P.best_fit(sizes, length)
    assert sorted(i for r in rows for i in r) == list(range(400))
    assert sorted(length - sum(sizes[i] for i in r) for r in rows) == fullest(sizes, length)


def table(spark):
    rnd = random.Random(3)
    rows = [(k, [rnd.randrange(50_000) for _ in range(n)]) for k, n in enumerate([0, 1, 64, 63, 65, 128, 1000, 5, 5, 5, 40, 30, 64])]
    rows += [(20, None), (None, [1, 2, 3]), (5, rows[5][1])]
    return spark.createDataFrame([(i, x, "c") for i, x in rows], "doc_id long, ids array<int>, row_id string").repartition(3), rows


@pytest.mark.parametrize("vocabulary,at_once", [(50_257, 1 << 21), (100_000, 70)])
def test_nothing_is_lost(spark, vocabulary, at_once):
    df, rows = table(spark)
    packed = P.pack(df, length=64, vocabulary=vocabulary, tokens_at_once=at_once)
    kind = "<u2" if vocabulary < 65_536 else "<u4"
    got = packed.collect()
    assert len({r.row_id for r in got}) == len(got)
    for r in got:
        ids, at = np.frombuffer(r.input_ids, kind), np.frombuffer(r.positions, kind)
        assert len(ids) == len(at) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= 64
        assert (ids[r.n_tokens :] == P.PAD).all() if vocabulary > P.PAD else True
        for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]):
            assert at[a:b].tolist() == list(range(b - a))
    pieces = defaultdict(list)
    for r in P.unpack(packed, length=64, vocabulary=vocabulary).collect():
        pieces[r.doc_id].append((r.doc_offset, r.ids))
    want = defaultdict(list)
    for i, x in rows:
        want[i] += [(a, x[a : a + 64]) for a in range(0, len(x or []), 64)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items() if v}


def test_ids_equal_those_of_the_own_codec(spark):
    import public_tokenizers

    from streamlab.llm import catalogue

    df = spark.createDataFrame([(1, "It's ñandú 123\n\n  <|endoftext|>"), (2, None), (3, "")], "doc_id long, text string")
    theirs = P.tokenized(df, public_tokenizers.path(catalogue.RANKS), public_tokenizers.PATTERN)
    assert sorted(theirs.collect()) == sorted(catalogue.codec(spark).encode(df).collect())


def test_write_and_empty(spark, tmp_path):
    df, _ = table(spark)
    P.write(P.pack(df, length=64), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() > 20
    assert P.pack(df.limit(0)).count() == 0


def test_ids_beyond_the_vocabulary_are_an_error(spark):
    df = spark.createDataFrame([(1, [70_000, 5])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="vocabulary of 50257"):
        P.pack(df, length=64).collect()
    (whole,) = P.unpack(P.pack(df, length=64, vocabulary=100_000), length=64, vocabulary=100_000).collect()
    assert whole.ids == [70_000, 5]
    (some,) = P.pack(spark.createDataFrame([(1, [3, None, 5])], "doc_id long, ids array<int>"), length=64).collect()
    assert some.n_tokens == 2


def test_rows_do_not_depend_on_partitions(spark):
    import public_tokenizers

    from streamlab.llm import catalogue

    rnd = random.Random(6)
    rows = [(rnd.choice([None, k, k // 2]), rnd.choice([None, "", "same text"]) if k % 9 == 0 else "word " * rnd.randrange(400)) for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = []
    for parts in (1, 8, 64):
        docs = P.dealt(df.repartition(parts), bytes_at_once=20_000)
        packed = P.pack(P.tokenized(docs, public_tokenizers.path(catalogue.RANKS), public_tokenizers.PATTERN), length=128)
        found.append(sorted(map(str, packed.collect())))
    assert found[0] == found[1] == found[2] and len({r.split("row_id=")[1].split(",")[0] for r in found[0]}) == len(found[0])
