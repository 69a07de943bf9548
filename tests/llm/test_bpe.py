import base64
import random

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from streamlab.llm import bpe, catalogue

RAW = open(public_tokenizers.path(catalogue.RANKS), "rb").read()
ODD = [
    None, "", " ", "a" * 3000, "ab" * 700, "\x1c\x1d a\x85b  c   \n\n x", "日本語のテキスト" * 60, "🙂🙃" * 90, "<|endoftext|> it's I'LL ''",
    "x" * 63 + " " + "y" * 64 + " " + "z" * 65, "\x00\x01", " \t \n", "1234567890" * 30, "٣٤٥ ⅷ ²", "Straße été ñandú", "áë",
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts(seed):
    rnd = random.Random(seed)
    parts = ["the", "tion", "ção", " ", "  ", "\n", "9", "'s", "Ünï", "—", "zq", "ß", "​", "日", "x" * 70]
    return ["".join(rnd.choice(parts) for _ in range(rnd.randrange(60))) for _ in range(300)]


@pytest.mark.parametrize("cached", [250_000, 50])
def test_ids_equal_the_library(library, monkeypatch, cached):
    monkeypatch.setattr(bpe, "CACHED_PIECES", cached)
    monkeypatch.setattr(bpe, "BYTES_AT_ONCE", 2_000)
    vocabulary = bpe.Vocabulary(RAW, public_tokenizers.PATTERN)
    batch = ODD + texts(1) + texts(1)
    assert bpe.encode_array(vocabulary, pa.array(batch)).to_pylist() == [library.encode_ordinary(t or "") for t in batch]


def test_one_tree_equals_many():
    vocabulary = bpe.Vocabulary(RAW, public_tokenizers.PATTERN)
    pieces = [p.encode() for p in ("reinventing", "ñandú", "tionstion", "zz", "aaaaaaaaaaaaaaa")]
    ids, ends = vocabulary._merge_many(pieces, 16)
    cuts = [0, *ends]
    for k, piece in enumerate(pieces):
        assert vocabulary._merge_one(piece) == memoryview(ids[cuts[k] : cuts[k + 1]]).cast("i").tolist()


def test_round_trip_in_spark(spark):
    rows = [(k, t, "clash") for k, t in enumerate(ODD)] + [(0, None, "clash"), (None, "again", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = catalogue.digests(catalogue.codec(spark).round_trip(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert bytes(r.decoded) == (r.text or "").encode() and r.n_tokens == len(r.ids)
    assert catalogue.codec(spark).round_trip(df.limit(0)).count() == 0


def test_ids_outside_the_vocabulary_are_refused():
    import numpy as np

    with pytest.raises(ValueError):
        bpe.Vocabulary(RAW, public_tokenizers.PATTERN).decode_batch(np.array([99_999]), np.array([0, 1]))
