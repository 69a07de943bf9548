import hashlib
import os
import random

import oracle
import public_tokenizers
import pytest

import corpus_pipeline
from streamlab.llm import bpe, catalogue, secrets
from streamlab.llm.kernels import shingle_sets

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of each kind that a stage must catch, between clean ones."""
    path = str(tmp_path_factory.mktemp("sf"))
    rnd = random.Random(1)
    words = [a + b + c for a in "bdfglm" for b in "aeiou" for c in ("n", "r", "st")]
    text = lambda n: [rnd.choice(words) for _ in range(n)]
    rows, labels = [], []
    for k in range(400):
        toxic = k % 4 == 0
        rows.append((k, " ".join(text(40) + ["vilescum"] * 3 * toxic), "en", "a", None))
        labels.append((k, 1, int(toxic)))
    item = text(30)
    base = text(60)
    rows += [
        (1000, " ".join(base), "en", "a", 1), (1001, " ".join(base), "en", "b", 1), (1002, " ".join(["other", *base[1:]]), "en", "b", 1),
        (1003, " ".join(text(20) + item + text(20)), "en", "a", 1), (1004, "the token = 0123456789abcdef0123456789abcdef ends", "en", "a", 1),
        (1005, None, None, None, None), (1006, "", "en", "a", 0), (None, "no id here", "en", "a", 1), (1007, "again and again", "en", "a", 1),
        (1007, "again and again", "en", "a", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows


def test_stages_keep_what_they_should(spark, folder):
    path, rows = folder
    got = corpus_pipeline.run(spark, path).collect()
    ids = sorted((r.doc_id for r in got), key=str)
    want = [k for k in range(400) if k % 4] + [1000, 1004, 1005, 1006, None, 1007]
    assert ids == sorted(want, key=str)
    text_of = dict((r[0], r[1]) for r in rows)
    vocabulary = bpe.Vocabulary(open(public_tokenizers.path(catalogue.RANKS), "rb").read(), public_tokenizers.PATTERN)
    for r in got:
        text = text_of[r.doc_id] or ""
        text = "the [SECRET] ends" if r.doc_id == 1004 else text
        assert hashlib.sha256(text.encode()).hexdigest() == r.decoded_sha256
        (ids,) = vocabulary.encode_batch([text])
        assert r.n_tokens == len(ids) // 4 == len(r.ids)


def test_every_stage_but_the_last_keeps_the_columns(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE",
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.dtypes == docs.dtypes
        assert stage(spark, docs.limit(0), path).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_queries_equal_sql(spark, name):
    assert oracle.differences(catalogue.QUERIES[name](spark, SF), oracle.connect(SF), catalogue.ORACLES[name]) == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_queries_without_sql(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in catalogue.op8_secrets(spark, SF).collect():
        base = [s for s in secrets.find_secrets(docs[r.doc_id] or "") if s[0] in secrets.BASE_KINDS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b, _ in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.n_assign + r.n_access + r.n_hex == len(base)
    kept = {r.doc_id: r for r in catalogue.op7_suffix_dedup(spark, SF).collect()}
    assert all(kept[i].n_bytes == len((t or "").encode()) for i, t in docs.items())
    sizes = catalogue.op5_sharding(spark, SF).groupBy("shard").sum("size").collect()
    assert len(sizes) == 16
    assert catalogue.op6_main_text(spark, SF).where("text = ''").count() == 0
    import pyarrow as pa

    n = dict(zip(docs, (len(s) for s in shingle_sets(pa.array(list(docs.values()))))))
    assert {r.doc_id: r.n_shingles for r in catalogue.op2_jaccard_join(spark, SF).collect()} == n
