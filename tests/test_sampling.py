import hashlib
from collections import Counter

from conftest import rows
from pyspark.sql import functions as F

from streamlab.operators.sampling import assign_minibatch, hash_minibatch, shuffled_rank, stratified_split


def md5(key, seed):
    return hashlib.md5(f"{key}|{seed}".encode()).hexdigest()


def people(spark, n, label="id % 3 = 0"):
    return spark.range(n).selectExpr("id", f"cast({label} as int) as outcome")


def test_split_is_exact_per_class_and_repeatable(spark):
    df = people(spark, 5000)
    split = stratified_split(df, "outcome", "id", (0, 1))
    assert split.count() == 5000 and split.select("id").distinct().count() == 5000
    counts = {(r.outcome, r.em_teste): r["count"] for r in split.groupBy("outcome", "em_teste").count().collect()}
    assert counts == {(0, True): 833, (0, False): 2500, (1, True): 417, (1, False): 1250}
    want = set()
    for c in (0, 1):
        ids = sorted((i for i in range(5000) if int(i % 3 == 0) == c), key=lambda i: md5(i, 42))
        want |= set(ids[: round(len(ids) * 0.25 + 1e-9)])
    got = {r.id for r in split.where("em_teste").collect()}
    assert got == want
    assert {r.id for r in stratified_split(df.repartition(7), "outcome", "id", (0, 1)).where("em_teste").collect()} == want


def test_split_small_classes_and_unlisted_labels(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None), (5, 9)], "id long, outcome int")
    got = {r.id: r.em_teste for r in stratified_split(df, "outcome", "id", (0, 1), test=0.5).collect()}
    assert len(got) == 5 and got[4] is False and got[5] is False
    assert sum(got[i] for i in (1, 2)) == 1
    nobody = stratified_split(df, "outcome", "id", (0, 1), test=0.0)
    everybody = stratified_split(df.where("outcome in (0, 1)"), "outcome", "id", (0, 1), test=1.0)
    assert nobody.where("em_teste").count() == 0 and everybody.where("not em_teste").count() == 0


def test_split_share_is_exact_with_a_hot_key(spark, tmp_path):
    df = people(spark, 1000, "0").select(F.when(F.col("id") < 500, 0).otherwise(F.col("id")).alias("id"), "outcome")
    df.write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    row = F.concat_ws(":", "_metadata.file_name", "_metadata.row_index")
    for seed in (4, 5, 6):
        split = stratified_split(df, "outcome", "id", (0, 1), seed=seed, row=row)
        assert split.where("em_teste").count() == 250 and split.count() == 1000
        together = stratified_split(df, "outcome", "id", (0, 1), seed=seed, copies_together=True)
        assert together.where("em_teste").count() <= 250
        assert together.where("id = 0").select("em_teste").distinct().count() == 1


def test_split_orders_copies_of_a_key_by_content(spark):
    df = spark.range(600).selectExpr("id % 3 as k", "id as v", "0 as outcome")
    pick = lambda d: {r.v for r in stratified_split(d, "outcome", "k", (0,)).where("em_teste").collect()}
    first = pick(df)
    assert len(first) == 150 and pick(df.repartition(9)) == first


def test_rank_and_chunks_match_brute_force(spark, tmp_path):
    df = spark.range(1000)
    order = sorted(range(1000), key=lambda i: md5(i, 7))
    assert {r.id: r.posicao for r in shuffled_rank(df, "id", str(tmp_path / "a")).collect()} == {k: n + 1 for n, k in enumerate(order)}
    chunks = {r.id: r.lote for r in assign_minibatch(df, "id", str(tmp_path / "b"), size=30).collect()}
    assert chunks == {k: n // 30 + 1 for n, k in enumerate(order)}
    sizes = Counter(chunks.values())
    assert len(sizes) == 34 and sizes[34] == 10 and set(sizes[c] for c in range(1, 34)) == {30}


def test_shuffle_is_the_same_for_any_partitioning_and_hot_key(spark, tmp_path):
    df = spark.range(3000).select(F.when(F.col("id") < 2700, 5).otherwise(F.col("id")).alias("id"), F.col("id").alias("v"))
    seen = []
    for n in (2, 5, 50):
        ranked = shuffled_rank(df.repartition(n), "id", str(tmp_path / f"a{n}"))
        seen.append({r.v: r.posicao for r in ranked.collect()})
    assert seen[0] == seen[1] == seen[2] and sorted(seen[0].values()) == list(range(1, 3001))
    hot = sorted(p for v, p in seen[0].items() if v < 2700)
    assert hot == list(range(hot[0], hot[0] + 2700))  # its place in the shuffle stays its own
    cold = sorted((v for v in seen[0] if v >= 2700), key=seen[0].get)
    assert cold == sorted(range(2700, 3000), key=lambda i: md5(i, 7))
    same = spark.range(500).select(F.lit(1).alias("id"))
    chunks = assign_minibatch(same, "id", str(tmp_path / "b"), size=70).groupBy("lote").count()
    assert sorted(n for _, n in rows(chunks)) == [10] + [70] * 7


def test_hash_chunks_cover_all_rows(spark):
    got = hash_minibatch(spark.range(2000), "id", 8).groupBy("lote").count()
    sizes = [n for _, n in rows(got, "lote")]
    assert sum(sizes) == 2000 and len(sizes) == 8 and min(sizes) > 150
