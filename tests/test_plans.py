"""Physical plans: pruning, push-down, shuffle counts and the absence of costly operators."""

import os
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.catalogue import all_queries, tables
from streamlab.operators import linear, tally
from streamlab.operators.ordering import both_ends
from streamlab.operators.sampling import shuffled_rank, stratified_split
from streamlab.operators.validation import split_written
from streamlab.sinks import KeyedTable

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

# whole-table batch queries; the streaming ones return a read of what they wrote
BATCH = [
    "flight_windows_batch", "quote_clean", "quote_ohlcv", "quote_minute_avg", "quote_moving_avg",
    "quote_drop_alert", "quote_latest10", "vote_decode", "vote_national_total", "vote_pivot_winner",
    "vote_champion", "patient_filter", "patient_split", "patient_minibatches", "post_sentiment",
    "post_distribution", "post_share",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan))


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_and_no_python_in_batch_queries(spark, name):
    plan = plan_of(all_queries()[name](spark, SF))
    for costly in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert costly not in plan


def test_columns_are_pruned_at_the_scan(spark):
    plan = plan_of(all_queries()["flight_windows_batch"](spark, SF))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan
    plan = plan_of(all_queries()["quote_latest10"](spark, SF))
    assert "TakeOrderedAndProject" in plan and "props" not in plan


def test_filters_reach_the_scan(spark):
    votes = tables.votes(tables.events(spark, SF)).where("candidato = 'click'")
    assert "EqualTo(event_type,click)" in plan_of(votes)


def test_aggregations_shuffle_once_and_hash(spark):
    ev = tables.votes(tables.events(spark, SF))
    counts = tally.running_count(ev, ["estado", "candidato"])
    assert exchanges(plan_of(counts)) == 1
    board = tally.pivot_sum(ev.withColumn("votos", F.lit(1)), "estado", "candidato", tables.CANDIDATES, "votos")
    assert exchanges(plan_of(board)) == 1
    for name in ("flight_windows_batch", "quote_ohlcv", "quote_minute_avg", "vote_national_total"):
        plan = plan_of(all_queries()[name](spark, SF))
        assert "SortAggregate" not in plan and "partial_" in plan


def test_texts_are_not_shuffled(spark):
    plan = plan_of(all_queries()["patient_filter"](spark, SF))
    below = plan.split("Join", 1)[1]
    for line in below.splitlines():
        assert not ("Exchange" in line and "text" in line)
    assert exchanges(plan_of(all_queries()["post_sentiment"](spark, SF))) == 0


def test_split_does_not_shuffle_the_rows(spark):
    df = spark.range(100).selectExpr("id", "cast(id % 2 as int) as outcome", "'payload' as texto")
    plan = plan_of(stratified_split(df, "outcome", "id", (0, 1)))
    big_side = plan.split("BroadcastExchange", 1)[0]
    assert exchanges(big_side) == 0 and "Sort " not in big_side


def test_keyed_table_merges_by_hash(spark, tmp_path):
    schema = T.StructType().add("k", "string").add("n", "long")
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], schema)
    for n in range(2):
        table.upsert(spark.createDataFrame([("a", n)], schema), n)
    assert "SortAggregate" not in plan_of(table.read_current())


def executed(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_seeded_shuffle_has_one_exchange_of_the_data(spark, tmp_path):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    ranked = executed(shuffled_rank(df, "id", str(tmp_path / "r")))
    assert "rangepartitioning" not in ranked and "SortMergeJoin" not in ranked
    # what is left after the write is about files: one row each
    assert ranked.count("Exchange") <= 3 and ranked.count("hashpartitioning(_arquivo") == 1


def test_split_reads_one_side_only(spark, tmp_path):
    df = spark.range(10).select(F.when(F.col("id") > 3, F.col("id")).alias("k"))
    valid, rejected = split_written(df, ["k"], str(tmp_path / "s"))
    for side in (valid, rejected):
        assert "PartitionFilters: [isnotnull(valida" in executed(side) and "Exchange" not in executed(side)


def test_preview_scans_and_joins_once(spark, tmp_path):
    for n in ("a", "b"):
        spark.range(50).withColumnRenamed("id", "k").withColumn(n, F.lit(1)).write.parquet(str(tmp_path / n))
    base = spark.read.parquet(str(tmp_path / "a")).join(spark.read.parquet(str(tmp_path / "b")), "k")
    plan = executed(both_ends(base, "k", 3))
    assert plan.count("FileScan") == 2 and plan.count("HashJoin") + plan.count("SortMergeJoin") == 1


def test_newton_step_is_one_aggregation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0), (3.0, 1.0, 1)], "glucose double, bmi double, outcome int")
    plan = executed(linear.curvature_sums(df, linear.Model.untrained(linear.fit_scaler(df))))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange SinglePartition") == 1
