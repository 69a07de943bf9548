from datetime import datetime
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from streamlab import functions as fn


def one(spark, column, schema, *values):
    df = spark.createDataFrame([(v,) for v in values], f"c {schema}")
    return [r[0] for r in df.select(column).collect()]


def test_event_time_parse_turns_bad_text_into_null(spark):
    df = spark.createDataFrame([("2024-05-01 10:20:30",), ("ontem",), (None,), ("2024-05-01T10:20:30",)], "c string")
    got = [r[0] for r in fn.parse_event_time(df, "c").collect()]
    assert got == [datetime(2024, 5, 1, 10, 20, 30), None, None, datetime(2024, 5, 1, 10, 20, 30)]


def test_event_time_parse_with_format(spark):
    df = spark.createDataFrame([("01/05/2024",), ("x",)], "c string")
    got = [r[0] for r in fn.parse_event_time(df, "c", "dd/MM/yyyy").collect()]
    assert got == [datetime(2024, 5, 1), None]


def test_zero_and_absent_values(spark):
    assert one(spark, fn.zero_to_null("c"), "double", 0.0, 1.5, None) == [None, 1.5, None]
    assert one(spark, fn.default_if_absent("c", "BRL"), "string", None, "USD") == ["BRL", "USD"]


def test_drop_zero_missing(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.0, 2.0), (1.0, 0.0), (None, 1.0)], "a double, b double")
    assert rows(fn.drop_zero_missing(df, ["a", "b"])) == [(1.0, 2.0)]


def test_decimal_rounds_half_up_and_rejects_misfits(spark):
    df = spark.createDataFrame([(1.00005,), (None,), (1e20,)], "c double")
    assert [r[0] for r in fn.to_decimal(df, ["c"]).collect()] == [Decimal("1.0001"), None, None]


def test_round_goes_through_decimal(spark):
    assert one(spark, fn.round_decimal("c", 1), "double", 0.25, 0.35, -0.25, None) == [0.3, 0.4, -0.3, None]


def test_head_chars_counts_characters(spark):
    assert one(spark, fn.head_chars("c", 3), "string", "ação", "a", "", None) == ["açã", "a", "", None]


def test_count_words(spark):
    assert one(spark, fn.count_words("c"), "string", "a b  c", "a", "") == [4, 1, 1]


def test_composite_key_spells_out_null(spark):
    df = spark.createDataFrame([("SP", "A"), (None, "A"), ("SP", None), (None, None)], "e string, c string")
    got = [r[0] for r in df.select(fn.composite_key("e", "c")).collect()]
    assert got == ["SP|A", "None|A", "SP|None", "None|None"]


def test_star_count_and_label(spark):
    labels = ["1 star", "2 stars", "3 stars", "4 stars", "5 stars", "no digit", None]
    assert one(spark, fn.star_count("c"), "string", *labels) == [1, 2, 3, 4, 5, None, None]
    assert one(spark, fn.star_label(F.col("c")), "int", 1, 2, 3, 4, 5, None) == [
        "NEGATIVO", "NEGATIVO", "NEUTRO", "POSITIVO", "POSITIVO", None,
    ]


def test_versus(spark):
    df = spark.createDataFrame([(3, 1), (1, 3), (2, 2)], "a int, b int")
    assert [r[0] for r in df.select(fn.versus("a", "b", "H", "S")).collect()] == ["H", "S", "EMPATE"]


def test_pct_change(spark):
    df = spark.createDataFrame([(98.0, 100.0), (1.0, 0.0), (1.0, None)], "p double, o double")
    assert [r[0] for r in df.select(fn.pct_change("p", "o")).collect()] == [-2.0, None, None]


def test_round_is_done_once(spark):
    got = one(spark, fn.round_decimal("c", 1), "double", 0.2499999996, 0.0499999996, 0.1 + 0.15, 1e23, float("nan"), 2e40)
    assert got == [0.2, 0.0, 0.3, 1e23, None, None]


def test_composite_keys_do_not_collide(spark):
    parts = [(None, "z"), ("None", "z"), ("x|y", "z"), ("x", "y|z"), ("x\\", "y"), ("x\\|y", ""), ("", ""), (None, None)]
    df = spark.createDataFrame(parts, "a string, b string")
    assert len({r[0] for r in df.select(fn.composite_key("a", "b")).collect()}) == len(parts)
