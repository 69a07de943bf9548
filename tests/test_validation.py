from decimal import Decimal

from conftest import rows

from streamlab.operators.validation import conform, conform_valid, split_valid, split_written
from streamlab.schemas import QUOTE_TABLE, required_columns


def test_split_keeps_every_row_once_with_reasons(spark):
    data = [("a", 1.0), (None, 1.0), ("b", None), (None, None)]
    df = spark.createDataFrame(data, "ticker string, preco double")
    valid, rejected = split_valid(df, ["ticker", "preco"])
    assert rows(valid) == [("a", 1.0)]
    assert {(r.ticker, r.preco): r.motivos for r in rejected.collect()} == {
        (None, 1.0): ["ticker ausente"],
        ("b", None): ["preco ausente"],
        (None, None): ["ticker ausente", "preco ausente"],
    }


def test_split_without_required_fields(spark):
    df = spark.createDataFrame([(None,)], "a string")
    valid, rejected = split_valid(df, [])
    assert valid.count() == 1 and rejected.count() == 0


def test_conform_orders_casts_and_applies_not_null(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:00:00", "X", "10.00005", 0.1, 7), ("bad", "Y", "oops", 0.1, 7)],
        "coletado_em string, ticker string, preco string, abertura double, volume int",
    ).selectExpr("*", "null maxima", "null minima", "'BRL' moeda", "'B3' bolsa")
    out = conform(df, QUOTE_TABLE)
    assert out.columns == QUOTE_TABLE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in QUOTE_TABLE]
    valid, rejected = conform_valid(df, QUOTE_TABLE)
    assert [r.preco for r in valid.collect()] == [Decimal("10.0001")]
    assert [r.motivos for r in rejected.collect()] == [["preco ausente", "coletado_em ausente"]]


def test_required_columns():
    assert required_columns(QUOTE_TABLE) == ["ticker", "preco", "coletado_em"]


def test_split_written_reads_its_input_once(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None), (None, None)], "ticker string, preco double")
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    counted = df.mapInArrow(count, df.schema)
    for _ in range(2):  # a replay replaces both sides
        valid, rejected = split_written(counted, ["ticker", "preco"], str(tmp_path / "s"))
    assert calls.value == 8
    assert rows(valid) == [("a", 1.0)] and valid.schema == df.schema
    assert sorted(r.motivos for r in rejected.collect()) == [["preco ausente"], ["ticker ausente"], ["ticker ausente", "preco ausente"]]
    everything, nothing = split_written(df, [], str(tmp_path / "t"))
    assert everything.count() == 4 and nothing.count() == 0
