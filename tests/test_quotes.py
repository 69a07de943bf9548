import random
from datetime import datetime, timedelta

from conftest import rows
from pyspark.sql import functions as F

from streamlab.operators.ordering import both_ends, latest, preview
from streamlab.operators.quotes import clean_quotes, ohlcv, price_drop_alerts
from streamlab.operators.windows import moving_average
from streamlab.schemas import QUOTE


def quote(**kw):
    base = dict(ticker="PETR4", preco=10.0, abertura=None, maxima=None, minima=None, volume=None,
                moeda=None, bolsa=None, coletado_em="2024-01-01 10:00:00")
    return tuple((base | kw)[n] for n in QUOTE.names)


def test_clean(spark):
    df = spark.createDataFrame(
        [quote(abertura=0.0, volume=0), quote(abertura=9.5, volume=7, moeda="USD", coletado_em="??")], QUOTE
    )
    got = clean_quotes(df).select("abertura", "volume", "moeda", "bolsa", "coletado_em").collect()
    assert tuple(got[0]) == (None, None, "BRL", "B3", datetime(2024, 1, 1, 10))
    assert tuple(got[1]) == (9.5, 7, "USD", "B3", None)


def test_drop_alert_is_strict(spark):
    data = [(98.0, 100.0), (97.99, 100.0), (32.6634, 33.33), (32.66, 33.33), (99.0, 100.0), (1.0, 0.0), (1.0, None), (-1.0, 0.0), (-3.0, -1.0)]
    df = spark.createDataFrame(data, "preco double, abertura double")
    assert sorted(r.preco for r in price_drop_alerts(df).collect()) == [32.66, 97.99]
    assert [r.preco for r in price_drop_alerts(df, threshold=0.5).where("abertura = 100").orderBy("preco").collect()] == [97.99, 98.0, 99.0]


def test_latest_breaks_ties(spark):
    data = [(f"T{n:02d}", 1.0, datetime(2024, 1, 1, 0, 0, n // 3)) for n in range(30)]
    df = spark.createDataFrame(data, "ticker string, preco double, coletado_em timestamp").repartition(8)
    want = sorted(data, key=lambda r: (-r[2].timestamp(), r[0]))[:10]
    assert rows(latest(df)) == want


def brute(bars):
    out = {}
    for t, ts, i, o, h, l, c, v in sorted(bars, key=lambda b: (b[1], b[2])):
        k = (t, ts.replace(hour=0, minute=0, second=0, microsecond=0))
        if k not in out:
            out[k] = [o, h, l, c, v]
        else:
            e = out[k]
            out[k] = [e[0], max(e[1], h), min(e[2], l), c, e[4] + v]
    return {k: tuple(v) for k, v in out.items()}


def test_ohlcv_with_ties_matches_brute_force(spark):
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    bars = [
        (rng.choice("AB"), start + timedelta(minutes=rng.randrange(4000) // 50), n - 1000,
         *[float(rng.randrange(100)) for _ in range(4)], rng.randrange(9))
        for n in range(2000)
    ]
    df = spark.createDataFrame(
        bars, "ticker string, ts timestamp, bar_id long, open double, high double, low double, close double, volume long"
    ).repartition(8)
    result = ohlcv(df)
    assert {(r.ticker, r.periodo): tuple(r)[2:] for r in result.collect()} == brute(bars)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_moving_average_windows(spark):
    df = spark.createDataFrame(
        [("A", 1.0, datetime(2024, 1, 1, 0, 0, 59)), ("A", 3.0, datetime(2024, 1, 1, 0, 1, 0))],
        "ticker string, preco double, coletado_em timestamp",
    )
    tumbling = rows(moving_average(df).select("janela_inicio", "preco_medio"), "janela_inicio")
    assert tumbling == [(datetime(2024, 1, 1), 1.0), (datetime(2024, 1, 1, 0, 1), 3.0)]
    sliding = rows(moving_average(df, slide="30 seconds").select("janela_inicio", "preco_medio"), "janela_inicio")
    assert sliding == [
        (datetime(2024, 1, 1), 1.0),
        (datetime(2024, 1, 1, 0, 0, 30), 2.0),
        (datetime(2024, 1, 1, 0, 1), 3.0),
    ]


def test_preview_both_ends(spark):
    df = spark.range(20).repartition(4)
    assert rows(preview(df, "id", 3)) == [(0,), (1,), (2,)]
    assert rows(preview(df, "id", 2, last=True)) == [(19,), (18,)]


def test_drop_alerts_on_any_number(spark):
    from streamlab.operators.quotes import unrepresentable

    nan, inf = float("nan"), float("inf")
    data = [(95_000.0, 130_000.0), (130_000.0, 95_000.0), (9.8e9, 1e10), (9.79e9, 1e10), (nan, 1.0), (1.0, nan), (1.0, inf), (1e25, 1.0), (1e25, None)]
    df = spark.createDataFrame(data, "preco double, abertura double")
    assert {tuple(r)[:2] for r in price_drop_alerts(df).collect()} == {data[0], data[3]}
    assert unrepresentable(df).count() == 5


def test_both_ends_in_one_pass(spark):
    nan = float("nan")
    values = [None, nan, float("inf"), -float("inf"), *map(float, range(40))]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, parte2 int").repartition(7)
    got = both_ends(df, "v", 3)
    first = df.orderBy(F.asc("v")).limit(3).collect()
    last = df.orderBy(F.desc("v")).limit(3).collect()
    assert sorted(r.parte2 for r in got.where("parte = 'primeiros'").collect()) == sorted(r.parte2 for r in first)
    assert sorted(r.parte2 for r in got.where("parte = 'ultimos'").collect()) == sorted(r.parte2 for r in last)
    assert both_ends(df.limit(2), "v", 5).count() == 4 and both_ends(df.limit(0), "v", 5).count() == 0
    texts = spark.createDataFrame([("é",), ("z",), ("a",), (None,)], "s string")
    assert {(r.parte, r.s) for r in both_ends(texts, "s", 1).collect()} == {("primeiros", None), ("ultimos", "é")}
