"""Quote queries: events as quotes (event type = ticker, value = price, props.k = open and volume)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlab.catalogue import tables as t
from streamlab.config import JobSettings, work_dir
from streamlab.functions import round_decimal
from streamlab.operators.ordering import latest
from streamlab.operators.quotes import clean_quotes, ohlcv, price_drop_alerts, with_pct_change
from streamlab.operators.validation import conform, split_written
from streamlab.operators.windows import moving_average
from streamlab.plans import quotes as plan
from streamlab.plans.quotes import typed_quotes
from streamlab.schemas import QUOTE, QUOTE_TABLE
from streamlab.sinks import append_batch
from streamlab.sinks.paths import numbered
from streamlab.sources import read_json_stream, read_table_stream
from streamlab.streaming import run_stream, start_batches, start_table

QUERIES, ORACLES, query = t.registry()

_MONEY = ("preco", "abertura", "maxima", "minima")


def _prices(ev):
    return ev.select(
        F.col("event_type").alias("ticker"),
        F.col("value").alias("preco"),
        F.col("ts").cast("timestamp").alias("coletado_em"),
    )


@query(
    f"""SELECT ticker, preco, coalesce(abertura, 0) AS abertura, coalesce(volume, 0) AS volume,
    CASE WHEN moeda = 'USD' THEN moeda END AS moeda, coletado_em FROM ({t.QUOTES_SQL})"""
)
def quote_json_stream(spark, sf_dir):
    """Events delivered as JSON lines, streamed in several micro-batches into a table."""
    base = work_dir(spark, "quote_stream")
    files = max(4, spark.sparkContext.defaultParallelism)
    raw = t.quotes(t.events(spark, sf_dir)).drop("event_id")
    raw.repartition(files).write.json(f"{base}/in")
    stream = typed_quotes(read_json_stream(spark, f"{base}/in", QUOTE, max_files=files // 2))
    out = f"{base}/cotacoes"
    run_stream(
        start_batches(stream, lambda batch, n: append_batch(batch, out, n), f"{base}/checkpoint")
    )
    rows = spark.read.parquet(out)
    return t.ntz(
        rows.select("ticker", "preco", "abertura", "volume", "moeda", "coletado_em"), "coletado_em"
    )


@query(
    f"""SELECT ticker, preco, abertura, maxima, minima, volume, moeda, bolsa, coletado_em
    FROM ({t.QUOTES_SQL})"""
)
def quote_clean(spark, sf_dir):
    return t.ntz(clean_quotes(t.quotes(t.events(spark, sf_dir))), "coletado_em")


@query(
    f"""SELECT ticker, preco, coletado_em, abertura IS NOT NULL AND volume IS NOT NULL AS valida,
    CASE WHEN abertura IS NULL THEN 'abertura ausente' ELSE '' END
    || CASE WHEN abertura IS NULL AND volume IS NULL THEN ', ' ELSE '' END
    || CASE WHEN volume IS NULL THEN 'volume ausente' ELSE '' END AS motivos
    FROM ({t.QUOTES_SQL})"""
)
def quote_required_split(spark, sf_dir):
    quotes = clean_quotes(t.quotes(t.events(spark, sf_dir)))
    required = ["ticker", "preco", "abertura", "volume"]
    valid, rejected = split_written(quotes, required, work_dir(spark, "quote_split"))
    kept = ("ticker", "preco", "coletado_em")
    both = valid.select(*kept, F.lit(True).alias("valida"), F.lit("").alias("motivos")).unionByName(
        rejected.select(*kept, F.lit(False).alias("valida"), F.array_join("motivos", ", ").alias("motivos"))
    )
    return t.ntz(both, "coletado_em")


@query(
    "SELECT ticker, "
    + ", ".join(f"CAST(CAST({c} AS DECIMAL(18,4)) AS VARCHAR) AS {c}" for c in _MONEY)
    + f", volume, moeda, bolsa, coletado_em FROM ({t.QUOTES_SQL})"
)
def quote_conform(spark, sf_dir):
    """Rows under the target table's contract; decimals shown as text."""
    rows = conform(clean_quotes(t.quotes(t.events(spark, sf_dir))), QUOTE_TABLE)
    return t.ntz(rows.withColumns({c: F.col(c).cast("string") for c in _MONEY}), "coletado_em")


@query(
    """SELECT event_type AS ticker, date_trunc('day', ts)::TIMESTAMP AS periodo,
    arg_min(value, (ts, event_id)) AS abertura, max(value) AS maxima, min(value) AS minima,
    arg_max(value, (ts, event_id)) AS fechamento, sum((props->>'$.k')::BIGINT)::BIGINT AS volume
    FROM events GROUP BY 1, 2"""
)
def quote_ohlcv(spark, sf_dir):
    bars = t.events(spark, sf_dir).select(
        F.col("event_type").alias("ticker"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("bar_id"),
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
    )
    rolled = ohlcv(bars, open_="value", high="value", low="value", close="value")
    return t.ntz(rolled, "periodo")


@query(
    """SELECT event_type AS ticker, time_bucket(INTERVAL '1 minute', ts) AS janela_inicio,
    time_bucket(INTERVAL '1 minute', ts) + INTERVAL '1 minute' AS janela_fim,
    round(CAST(avg(value) AS DECIMAL(38,10)), 4)::DOUBLE AS preco_medio, count(*)::BIGINT AS cotacoes
    FROM events GROUP BY 1, 2, 3"""
)
def quote_minute_avg(spark, sf_dir):
    means = moving_average(_prices(t.events(spark, sf_dir)))
    return t.ntz(means, "janela_inicio", "janela_fim").withColumn(
        "preco_medio", round_decimal("preco_medio", 4)
    )


@query(
    """SELECT event_type AS ticker, i AS janela_inicio, i + INTERVAL '1 minute' AS janela_fim,
    round(CAST(avg(value) AS DECIMAL(38,10)), 4)::DOUBLE AS preco_medio, count(*)::BIGINT AS cotacoes
    FROM (SELECT event_type, value,
                 time_bucket(INTERVAL '20 seconds', ts) - n * INTERVAL '20 seconds' AS i
          FROM events, range(3) r(n))
    GROUP BY 1, 2, 3"""
)
def quote_moving_avg(spark, sf_dir):
    """One-minute mean every 20 seconds."""
    means = moving_average(_prices(t.events(spark, sf_dir)), slide="20 seconds")
    return t.ntz(means, "janela_inicio", "janela_fim").withColumn(
        "preco_medio", round_decimal("preco_medio", 4)
    )


@query(
    """SELECT event_type AS ticker, i AS janela_inicio, i + INTERVAL '1 minute' AS janela_fim,
    round(CAST(avg(value) AS DECIMAL(38,10)), 4)::DOUBLE AS preco_medio, count(*)::BIGINT AS cotacoes
    FROM (SELECT event_type, value,
                 time_bucket(INTERVAL '20 seconds', ts) - n * INTERVAL '20 seconds' AS i
          FROM events, range(3) r(n))
    GROUP BY 1, 2, 3
    HAVING janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""",
    stateful=True,
)
def quote_moving_avg_stream(spark, sf_dir):
    """The moving mean on the stream: overlapping windows closed by the watermark."""
    base = work_dir(spark, "quote_moving")
    means = moving_average(_prices(t.events_stream(spark, sf_dir)), slide="20 seconds", delay="20 seconds")
    run_stream(start_table(means, f"{base}/data", f"{base}/checkpoint"))
    out = t.ntz(spark.read.parquet(f"{base}/data"), "janela_inicio", "janela_fim")
    return out.withColumn("preco_medio", round_decimal("preco_medio", 4))


_PCT = "round(CAST((preco - abertura) * 100.0::DOUBLE / abertura AS DECIMAL(38,10)), 4)::DOUBLE"


@query(f"SELECT event_id, ticker, preco, abertura, {_PCT} AS variacao_pct FROM ({t.QUOTES_SQL})")
def quote_pct_change(spark, sf_dir):
    raw = t.quotes(t.events(spark, sf_dir)).select(
        "event_id", "ticker", "preco", F.nullif("abertura", F.lit(0)).alias("abertura")
    )
    return with_pct_change(raw).withColumn("variacao_pct", round_decimal("variacao_pct", 4))


@query(
    f"""SELECT event_id, ticker, preco, abertura, {_PCT} AS variacao_pct FROM ({t.QUOTES_SQL})
    WHERE CAST(preco AS DECIMAL(18,6)) * 100 < CAST(abertura AS DECIMAL(18,6)) * 98"""
)
def quote_drop_alert(spark, sf_dir):
    raw = t.quotes(t.events(spark, sf_dir)).select("event_id", "ticker", "preco", "abertura")
    return price_drop_alerts(raw).withColumn("variacao_pct", round_decimal("variacao_pct", 4))


@query(
    f"""SELECT ticker, preco, abertura, {_PCT} AS variacao_pct, coletado_em FROM ({t.QUOTES_SQL})
    WHERE CAST(preco AS DECIMAL(18,6)) * 100 < CAST(abertura AS DECIMAL(18,6)) * 98"""
)
def quote_alert_stream(spark, sf_dir):
    """Alerts of the quote plan on delivered JSON files."""
    base = work_dir(spark, "quote_alerts")
    t.quotes(t.events(spark, sf_dir)).drop("event_id").write.json(f"{base}/in")
    settings = JobSettings(stream_dir=f"{base}/in", output_dir=f"{base}/out", trigger_seconds=0)
    run_stream(plan.start_alerts(spark, settings, lambda batch, n: append_batch(batch, f"{base}/alerts", n)))
    found = spark.read.parquet(f"{base}/alerts").select("ticker", "preco", "abertura", "variacao_pct", "coletado_em")
    return t.ntz(found.withColumn("variacao_pct", round_decimal("variacao_pct", 4)), "coletado_em")


@query(
    f"""SELECT event_id, ticker, preco, abertura, {_PCT} AS variacao_pct
    FROM (SELECT event_id, ticker, preco * 100000 AS preco, abertura * 100000 AS abertura FROM ({t.QUOTES_SQL}))
    WHERE CAST(preco AS DECIMAL(28,6)) * 100 < CAST(abertura AS DECIMAL(28,6)) * 98"""
)
def quote_drop_alert_large(spark, sf_dir):
    """The same alerts on prices far beyond the range of ordinary quotes."""
    raw = t.quotes(t.events(spark, sf_dir)).select(
        "event_id", "ticker", (F.col("preco") * 100000).alias("preco"), (F.col("abertura") * 100000).alias("abertura")
    )
    return price_drop_alerts(raw).withColumn("variacao_pct", round_decimal("variacao_pct", 4))


@query(
    """SELECT event_id, event_type AS ticker, value AS preco, ts AS coletado_em
    FROM events ORDER BY ts DESC, event_id LIMIT 10"""
)
def quote_latest10(spark, sf_dir):
    rows = t.events(spark, sf_dir).select(
        "event_id",
        F.col("event_type").alias("ticker"),
        F.col("value").alias("preco"),
        F.col("ts").alias("coletado_em"),
    )
    return latest(rows, tie="event_id")


@query("SELECT count(*)::BIGINT AS total FROM events")
def quote_row_count(spark, sf_dir):
    return t.events(spark, sf_dir).agg(F.count(F.lit(1)).alias("total"))


@query(
    """SELECT count(DISTINCT event_id % 4)::BIGINT AS pastas, count(*)::BIGINT AS linhas
    FROM events WHERE event_id % 4 IN (0, 2)"""
)
def quote_empty_batches(spark, sf_dir):
    """Four deliveries of which two hold nothing that is wanted: those batches leave no folder."""
    base = work_dir(spark, "quote_empty")
    part = (F.col("event_id") % 4).alias("entrega")
    t.events(spark, sf_dir).select("event_id", part).repartition("entrega").write.partitionBy("entrega").parquet(f"{base}/in")
    stream = read_table_stream(spark, f"{base}/in/entrega=*", "*", StructType().add("event_id", "long"), max_files=1)
    wanted = stream.where("event_id % 4 in (0, 2)")
    run_stream(start_batches(wanted, lambda batch, n: append_batch(batch, f"{base}/out", n), f"{base}/checkpoint"))
    rows = spark.read.schema("event_id long, lote long").parquet(f"{base}/out")
    folders = numbered(spark, f"{base}/out", "lote")
    return rows.agg(F.lit(len(folders)).cast("long").alias("pastas"), F.count("event_id").alias("linhas"))
