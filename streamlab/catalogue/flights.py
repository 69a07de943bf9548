"""Flight queries: events as flights (event type = airline, user = passengers, value = delay)."""

from __future__ import annotations

from datetime import datetime, time, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.catalogue import tables as t
from streamlab.config import JobSettings, work_dir
from streamlab.functions import round_decimal
from streamlab.operators.windows import flight_windows
from streamlab.plans import flights as plan
from streamlab.sinks import append_batch
from streamlab.sinks.paths import volume
from streamlab.sources import read_table_stream
from streamlab.streaming import ProgressTable, progress_frame, run_stream, start_batches, start_table

QUERIES, ORACLES, query = t.registry()

_WINDOWS_SQL = """
  SELECT event_type AS companhia, time_bucket(INTERVAL '30 seconds', ts) AS janela_inicio,
         time_bucket(INTERVAL '30 seconds', ts) + INTERVAL '30 seconds' AS janela_fim,
         count(*)::BIGINT AS total_voos, sum(user_id)::BIGINT AS passageiros,
         avg(value) AS media
  FROM events GROUP BY 1, 2, 3"""
_COLUMNS = """companhia, janela_inicio, janela_fim, total_voos, passageiros,
  round(CAST(media AS DECIMAL(38,10)), {digits})::DOUBLE AS atraso_medio_min"""


def _output(df):
    df = t.ntz(df, "janela_inicio", "janela_fim")
    return df.withColumn("atraso_medio_min", round_decimal("atraso_medio_min", 4))


def _run(spark, stream, name):
    out = work_dir(spark, name)
    done = run_stream(start_table(flight_windows(stream), f"{out}/data", f"{out}/checkpoint"))
    return f"{out}/data", done


@query(
    f"""SELECT {_COLUMNS.format(digits=4)} FROM ({_WINDOWS_SQL})
    WHERE janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""", stateful=True)
def flight_windows_append(spark, sf_dir):
    """Watermarked stream: windows closed by the end of the data."""
    data, _ = _run(spark, t.flights(t.events_stream(spark, sf_dir)), "flight_windows")
    return _output(spark.read.parquet(data))


@query(
    f"""SELECT {_COLUMNS.format(digits=4)} FROM ({_WINDOWS_SQL})
    WHERE janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""",
    stateful=True,
)
def flight_plan_backlog(spark, sf_dir):
    """The flight plan itself on a backlog of JSON files in arbitrary order, drained slice by slice."""
    _, base = _drained(spark, sf_dir)
    return _output(spark.read.parquet(f"{base}/windows").drop("lote"))


def _drained(spark, sf_dir):
    """(queries, folder) of a backlog of 24 files, each from all over the time, in slices of a fifth of them."""
    base = work_dir(spark, "flight_backlog")
    time = F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time")
    rows = t.flights(t.events(spark, sf_dir)).select("companhia", "passageiros", "atraso_min", time)
    rows.repartition(24, F.xxhash64("event_time", "passageiros")).write.json(f"{base}/in")
    fifth = -(-volume(spark, f"{base}/in") // 5)
    settings = JobSettings(stream_dir=f"{base}/in", output_dir=f"{base}/out", trigger_seconds=0, max_bytes=str(fifth))
    return plan.drain(spark, settings, handler=lambda batch, n: append_batch(batch, f"{base}/windows", n)), base


@query("SELECT 5::BIGINT AS fatias, count(*)::BIGINT AS linhas_entrada, 0::BIGINT AS grupos_atrasados FROM events", stateful=True)
def flight_backlog_order(spark, sf_dir):
    """Micro-batches with rows, rows read and rows found late while a backlog is drained in order."""
    done, _ = _drained(spark, sf_dir)
    reports = reduce(DataFrame.unionAll, (progress_frame(spark, q) for q in done))
    return reports.agg(
        F.count_if(F.col("linhas_entrada") > 0).alias("fatias"),
        F.sum("linhas_entrada").alias("linhas_entrada"),
        F.sum("grupos_atrasados").alias("grupos_atrasados"),
    )


_ARRIVALS_SQL = """
  WITH e AS (SELECT *, event_id % 3 AS entrega, time_bucket(INTERVAL '30 seconds', ts) + INTERVAL '30 seconds' AS fim FROM events),
  w AS (SELECT entrega, max(ts) AS m FROM e GROUP BY 1),
  l AS (SELECT a.entrega, max(b.m) - INTERVAL '20 seconds' AS limite FROM w a LEFT JOIN w b ON b.entrega < a.entrega GROUP BY 1),
  arrivals AS (SELECT e.*, limite, coalesce(fim <= limite, false) AS late FROM e JOIN l USING (entrega))"""


def _deliveries(spark, sf_dir, name):
    """Three deliveries, each from all over the time, through the plan that keeps late rows."""
    base = work_dir(spark, name)
    part = (F.col("event_id") % 3).alias("entrega")
    t.events(spark, sf_dir).select("*", part).write.partitionBy("entrega").parquet(f"{base}/in")
    settings = JobSettings(output_dir=f"{base}/out", trigger_seconds=0)
    for n in range(3):
        ev = read_table_stream(spark, f"{base}/in/entrega=[0-{n}]", "*", t.EVENTS)
        arrivals = t.flights(ev, "event_id")
        query, split = plan.keep_late(spark, settings, lambda batch, k: append_batch(batch, f"{base}/windows", k), arrivals)
        run_stream(query)
    return split, arrivals.schema, base


@query(f"{_ARRIVALS_SQL} SELECT event_id, ts AS event_time, entrega AS lote, limite FROM arrivals WHERE late", stateful=True)
def flight_late_rows(spark, sf_dir):
    """The input rows that came too late for their window, with the watermark they met."""
    split, schema, _ = _deliveries(spark, sf_dir, "flight_late_rows")
    return t.ntz(split.rows(schema).select("event_id", "event_time", "lote", "limite"), "event_time", "limite")


@query(
    f"""{_ARRIVALS_SQL}, janelas AS (SELECT event_type AS companhia, fim - INTERVAL '30 seconds' AS janela_inicio, fim AS janela_fim,
      count(*)::BIGINT AS total_voos, sum(user_id)::BIGINT AS passageiros, avg(value) AS media FROM arrivals WHERE NOT late GROUP BY 1, 3)
    SELECT {_COLUMNS.format(digits=4)} FROM janelas
    WHERE janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""",
    stateful=True,
)
def flight_on_time_windows(spark, sf_dir):
    """Closed windows of the rows in time, beside the late ones."""
    _, _, base = _deliveries(spark, sf_dir, "flight_on_time")
    return _output(spark.read.parquet(f"{base}/windows").drop("lote"))


_MANY = 120  # more micro-batches than Spark itself remembers


@query(
    f"""SELECT count(DISTINCT event_id % {_MANY})::BIGINT AS lotes, count(*)::BIGINT AS linhas_entrada,
    count(*)::BIGINT AS linhas_saida FROM events"""
)
def flight_progress_long(spark, sf_dir):
    """A drain of many micro-batches, from the stored reports: one row for each of them."""
    base = work_dir(spark, "flight_progress_long")
    ev = t.events(spark, sf_dir).withColumn("parte", F.col("event_id") % _MANY)
    ev.repartition("parte").write.partitionBy("parte").parquet(f"{base}/in")
    stream = read_table_stream(spark, f"{base}/in/parte=*", "*", t.EVENTS, max_files=1)
    log = ProgressTable(spark, f"{base}/progresso")
    spark.streams.addListener(log)
    try:
        done = run_stream(start_batches(stream, lambda batch, n: batch.write.format("noop").mode("overwrite").save(), f"{base}/checkpoint"))
        log.wait(done)
    finally:
        spark.streams.removeListener(log)
    mine = log.frame().where(F.col("consulta") == str(done.id))
    return mine.agg(
        F.count("lote").alias("lotes"), F.sum("linhas_entrada").alias("linhas_entrada"), F.sum("linhas_saida").alias("linhas_saida")
    )


@query(
    """SELECT event_id, round(CAST(floor(value) + 0.2499999996::DOUBLE AS DECIMAL(38,10)), 1)::DOUBLE AS uma,
    round(CAST(floor(value) + 0.0499999996::DOUBLE AS DECIMAL(38,10)), 1)::DOUBLE AS outra FROM events"""
)
def flight_rounding(spark, sf_dir):
    """Values just below a tie are rounded once, down."""
    whole = F.floor("value").cast("double")
    return t.events(spark, sf_dir).select(
        "event_id",
        round_decimal(whole + 0.2499999996, 1).alias("uma"),
        round_decimal(whole + 0.0499999996, 1).alias("outra"),
    )


@query(f"SELECT {_COLUMNS.format(digits=4)} FROM ({_WINDOWS_SQL})")
def flight_windows_batch(spark, sf_dir):
    """The same operator on the bounded table: all windows."""
    return _output(flight_windows(t.flights(t.events(spark, sf_dir))))


@query(f"SELECT {_COLUMNS.format(digits=1)} FROM ({_WINDOWS_SQL}) ORDER BY janela_inicio, companhia")
def flight_report(spark, sf_dir):
    windows = flight_windows(t.flights(t.events(spark, sf_dir)))
    return t.ntz(plan.report(windows), "janela_inicio", "janela_fim")


@query(f"SELECT count(*)::BIGINT AS janelas, sum(total_voos)::BIGINT AS voos FROM ({_WINDOWS_SQL})")
def flight_window_count(spark, sf_dir):
    windows = flight_windows(t.flights(t.events(spark, sf_dir)))
    return windows.agg(F.count(F.lit(1)).alias("janelas"), F.sum("total_voos").alias("voos"))


_CUT_SQL = "(SELECT date_trunc('day', max(ts) - INTERVAL '10 days') FROM events)"


@query(
    f"""SELECT {_COLUMNS.format(digits=4)} FROM ({_WINDOWS_SQL})
    WHERE janela_inicio >= {_CUT_SQL}
      AND janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""", stateful=True)
def flight_late_data(spark, sf_dir):
    """Two deliveries: the newest ten days, then, with the watermark past them, the rest.

    Every row of the second delivery is late beyond the delay and changes nothing.
    """
    ev = t.events(spark, sf_dir)
    newest = ev.agg(F.max("ts").alias("m")).first()["m"]
    cut = datetime.combine((newest - timedelta(days=10)).date(), time.min)
    arrived, out = work_dir(spark, "flight_arrivals"), work_dir(spark, "flight_late")
    for n, part in enumerate((F.col("ts") >= F.lit(cut), F.col("ts") < F.lit(cut))):
        ev.where(part).write.parquet(f"{arrived}/{n}.parquet")
        stream = read_table_stream(spark, arrived, f"[0-{n}]", t.EVENTS)
        windows = flight_windows(t.flights(stream))
        run_stream(start_table(windows, f"{out}/data", f"{out}/checkpoint"))
    return _output(spark.read.parquet(f"{out}/data"))


@query(
    f"""SELECT (SELECT count(*) FROM events)::BIGINT AS linhas_entrada, count(*)::BIGINT AS linhas_saida,
    0::BIGINT AS grupos_atrasados FROM ({_WINDOWS_SQL})
    WHERE janela_fim <= (SELECT date_trunc('milliseconds', max(ts)) FROM events) - INTERVAL '20 seconds'""", stateful=True)
def flight_progress(spark, sf_dir):
    """Rows read, windows written and rows dropped as late, from the stream's progress reports."""
    _, done = _run(spark, t.flights(t.events_stream(spark, sf_dir)), "flight_progress")
    return progress_frame(spark, done).agg(
        F.sum("linhas_entrada").alias("linhas_entrada"),
        F.sum("linhas_saida").alias("linhas_saida"),
        F.sum("grupos_atrasados").alias("grupos_atrasados"),
    )
