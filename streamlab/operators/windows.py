"""Event-time windows: tumbling statistics per key and moving averages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def windowed(
    df: DataFrame,
    time: str,
    size: str,
    keys: list[str],
    aggs: list[Column],
    slide: str | None = None,
    delay: str | None = None,
    start: str = "janela_inicio",
    end: str = "janela_fim",
) -> DataFrame:
    """Aggregate per event-time window and key, with the window flattened to two columns.

    ``delay`` sets the watermark of a stream; a bounded DataFrame ignores it. Spark
    combines on the map side first, so a key holding most rows shuffles one partial row
    per window and task.
    """
    if delay:
        df = df.withWatermark(time, delay)
    w = F.window(F.col(time), size, slide) if slide else F.window(F.col(time), size)
    grouped = df.groupBy(w.alias("w"), *keys).agg(*aggs)
    kept = [c for c in grouped.columns if c != "w" and c not in keys]
    return grouped.select(
        *keys, F.col("w.start").alias(start), F.col("w.end").alias(end), *kept
    )


def flight_windows(
    df: DataFrame, time: str = "event_time", size: str = "30 seconds", delay: str | None = "20 seconds"
) -> DataFrame:
    """Flights, passengers and mean delay per airline and window."""
    return windowed(
        df,
        time,
        size,
        ["companhia"],
        [
            F.count(F.lit(1)).alias("total_voos"),
            F.sum("passageiros").alias("passageiros"),
            F.avg("atraso_min").alias("atraso_medio_min"),
        ],
        delay=delay,
    )


def moving_average(
    df: DataFrame,
    size: str = "1 minute",
    slide: str | None = None,
    time: str = "coletado_em",
    key: str = "ticker",
    price: str = "preco",
    delay: str | None = None,
) -> DataFrame:
    """Mean price per ticker and window; a ``slide`` below ``size`` gives overlapping windows."""
    aggs = [F.avg(price).alias("preco_medio"), F.count(F.lit(1)).alias("cotacoes")]
    return windowed(df, time, size, [key], aggs, slide=slide, delay=delay)
