"""Quote cleaning, bar roll-up and price-drop alerts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlab.functions import default_if_absent, parse_event_time, pct_change, zero_to_null

_PRICE = "decimal(28,6)"


def clean_quotes(df: DataFrame, currency: str = "BRL", exchange: str = "B3") -> DataFrame:
    """Zero -> NULL for optional measures, default currency, constant exchange, typed time."""
    df = parse_event_time(df, "coletado_em")
    return df.select(
        "ticker",
        "preco",
        zero_to_null("abertura").alias("abertura"),
        zero_to_null("maxima").alias("maxima"),
        zero_to_null("minima").alias("minima"),
        zero_to_null("volume").try_cast("bigint").alias("volume"),
        default_if_absent("moeda", currency).alias("moeda"),
        F.lit(exchange).alias("bolsa"),
        "coletado_em",
    )


def ohlcv(
    bars: DataFrame,
    key: str = "ticker",
    time: str = "ts",
    tie: str | None = "bar_id",
    period: str = "day",
    open_: str = "open",
    high: str = "high",
    low: str = "low",
    close: str = "close",
    volume: str = "volume",
) -> DataFrame:
    """First open, highest high, lowest low, last close and total volume per key and period.

    ``tie`` orders bars of equal time (an integer of at most 64 bits), so the result does
    not depend on row order. Time and tie are packed into one DECIMAL(38,0): a fixed-width
    buffer keeps this a hash aggregation, while a struct ordering would sort every row.
    Where no two bars of a key share a time, ``tie=None`` orders by time alone, which runs
    about twice as fast.
    """
    order = F.unix_micros(F.col(time).cast("timestamp"))
    if tie:
        span = F.lit("18446744073709551616").cast("decimal(20,0)")  # 2^64: room for any tie
        order = order.cast("decimal(38,0)") * span + F.col(tie).cast("decimal(20,0)")
        order = order.cast("decimal(38,0)")
    rows = bars.select(
        key,
        F.date_trunc(period, F.col(time)).alias("periodo"),
        order.alias("_order"),
        *[F.col(c).alias(n) for c, n in ((open_, "_o"), (high, "_h"), (low, "_l"), (close, "_c"), (volume, "_v"))],
    )
    return rows.groupBy(key, "periodo").agg(
        F.min_by("_o", "_order").alias("abertura"),
        F.max("_h").alias("maxima"),
        F.min("_l").alias("minima"),
        F.max_by("_c", "_order").alias("fechamento"),
        F.sum("_v").alias("volume"),
    )


def with_pct_change(df: DataFrame) -> DataFrame:
    return df.withColumn("variacao_pct", pct_change("preco", "abertura"))


def price_drop_alerts(df: DataFrame, threshold: float = 2.0) -> DataFrame:
    """Quotes that fell by more than ``threshold`` percent against the opening price.

    Prices are compared as decimals and multiplied out, so a fall of exactly the threshold is
    not turned into an alert by division noise. Lifting the price to at least 0 makes the
    comparison imply an opening price above 0. A price that is no decimal of this size gives
    no alert; ``unrepresentable`` lists such rows.
    """
    kept = F.lit(Decimal(str(round(100 - threshold, 6)))).cast("decimal(9,6)")
    price, opening = (F.col(c).try_cast(_PRICE) for c in ("preco", "abertura"))
    whole = F.lit(100).cast("decimal(3,0)")
    fell = F.when(price > 0, price).otherwise(F.lit(0).cast(_PRICE)) * whole < opening * kept
    fell = price.isNotNull() & fell
    return with_pct_change(df.where(fell))


def unrepresentable(df: DataFrame) -> DataFrame:
    """Quotes whose price or opening price is a number that ``price_drop_alerts`` can't compare."""
    odd = [F.col(c).isNotNull() & F.col(c).try_cast(_PRICE).isNull() for c in ("preco", "abertura")]
    return df.where(odd[0] | odd[1])
