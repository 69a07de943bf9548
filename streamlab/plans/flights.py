"""Flights: watched JSON folder -> watermarked windows per airline -> relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlab.config import JobSettings, build_session
from streamlab.functions import parse_event_time, round_decimal
from streamlab.operators.windows import flight_windows
from streamlab.schemas import FLIGHT, FLIGHT_WINDOW_TABLE
from streamlab.sinks import JdbcAppender
from streamlab.sinks.paths import volume
from streamlab.sources import read_json, read_json_stream
from streamlab.streaming import LateSplit, drain_in_order, run_stream, start_batches, to_bytes

DELAY, SIZE = "20 seconds", "30 seconds"


def _sink(spark: SparkSession, settings: JobSettings):
    options = {
        "url": settings.jdbc_url,
        "user": settings.jdbc_user,
        "password": settings.jdbc_password,
        "driver": "org.postgresql.Driver",
    }
    handler = JdbcAppender(options, "evolucao_voos", FLIGHT_WINDOW_TABLE, f"{settings.output_dir}/evolucao_voos")
    handler.create_target(spark, "postgresql", ("companhia", "janela_inicio"))
    return handler


def _checkpoint(settings: JobSettings, name: str = "") -> str:
    return (settings.checkpoint_dir or f"{settings.output_dir}/checkpoint") + name


def start(spark: SparkSession, settings: JobSettings, handler=None) -> StreamingQuery:
    """Append mode: a window is written once, after the watermark has passed its end."""
    handler = handler or _sink(spark, settings)
    stream = read_json_stream(spark, settings.stream_dir, FLIGHT, *settings.pace())
    windows = flight_windows(parse_event_time(stream, "event_time"), size=SIZE, delay=DELAY)
    return start_batches(windows, handler, _checkpoint(settings), seconds=settings.trigger_seconds or None)


def keep_late(
    spark: SparkSession, settings: JobSettings, handler=None, arrivals: DataFrame | None = None
) -> tuple[StreamingQuery, LateSplit]:
    """The same windows from the rows in time; rows that are late are kept as they came.

    After each batch of arrivals the windows query drains what is new, so a trigger must leave it
    some seconds. ``arrivals`` replaces the watched folder by another stream of flights.
    """
    handler = handler or _sink(spark, settings)
    if arrivals is None:
        arrivals = parse_event_time(read_json_stream(spark, settings.stream_dir, FLIGHT, *settings.pace()), "event_time")

    def aggregate() -> None:
        windows = flight_windows(split.on_time(arrivals.schema), size=SIZE, delay=DELAY)
        run_stream(start_batches(windows, handler, _checkpoint(settings, "_janelas")))

    split = LateSplit(spark, f"{settings.output_dir}/chegadas", "event_time", DELAY, SIZE, aggregate)
    query = start_batches(arrivals, split, _checkpoint(settings, "_chegadas"), seconds=settings.trigger_seconds or None)
    return query, split


def drain(spark: SparkSession, settings: JobSettings, handler=None) -> list[StreamingQuery]:
    """A backlog in the order of its events, about ``max_bytes`` of files at a time; no row is late."""
    handler = handler or _sink(spark, settings)
    backlog = parse_event_time(read_json(spark, settings.stream_dir, FLIGHT), "event_time")
    slices = max(1, -(-volume(spark, settings.stream_dir) // to_bytes(settings.max_bytes)))

    def windows(stream: DataFrame) -> StreamingQuery:
        return start_batches(flight_windows(stream, size=SIZE, delay=DELAY), handler, _checkpoint(settings))

    return drain_in_order(backlog, "event_time", f"{settings.output_dir}/fatias", slices, windows)


def report(windows: DataFrame) -> DataFrame:
    """All windows in time order, the mean delay rounded to one digit."""
    return windows.select(
        "companhia",
        "janela_inicio",
        "janela_fim",
        "total_voos",
        "passageiros",
        round_decimal("atraso_medio_min", 1).alias("atraso_medio_min"),
    ).orderBy(F.asc("janela_inicio"), F.asc("companhia"))


def main() -> None:
    settings = JobSettings.from_env()
    spark = build_session("voos", settings)
    if settings.max_bytes and not settings.trigger_seconds:
        drain(spark, settings)
    else:
        run_stream(start(spark, settings))


if __name__ == "__main__":
    main()
