"""Stock quotes: watched JSON folder -> typed rows -> relational table -> report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamlab.config import JobSettings, build_session
from streamlab.functions import parse_event_time
from streamlab.operators.ordering import latest
from streamlab.operators.quotes import price_drop_alerts
from streamlab.schemas import QUOTE, QUOTE_TABLE
from streamlab.sinks import JdbcAppender
from streamlab.sources import decode_json, read_json_stream, read_kafka_stream
from streamlab.streaming import run_stream, start_batches

def typed_quotes(df: DataFrame) -> DataFrame:
    """Records as received, with a real time stamp, in the table's column order."""
    return parse_event_time(df, "coletado_em").select(*QUOTE_TABLE.names)


def arrivals(spark: SparkSession, settings: JobSettings, from_kafka: bool = False) -> DataFrame:
    """Quotes as a stream, from the watched folder or from the topic."""
    if from_kafka:
        return decode_json(read_kafka_stream(spark, settings.kafka_bootstrap, settings.kafka_topic), QUOTE)
    return read_json_stream(spark, settings.stream_dir, QUOTE, *settings.pace())


def start_alerts(
    spark: SparkSession, settings: JobSettings, handler, threshold: float = 2.0, from_kafka: bool = False
) -> StreamingQuery:
    """Price drops of the same arrivals, as a query of its own with its own checkpoint."""
    alerts = price_drop_alerts(parse_event_time(arrivals(spark, settings, from_kafka), "coletado_em"), threshold)
    checkpoint = f"{settings.checkpoint_dir or settings.output_dir}/checkpoint_alertas"
    return start_batches(alerts, handler, checkpoint, seconds=settings.trigger_seconds or None)


def start(
    spark: SparkSession, settings: JobSettings, handler=None, from_kafka: bool = False
) -> StreamingQuery:
    """``handler`` replaces the JDBC sink, for example with a Parquet table."""
    if handler is None:
        options = {
            "url": settings.jdbc_url,
            "user": settings.jdbc_user,
            "password": settings.jdbc_password,
            "driver": "com.mysql.cj.jdbc.Driver",
        }
        handler = JdbcAppender(options, "cotacoes", QUOTE_TABLE, f"{settings.output_dir}/cotacoes")
        handler.create_target(spark, "mysql", ("ticker", "coletado_em"))
    stream = arrivals(spark, settings, from_kafka)
    checkpoint = settings.checkpoint_dir or f"{settings.output_dir}/checkpoint"
    return start_batches(
        typed_quotes(stream), handler, checkpoint, seconds=settings.trigger_seconds or None
    )


def report(table: DataFrame) -> DataFrame:
    """The ten newest quotes."""
    return latest(table.select("ticker", "preco", "coletado_em"))


def main() -> None:
    settings = JobSettings.from_env()
    run_stream(start(build_session("cotacoes", settings), settings))


if __name__ == "__main__":
    main()
