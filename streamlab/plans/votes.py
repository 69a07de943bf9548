"""Votes: Kafka messages -> running count per state and candidate -> keyed tally -> winners."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from streamlab.config import JobSettings, build_session
from streamlab.operators.tally import (
    champion, leader, national_total, running_count, states_won, tally_documents, winners_by_state,
)
from streamlab.schemas import TALLY_TABLE, VOTE
from streamlab.sinks import KeyedTable, mongo_upsert
from streamlab.sources import decode_json, read_kafka_stream
from streamlab.streaming import run_stream, start_batches


def tally_table(spark: SparkSession, path: str, **options) -> KeyedTable:
    # state and candidate follow from _id; as keys they leave only fixed-width values, so
    # merging versions is a hash aggregation
    return KeyedTable(spark, path, ["_id", "estado", "candidato"], TALLY_TABLE, **options)


def stamped(counts: DataFrame) -> DataFrame:
    """Changed counts as tally rows with the time of writing."""
    return tally_documents(counts).withColumn("atualizado_em", F.current_timestamp())


def start_counts(
    votes: DataFrame, table: KeyedTable, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Update mode: every batch carries the absolute totals of the groups it touched."""
    counts = running_count(votes, ["estado", "candidato"])
    return start_batches(
        counts, lambda batch, n: table.upsert(stamped(batch), n), checkpoint, "update", seconds
    )


def start(spark: SparkSession, settings: JobSettings, to_mongo: bool = False) -> StreamingQuery:
    messages = read_kafka_stream(spark, settings.kafka_bootstrap, settings.kafka_topic)
    votes = decode_json(messages, VOTE)
    checkpoint = settings.checkpoint_dir or f"{settings.output_dir}/checkpoint"
    seconds = settings.trigger_seconds or None
    if not to_mongo:
        table = tally_table(spark, f"{settings.output_dir}/apuracao")
        return start_counts(votes, table, checkpoint, seconds)
    target = (settings.mongo_uri, settings.mongo_db, settings.mongo_coll)
    return start_batches(
        running_count(votes, ["estado", "candidato"]),
        lambda batch, n: mongo_upsert(stamped(batch), *target),
        checkpoint,
        "update",
        seconds,
    )


def partial_result(table: KeyedTable) -> DataFrame:
    """National count so far and its leader."""
    return leader(national_total(table.read_current()))


def final_result(table: KeyedTable) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(votes and winner per state, states won, popular vote and champion)."""
    board = winners_by_state(table.read_current())
    return board.orderBy("estado"), states_won(board), champion(board)


def main() -> None:
    settings = JobSettings.from_env(trigger_seconds=8)
    run_stream(start(build_session("votos", settings), settings))


if __name__ == "__main__":
    main()
