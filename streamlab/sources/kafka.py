"""Kafka source options and payload decoding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "earliest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; ``min_partitions`` splits hot topic partitions over more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def read_kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", **pace
) -> DataFrame:
    """Subscribe to one topic; needs the Kafka connector package on the classpath."""
    options = kafka_options(servers, topic, starting, **pace)
    return spark.readStream.format("kafka").options(**options).load()


def decode_json(
    df: DataFrame, schema: StructType, value_col: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Binary JSON payload -> typed columns.

    A payload that is not JSON gives a row of NULLs and a value of the wrong type gives
    one NULL field; no row is dropped. ``keep`` carries envelope columns along.
    """
    parsed = F.from_json(F.col(value_col).cast("string"), schema).alias("v")
    return df.select(parsed, *keep).select("v.*", *keep)
