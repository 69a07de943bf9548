"""Keyed JSON messages for Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode_kafka(df: DataFrame, key_col: str) -> DataFrame:
    """(key, value): equal keys share a topic partition, the value is the row as JSON."""
    return df.select(
        F.col(key_col).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
    )


def write_kafka(df: DataFrame, servers: str, topic: str, key_col: str) -> None:
    """Publish a bounded DataFrame and wait for all replicas; needs the Kafka connector."""
    (
        encode_kafka(df, key_col)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("topic", topic)
        .save()
    )
