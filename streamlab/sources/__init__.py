from streamlab.sources.files import read_csv_named, read_json, read_json_stream, read_table_stream
from streamlab.sources.jdbc import jdbc_options, read_jdbc
from streamlab.sources.kafka import decode_json, kafka_options, read_kafka_stream

__all__ = [
    "decode_json",
    "jdbc_options",
    "kafka_options",
    "read_csv_named",
    "read_jdbc",
    "read_json",
    "read_json_stream",
    "read_kafka_stream",
    "read_table_stream",
]
