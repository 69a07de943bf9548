from streamlab.sinks.files import append_batch, append_csv, read_csv_results
from streamlab.sinks.jdbc import JdbcAppender, table_ddl
from streamlab.sinks.kafka import encode_kafka, write_kafka
from streamlab.sinks.keyed_table import KeyedTable
from streamlab.sinks.model_store import ModelStore
from streamlab.sinks.mongo import mongo_upsert

__all__ = [
    "JdbcAppender",
    "KeyedTable",
    "ModelStore",
    "append_batch",
    "append_csv",
    "encode_kafka",
    "mongo_upsert",
    "read_csv_results",
    "table_ddl",
    "write_kafka",
]
