"""Keyed upsert into MongoDB through its Spark connector (not on this classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def mongo_options(uri: str, database: str, collection: str, key: str = "_id") -> dict[str, str]:
    return {
        "connection.uri": uri,
        "database": database,
        "collection": collection,
        "operationType": "update",
        "upsertDocument": "true",
        "idFieldList": key,
    }


def mongo_upsert(rows: DataFrame, uri: str, database: str, collection: str) -> None:
    """Set absolute values by ``_id`` from the executors; repeating a batch changes nothing."""
    options = mongo_options(uri, database, collection)
    rows.write.format("mongodb").options(**options).mode("append").save()
