"""File sources: watched JSON folders, headerless CSV and Parquet tables read as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _nullable(schema: StructType) -> StructType:
    # File sources do not enforce NOT NULL; say so in the schema instead of pretending.
    relaxed = StructType()
    for f in schema.fields:
        relaxed = relaxed.add(f.name, f.dataType, True)
    return relaxed


def read_json_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Watch a folder of JSON files (one object per line, or one object per file).

    ``max_files`` paces the stream by file count, ``max_bytes`` by volume; the second is
    the better brake when file sizes vary.
    """
    reader = spark.readStream.schema(_nullable(schema))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.json(path)


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The same records as a bounded DataFrame."""
    return spark.read.schema(_nullable(schema)).json(path)


def read_csv_named(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Headerless CSV whose column names and types come from ``schema`` (no inference pass)."""
    return spark.read.schema(_nullable(schema)).csv(path, header=False)


def read_table_stream(
    spark: SparkSession, folder: str, table: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Stream ``<folder>/<table>.parquet``, be it one file or a directory of part files.

    The path is a glob on purpose: the streaming file source only takes a single file
    when the path is a pattern.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{folder}/{table}.parque[t]")
