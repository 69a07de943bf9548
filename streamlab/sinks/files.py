"""Append-only result tables, one folder per micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from streamlab.sinks.paths import observed, remove

# Line breaks within texts are written as \\n and \\r (and a backslash as two), so that a record is
# a line and large files can be split.
_CSV_FORMAT = {
    "header": True,
    "escape": '"',
    "nullValue": "\\N",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to a Parquet table; a replayed batch replaces itself, an empty one leaves no folder."""
    _written(df, f"{path}/lote={batch_id}", lambda out: out.write.mode("overwrite").parquet)


def append_csv(df: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch to a CSV table (a header per file); as ``append_batch`` otherwise."""
    out = df.withColumns({c: _one_line(c) for c in _texts(df.schema)})
    _written(out, f"{path}/lote={batch_id}", lambda o: o.write.mode("overwrite").options(**_CSV_FORMAT, quoteAll=True).csv)


def _written(df: DataFrame, folder: str, writer: Callable) -> None:
    """Write and count in one action, so that the batch's plan runs once."""
    seen = Observation()
    writer(df.observe(seen, F.count(F.lit(1)).alias("linhas")))(folder)
    if not observed(seen).get("linhas"):
        remove(df.sparkSession, folder)


def read_csv_results(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The accumulated CSV table, with the batch number as column ``lote``."""
    whole = StructType(list(schema.fields)).add("lote", "long")
    df = spark.read.schema(whole).options(**_CSV_FORMAT).csv(path)
    return df.withColumns({c: _lines(c) for c in _texts(schema)})


def _texts(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if isinstance(f.dataType, StringType)]


def _one_line(col: str) -> Column:
    text = F.replace(F.col(col), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def _lines(col: str) -> Column:
    def part(p: Column) -> Column:
        return F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    parts = F.transform(F.split(F.col(col), r"\\\\", -1), part)  # cut at doubled backslashes
    return F.array_join(parts, "\\")
