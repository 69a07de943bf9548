"""Required fields and sink contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from streamlab.schemas import required_columns


def split_valid(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required field, rows without one plus their ``motivos``).

    Both sides are narrow filters over the same input; together they hold every row once.
    """
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return df.where(~missing), df.where(missing).withColumn("motivos", _reasons(required))


def _reasons(required: Sequence[str]) -> Column:
    return F.array_compact(
        F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} ausente")) for c in required]).cast("array<string>")
    )


def split_written(df: DataFrame, required: Sequence[str], path: str) -> tuple[DataFrame, DataFrame]:
    """``split_valid`` with one pass over the input: both sides are written at once, by partition.

    Valid rows lie under ``path/valida=true``, the others with their ``motivos`` under
    ``path/valida=false``; either side is read back without looking at the other. Writing the same
    path again replaces both.
    """
    marked = df.withColumn("motivos", _reasons(required)).withColumn("valida", F.size("motivos") == 0)
    marked.write.mode("overwrite").partitionBy("valida").parquet(path)
    stored = StructType([*df.schema.fields, StructField("motivos", ArrayType(StringType())), StructField("valida", BooleanType())])
    rows = df.sparkSession.read.schema(stored).parquet(path)
    return rows.where("valida").drop("motivos", "valida"), rows.where("not valida").drop("valida")


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Names, order and types of the target table; a value that does not fit becomes NULL."""
    return df.select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in contract.fields]
    )


def conform_valid(df: DataFrame, contract: StructType) -> tuple[DataFrame, DataFrame]:
    """``conform`` followed by the contract's NOT NULL rules."""
    return split_valid(conform(df, contract), required_columns(contract))
