"""JDBC connection options and table read-back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# URL prefix and driver class per database.
_DATABASES = {
    "mysql": ("jdbc:mysql", "com.mysql.cj.jdbc.Driver"),
    "postgresql": ("jdbc:postgresql", "org.postgresql.Driver"),
}


def jdbc_options(
    kind: str, host: str, port: int, database: str, user: str, password: str, **url_args
) -> dict[str, str]:
    prefix, driver = _DATABASES[kind]
    query = "&".join(f"{k}={v}" for k, v in url_args.items())
    url = f"{prefix}://{host}:{port}/{database}" + (f"?{query}" if query else "")
    return {"url": url, "user": user, "password": password, "driver": driver}


def read_jdbc(
    spark: SparkSession,
    options: dict[str, str],
    table_or_query: str,
    partition_on: tuple[str, object, object] | None = None,
    num_partitions: int = 16,
) -> DataFrame:
    """Read a table, or a SELECT statement, back as a DataFrame.

    ``partition_on = (column, lower, upper)`` splits the read over ``num_partitions``
    connections; the bounds only shape the split, rows outside them are still read.
    """
    text = table_or_query.strip()
    source = f"({text}) src" if text.lower().startswith(("select", "with")) else text
    reader = spark.read.format("jdbc").options(**options).option("dbtable", source)
    if partition_on:
        column, lower, upper = partition_on
        reader = reader.options(
            partitionColumn=column, lowerBound=lower, upperBound=upper, numPartitions=num_partitions
        )
    return reader.load()
