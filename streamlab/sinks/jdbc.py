"""JDBC append whose effect is exactly once per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.operators.validation import conform, split_written
from streamlab.schemas import required_columns

_ROW, _FILE, _BATCH = "_linha", "_arquivo", "lote_id"

# Column types per database.
_TYPES = {
    "mysql": {"string": "VARCHAR(255)", "double": "DOUBLE", "timestamp": "DATETIME(6)",
              "bigint": "BIGINT", "int": "INT"},
    "postgresql": {"string": "VARCHAR(255)", "double": "DOUBLE PRECISION", "timestamp": "TIMESTAMP",
                   "bigint": "BIGINT", "int": "INTEGER"},
}
_IDENTITY = {"mysql": "BIGINT AUTO_INCREMENT PRIMARY KEY", "postgresql": "BIGSERIAL PRIMARY KEY"}


def table_ddl(
    contract: T.StructType, table: str, dialect: str, index: tuple[str, ...] = ()
) -> list[str]:
    """Statements that create the target if it is missing.

    The table holds a generated id, the contract's columns, the batch number and the time
    of writing, with indexes on the batch number and on the ``index`` columns.
    """
    columns = [f"id {_IDENTITY[dialect]}"]
    for f in contract.fields:
        columns.append(f"{f.name} {_sql_type(f, dialect)}" + ("" if f.nullable else " NOT NULL"))
    columns += [f"{_BATCH} BIGINT NOT NULL", "processado_em TIMESTAMP DEFAULT CURRENT_TIMESTAMP"]
    indexes = {f"idx_{table}_lote": _BATCH}
    if index:
        indexes[f"idx_{table}"] = ", ".join(index)
    if dialect == "mysql":  # no CREATE INDEX IF NOT EXISTS there
        columns += [f"INDEX {name} ({cols})" for name, cols in indexes.items()]
        indexes = {}
    return [f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"] + [
        f"CREATE INDEX IF NOT EXISTS {name} ON {table} ({cols})" for name, cols in indexes.items()
    ]


def staging_ddl(contract: T.StructType, table: str, dialect: str) -> list[str]:
    """Statements that make an empty staging table with the target's column types."""
    columns = [f"{f.name} {_sql_type(f, dialect)}" for f in contract.fields]
    columns += [f"{_FILE} VARCHAR(255) NOT NULL", f"{_ROW} BIGINT NOT NULL"]
    return [f"DROP TABLE IF EXISTS {table}", f"CREATE TABLE {table} ({', '.join(columns)})"]


def _sql_type(field: T.StructField, dialect: str) -> str:
    kind = field.dataType.simpleString()
    return kind.upper() if kind.startswith("decimal") else _TYPES[dialect][kind]


class JdbcAppender:
    """``foreachBatch`` handler: (batch, batch id) -> rows of ``table``.

    1. The batch is written once to Parquet under ``staging_dir`` -- the only pass over
       the stream's plan. Rows that break the contract lie beside the others (``valida=false``)
       with their reasons.
    2. Executors insert the written rows into a staging table, each tagged with its file
       and row number, so a task that runs twice yields recognisable copies. The staging
       table is made from the contract, with the target's own column types.
    3. One database transaction deletes the batch number from the target and inserts one
       staged row per file and row number.
    """

    def __init__(
        self,
        options: dict[str, str],
        table: str,
        contract: T.StructType,
        staging_dir: str,
        connections: int = 16,
    ):
        self.options, self.table, self.contract = options, table, contract
        self.staging_dir, self.connections = staging_dir.rstrip("/"), connections
        self.staging_table = f"{table}_stage"
        self.dialect: str | None = None  # known once the target is created

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        staged = self.stage(batch, batch_id)
        if staged.isEmpty():
            return
        if self.dialect:
            self.execute(batch.sparkSession, staging_ddl(self.contract, self.staging_table, self.dialect))
        self.insert(staged)
        self.execute(batch.sparkSession, self.publish_statements(batch_id))

    def create_target(self, spark: SparkSession, dialect: str, index: tuple[str, ...] = ()) -> None:
        self.dialect = dialect
        self.execute(spark, table_ddl(self.contract, self.table, dialect, index))

    def stage(self, batch: DataFrame, batch_id: int) -> DataFrame:
        folder = f"{self.staging_dir}/lote={batch_id}"
        valid, _ = split_written(conform(batch, self.contract), required_columns(self.contract), folder)
        # file and row number travel with the rows
        return valid.select(*self.contract.names, F.col("_metadata.file_name").alias(_FILE), F.col("_metadata.row_index").alias(_ROW))

    def insert(self, staged: DataFrame) -> None:
        (
            staged.coalesce(self.connections)
            .write.format("jdbc")
            .options(**self.options)
            .option("dbtable", self.staging_table)
            .option("truncate", self.dialect is not None)  # keep the created column types
            .mode("overwrite")
            .save()
        )

    def publish_statements(self, batch_id: int) -> list[str]:
        names = ", ".join(self.contract.names)
        copy = f"ROW_NUMBER() OVER (PARTITION BY {_FILE}, {_ROW} ORDER BY {_ROW}) AS _copia"
        distinct = f"SELECT {names}, {copy} FROM {self.staging_table}"
        return [
            f"DELETE FROM {self.table} WHERE {_BATCH} = {int(batch_id)}",
            f"INSERT INTO {self.table} ({names}, {_BATCH}) "
            f"SELECT {names}, {int(batch_id)} FROM ({distinct}) s WHERE _copia = 1",
        ]

    def execute(self, spark: SparkSession, statements: list[str]) -> None:
        """Run statements in one transaction on a connection of the driver process."""
        jvm = spark._jvm
        # Spark's own registration also finds drivers that came with --jars or --packages
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(
            self.options["driver"]
        )
        connection = jvm.java.sql.DriverManager.getConnection(
            self.options["url"], self.options.get("user"), self.options.get("password")
        )
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            for sql in statements:
                statement.executeUpdate(sql)
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()
