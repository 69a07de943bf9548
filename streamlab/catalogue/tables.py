"""Driver tables under the record schemas of the flows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlab.config import isolated_session
from streamlab.functions import count_words
from streamlab.sources import read_table_stream

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
_SCHEMAS = {"events": EVENTS, "documents": DOCUMENTS}
# the two listed candidates; the other event types play unknown ones
CANDIDATES = ("click", "view")
SPLIT_KEY = "doc_id"
BALLOT_BOXES = 500_000  # fixed value: ids run from 1 to it


def registry():
    """(queries, oracles, decorator that files a query and its SQL under the query's name).

    A ``stateful`` query gets as many state partitions as the cluster has cores.
    """
    queries, oracles = {}, {}

    def query(sql: str | None = None, stateful: bool = False):
        def add(fn):
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                width = max(8, spark.sparkContext.defaultParallelism) if stateful else None
                return fn(isolated_session(spark, width), sf_dir)

            queries[fn.__name__] = run
            if sql is not None:
                oracles[fn.__name__] = sql
            return fn

        return add

    return queries, oracles, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; a declared schema saves the job that would infer it."""
    reader = spark.read.schema(_SCHEMAS[name]) if name in _SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table as one bounded micro-batch, so that no row counts as late."""
    return read_table_stream(spark, sf_dir, "events", EVENTS)


def flights(ev: DataFrame, *more: str) -> DataFrame:
    # the streaming watermark only takes TIMESTAMP, the table holds TIMESTAMP_NTZ
    return ev.select(
        *more,
        F.col("event_type").alias("companhia"),
        F.col("user_id").alias("passageiros"),
        F.col("value").alias("atraso_min"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def votes(ev: DataFrame) -> DataFrame:
    return ev.select(
        (F.pmod(F.col("event_id") - 1, F.lit(BALLOT_BOXES)) + 1).cast("int").alias("id_urna"),
        F.concat(F.lit("S"), (F.col("user_id") % 27).cast("string")).alias("estado"),
        F.col("event_type").alias("candidato"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
    )


VOTES_SQL = """
  SELECT 'S' || (user_id % 27) AS estado, event_type AS candidato, count(*)::BIGINT AS votos
  FROM events GROUP BY 1, 2"""


def quotes(ev: DataFrame) -> DataFrame:
    """Raw quotes: 0 stands for "no value" in the optional measures."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return ev.select(
        "event_id",
        F.col("event_type").alias("ticker"),
        F.col("value").alias("preco"),
        k.cast("double").alias("abertura"),
        F.greatest(F.col("value"), k.cast("double")).alias("maxima"),
        F.least(F.col("value"), k.cast("double")).alias("minima"),
        k.alias("volume"),
        F.when(F.col("event_type") == "purchase", F.lit("USD")).alias("moeda"),
        F.lit(None).cast("string").alias("bolsa"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("coletado_em"),
    )


QUOTES_SQL = """
  SELECT event_id, event_type AS ticker, value AS preco,
         nullif((props->>'$.k')::DOUBLE, 0) AS abertura,
         nullif(greatest(value, (props->>'$.k')::DOUBLE), 0) AS maxima,
         nullif(least(value, (props->>'$.k')::DOUBLE), 0) AS minima,
         nullif((props->>'$.k')::BIGINT, 0) AS volume,
         CASE WHEN event_type = 'purchase' THEN 'USD' ELSE 'BRL' END AS moeda,
         'B3' AS bolsa, ts AS coletado_em
  FROM events"""


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as patients: two measures of the text and the 0/1 outcome.

    The text is reduced to its measures before the join, so no text is shuffled.
    """
    measures = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("glucose"),
        (count_words("text") - 1).cast("double").alias("bmi"),
    )
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("outcome"))
    return measures.join(labels, "doc_id")


PATIENTS_SQL = """
  SELECT doc_id, n_chars::DOUBLE AS glucose,
         (length(text) - length(replace(text, ' ', '')))::DOUBLE AS bmi, quality AS outcome
  FROM documents JOIN labels USING (doc_id)"""

SPLIT_SQL = f"""
  SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY md5(doc_id || '|42'))
            <= round(count(*) OVER (PARTITION BY outcome) * 0.25) AS em_teste
  FROM ({PATIENTS_SQL}) WHERE glucose > 0 AND bmi > 0"""


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("texto")
    )


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ, the naive UTC type of the tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})
