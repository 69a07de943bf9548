"""Post queries: documents as posts, scored whole."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlab.catalogue import tables as t
from streamlab.config import ship_package, work_dir
from streamlab.functions import head_chars
from streamlab.operators import sentiment as s
from streamlab.plans.posts import sentiment
from streamlab.schemas import SENTIMENT_TABLE
from streamlab.sinks import append_batch, append_csv, read_csv_results
from streamlab.sources import read_table_stream
from streamlab.streaming import run_stream, start_batches

QUERIES, ORACLES, query = t.registry()

_HEAD = 512  # fixed value: input length of the usual sentiment model


def _words(words) -> str:
    return ", ".join(f"'{w}'" for w in sorted(set(words)))


def _scored_sql() -> str:
    counted = f"""SELECT doc_id, text,
        len(list_filter(w, lambda x: x IN ({_words(s.POSITIVE_WORDS)}))) AS p,
        len(list_filter(w, lambda x: x IN ({_words(s.NEGATIVE_WORDS)}))) AS n
      FROM (SELECT doc_id, text, regexp_split_to_array(lower(text), '[^\\p{{L}}]+') AS w FROM documents)"""
    starred = f"""SELECT *, CASE WHEN p + n = 0 THEN 3 WHEN 5 * (p - n) <= -3 * (p + n) THEN 1
        WHEN 5 * (p - n) < -(p + n) THEN 2 WHEN 5 * (p - n) <= p + n THEN 3
        WHEN 5 * (p - n) < 3 * (p + n) THEN 4 ELSE 5 END AS e FROM ({counted})"""
    return f"""SELECT doc_id::VARCHAR AS id, text AS texto,
      CASE WHEN e <= 2 THEN 'NEGATIVO' WHEN e = 3 THEN 'NEUTRO' ELSE 'POSITIVO' END AS sentimento,
      e::INTEGER AS estrelas,
      round(CAST((greatest(p, n) + 1)::DOUBLE / (p + n + 2) AS DECIMAL(38,10)), 3)::DOUBLE AS confianca
      FROM ({starred})"""


_SHORT = "id, sentimento, estrelas, confianca"
_DISTRIBUTION_SQL = f"""SELECT l AS sentimento, count(sentimento)::BIGINT AS total
  FROM (VALUES ('POSITIVO'), ('NEUTRO'), ('NEGATIVO')) d(l)
  LEFT JOIN ({_scored_sql()}) ON l = sentimento GROUP BY 1"""


def _short(df):
    return df.drop("texto")


@query(
    """SELECT doc_id::VARCHAR AS id, text AS texto, coalesce(source, '1970-01-01T00:00:00') AS criado_em
    FROM documents"""
)
def post_shape(spark, sf_dir):
    """Raw records under the post schema (the source column in the place of the time)."""
    docs = t.table(spark, sf_dir, "documents")
    return s.shape_posts(docs, "doc_id", "text", "source", F.lit("1970-01-01T00:00:00"))


@query(f"SELECT doc_id::VARCHAR AS id, substr(text, 1, {_HEAD}) AS texto FROM documents")
def post_head(spark, sf_dir):
    """The truncation operator for models with a bounded input."""
    return t.posts(spark, sf_dir).withColumn("texto", head_chars("texto", _HEAD))


@query(f"SELECT {_SHORT} FROM ({_scored_sql()})")
def post_sentiment(spark, sf_dir):
    return _short(sentiment(t.posts(spark, sf_dir)))


@query(f"SELECT {_SHORT} FROM ({_scored_sql()})")
def post_score_udf(spark, sf_dir):
    """The same rule hosted as a user model in Arrow batches."""
    ship_package(spark)
    return _short(sentiment(t.posts(spark, sf_dir), load_model=s.lexicon_model))


@query(_DISTRIBUTION_SQL)
def post_distribution(spark, sf_dir):
    return s.label_distribution(sentiment(t.posts(spark, sf_dir)))


@query(
    f"""SELECT sentimento, total, round(CAST(total * 100 AS DECIMAL(38,10)) / sum(total) OVER (), 0)::BIGINT
    AS percentual FROM ({_DISTRIBUTION_SQL}) WHERE total > 0"""
)
def post_share(spark, sf_dir):
    return s.label_share(s.label_distribution(sentiment(t.posts(spark, sf_dir))))


def _stream(spark, sf_dir):
    stream = read_table_stream(spark, sf_dir, "documents", t.DOCUMENTS)
    return sentiment(stream.select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("texto")))


@query(f"SELECT id, texto, sentimento, estrelas, confianca FROM ({_scored_sql()})")
def post_csv_append(spark, sf_dir):
    """Stream of posts accumulated as CSV and read back, whole texts included."""
    base = work_dir(spark, "post_csv")
    run_stream(
        start_batches(
            _stream(spark, sf_dir),
            lambda batch, n: append_csv(batch, f"{base}/data", n),
            f"{base}/checkpoint",
        )
    )
    return read_csv_results(spark, f"{base}/data", SENTIMENT_TABLE).drop("lote")


@query(f"SELECT {_SHORT} FROM ({_scored_sql()})")
def post_results_table(spark, sf_dir):
    """Stream of posts accumulated in a Parquet table."""
    base = work_dir(spark, "post_results")
    run_stream(
        start_batches(
            _short(_stream(spark, sf_dir)),
            lambda batch, n: append_batch(batch, f"{base}/data", n),
            f"{base}/checkpoint",
        )
    )
    return spark.read.parquet(f"{base}/data").drop("lote")
