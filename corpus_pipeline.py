"""A corpus from raw documents to token ids: toxicity, near copies, benchmark leaks, secrets, BPE.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlab.llm import decontaminate, jaccard_join, secrets, toxicity
from streamlab.llm.catalogue import codec, digests
from streamlab.llm.session import IdTable, documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject; NULL and empty texts stay."""
    machine = toxicity.fit(docs, toxicity.training_labels(documents(spark, sf_dir, "labels")))
    return toxicity.score(docs, machine).where("predicted = 0").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each linked group; documents without an id stay.

    Decided by the ids that go: of all other documents no text is moved.
    """
    links = jaccard_join.link(docs).where("doc_id is not null")
    ids = links.groupBy("doc_id").agg(F.bool_or(F.col("component_id") == F.col("doc_id")).alias("stays"), F.count("*").alias("rows_of_id"))
    touched = written(ids.where("not stays or rows_of_id > 1").select("doc_id", "stays"), "touched")
    some, others = IdTable(touched.select("doc_id")).split(docs)
    known = touched.withColumnsRenamed({"doc_id": "__touched_id", "stays": "__touched_stays"})
    known = some.join(known, some["doc_id"] == known["__touched_id"], "left")
    clean = known.where("__touched_id is null").select(*(some[c] for c in docs.columns))
    # of rows that share an id, the first in the order of all columns
    again = known.where("__touched_stays").withColumn(
        "__touched_place", F.row_number().over(Window.partitionBy("__touched_id").orderBy(*(some[c] for c in docs.columns)))
    )
    first = again.where("__touched_place = 1").select(*(F.col(c) for c in docs.columns))
    return others.unionAll(clean).unionAll(first)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    found = decontaminate.find_leaks(docs, documents(spark, sf_dir, "benchmark"), column="benchmark_leaks")
    return found.where(F.size("benchmark_leaks") == 0).select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced; n_chars follows the text where it changed."""
    found = secrets.redact(docs, spans="secret_spans")
    changed = F.size("secret_spans") > 0
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars")))
    return found.select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    kept = [c for c in docs.columns if c != "text"]
    return digests(codec(spark).round_trip(docs)).select(*kept, "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("byte-level BPE", to_tokens),
]

# the fitted classifier, the fingerprints and the merges are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
