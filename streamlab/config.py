"""Job settings, session set-up and the shared working folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


# Streaming state lives on local disk with incremental checkpoints instead of on the heap,
# so the number of open windows or keys is not bounded by executor memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class JobSettings:
    """Parameters of a stand-alone job; every field can come from an environment variable.

    The variable is the upper-case field name (``kafka_topic`` <- ``KAFKA_TOPIC``).
    """

    stream_dir: str = "./stream"
    checkpoint_dir: str = ""
    output_dir: str = "./output"
    kafka_bootstrap: str = "localhost:9092"
    kafka_topic: str = "votos"
    jdbc_url: str = ""
    jdbc_user: str = "spark"
    jdbc_password: str = ""
    mongo_uri: str = "mongodb://localhost:27017"
    mongo_db: str = "eleicao"
    mongo_coll: str = "apuracao"
    s3_endpoint: str = ""
    s3_key: str = ""
    s3_secret: str = ""
    base_csv: str = ""
    max_files: int = 0  # files per micro-batch of a running stream; 0 is no limit
    max_bytes: str = ""  # volume per micro-batch, such as "1g"; the better brake when files vary in size
    max_chars: int = 0
    trigger_seconds: int = 15
    state_partitions: int = 0  # shuffle width of stateful queries; 0 leaves Spark's setting

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **defaults) -> "JobSettings":
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):
            raw = env.get(f.name.upper())
            if raw is not None:
                found[f.name] = int(raw) if f.type == "int" else raw
        return replace(cls(**defaults), **found)

    def pace(self) -> tuple[int | None, str | None]:
        """(files, volume) per micro-batch. A drain takes all there is as one batch.

        A backlog is not delivered in the order of its events; cut into batches, its older rows
        would be late by the time they are read and be dropped by a watermark. A flow with windows
        has a drain of its own that puts the backlog in order and keeps to ``max_bytes``.
        """
        if not self.trigger_seconds:
            return None, None
        return self.max_files or None, self.max_bytes or None

    def object_store_conf(self) -> dict[str, str]:
        """Hadoop S3A options for an S3-compatible endpoint; empty when none is configured."""
        if not self.s3_endpoint:
            return {}
        return {
            "spark.hadoop.fs.s3a.endpoint": self.s3_endpoint,
            "spark.hadoop.fs.s3a.access.key": self.s3_key,
            "spark.hadoop.fs.s3a.secret.key": self.s3_secret,
            "spark.hadoop.fs.s3a.path.style.access": "true",
        }


def build_session(app_name: str, settings: JobSettings | None = None) -> SparkSession:
    """Session of a stand-alone job; cluster-level options stay with ``spark-submit``."""
    builder = SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", "UTC")
    conf = dict(STATE_STORE)
    if settings:
        conf |= settings.object_store_conf()
        if settings.state_partitions:
            conf["spark.sql.shuffle.partitions"] = str(settings.state_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def small_frame(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A few driver-side rows (reports, not data) as a local relation, without Python workers."""
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(c, to_arrow_type(f.dataType)) for c, f in zip(columns, schema.fields)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=schema.names), schema)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, for jobs that host a user model.

    Done once per application. Not needed where the package is installed or was passed with
    ``--py-files``.
    """
    if getattr(spark.sparkContext, "_streamlab_shipped", False):
        return
    spark.sparkContext._streamlab_shipped = True
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="streamlab-"), "streamlab")
    spark.sparkContext.addPyFile(shutil.make_archive(target, "zip", root, "streamlab"))


# settings of the caller that a query has to share
_CARRIED = (
    "spark.sql.shuffle.partitions",
    "spark.sql.adaptive.enabled",
    "spark.sql.autoBroadcastJoinThreshold",
    "spark.sql.files.maxPartitionBytes",
)


def isolated_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session with UTC time and on-disk state; the caller's keeps its own settings.

    A stateful stream freezes the number of shuffle partitions in its checkpoint;
    ``state_partitions`` sets it. Everything else keeps the caller's shuffle width.
    """
    child = spark.newSession()
    wanted = {k: spark.conf.get(k) for k in _CARRIED}
    if state_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(state_partitions)
    for key, default in STATE_STORE.items():
        wanted[key] = spark.sparkContext.getConf().get(key, default)
    for key, value in (wanted | {"spark.sql.session.timeZone": "UTC"}).items():
        child.conf.set(key, value)
    return child


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table or a checkpoint.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only where all
    work is done on this machine (tests) a local folder takes its place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/streamlab/{name}-{uuid.uuid4().hex}"
