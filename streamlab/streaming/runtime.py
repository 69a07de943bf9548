"""Starting, draining, stopping and observing streaming queries."""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from streamlab.config import small_frame
from streamlab.sinks.paths import Record, files_in, read_text, write_text

Handler = Callable[[DataFrame, int], None]

_PROGRESS = (
    T.StructType()
    .add("consulta", "string")
    .add("lote", "long")
    .add("duracao_ms", "long")
    .add("linhas_entrada", "long")
    .add("linhas_saida", "long")
    .add("linhas_estado", "long")
    .add("grupos_atrasados", "long")  # partial aggregates that came too late, not input rows
    .add("watermark", "string")
)


_OUTPUT = "saida"


def _counted(df: DataFrame) -> DataFrame:
    """Count the output rows of every batch while they are written, without another job."""
    return df.observe(_OUTPUT, F.count(F.lit(1)).alias("linhas"))


def show_batch(batch: DataFrame, *order: str, n: int = 20) -> None:
    """Print the first rows of a batch, or of a table it was written to, in order."""
    batch.orderBy(*order).show(n, truncate=False)


def _trigger(writer, seconds: int | None):
    """A fixed interval for a running job, or "everything available, then stop"."""
    if seconds is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=f"{seconds} seconds")


def start_batches(
    df: DataFrame,
    handler: Handler,
    checkpoint: str,
    mode: str = "append",
    seconds: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``handler(batch, batch_id)``.

    A handler should run exactly one action over the whole batch: each further action
    computes the batch again, state store included, and none at all leaves the state
    uncommitted. Write it once and go on from the written rows.
    """
    writer = _counted(df).writeStream.outputMode(mode).foreachBatch(handler)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return _trigger(writer, seconds).start()


def start_table(
    df: DataFrame, path: str, checkpoint: str, seconds: int | None = None
) -> StreamingQuery:
    """Append rows to a Parquet table; Spark's file sink makes each batch exactly once."""
    writer = _counted(df).writeStream.outputMode("append").format("parquet").option("path", path)
    return _trigger(writer.option("checkpointLocation", checkpoint), seconds).start()


def run_stream(query: StreamingQuery, timeout: int | None = None) -> StreamingQuery:
    """Wait for the end, or for ``timeout`` seconds and then drain and stop."""
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.processAllAvailable()
    finally:
        query.stop()
    return query


def _progress_row(p) -> tuple:
    state, output = p.stateOperators, p.observedMetrics.get(_OUTPUT)
    return (
        str(p.id),
        p.batchId,
        p.batchDuration,
        p.numInputRows,
        output["linhas"] if output else None,
        sum(s.numRowsTotal for s in state),
        sum(s.numRowsDroppedByWatermark for s in state),
        dict(p.eventTime).get("watermark"),
    )


def _frame(spark: SparkSession, progress: Iterable) -> DataFrame:
    return small_frame(spark, [_progress_row(p) for p in progress], _PROGRESS)


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """The query's recent micro-batches (Spark keeps the last 100) as rows."""
    return _frame(spark, query.recentProgress)


class ProgressTable(StreamingQueryListener):
    """Listener that keeps one row per query and batch for good, in files under ``path``.

    The newest ``RANGE`` batches of a query are a record replaced with each report; a range that is
    full becomes a file of its own and is not touched again. A batch that is replayed replaces its
    row. So a report costs the same however many came before, a restarted job goes on with the same
    table (the query's id stays with its checkpoint), and sums over it are exact.
    """

    RANGE = 100

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._open: dict[str, dict] = {}  # query -> its newest range
        self._records: dict[str, Record] = {}
        self.errors: list[tuple[str, str]] = []

    def _record(self, query: str) -> Record:
        return self._records.setdefault(query, Record(self.spark, f"{self.path}/abertas/{query}"))

    def _file(self, query: str, number: int) -> str:
        return f"{self.path}/fechadas/{query}-{number}.json"

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append((str(event.id), event.exception))

    def onQueryProgress(self, event) -> None:
        self.add(_progress_row(event.progress))

    def add(self, row: tuple) -> None:
        query, batch = row[0], row[1]
        number = batch // self.RANGE
        held = self._open.get(query) or self._record(query).read() or {"faixa": number, "linhas": {}}
        if number < held["faixa"]:
            self._close(query, number, {str(batch): row})
        else:
            if number > held["faixa"]:
                self._close(query, held["faixa"], held["linhas"])
                held = {"faixa": number, "linhas": {}}
            held["linhas"][str(batch)] = row
            self._record(query).write(held)
        self._open[query] = held

    def _close(self, query: str, number: int, rows: dict) -> None:
        """Add rows to the file of a full range."""
        path = self._file(query, number)
        known = {str(r["lote"]): r for r in map(json.loads, (read_text(self.spark, path) or "").splitlines())}
        known |= {n: dict(zip(_PROGRESS.names, r)) for n, r in rows.items()}
        write_text(self.spark, path, "\n".join(json.dumps(known[n]) for n in sorted(known, key=int)))

    def wait(self, query: StreamingQuery, seconds: float = 30) -> None:
        """Reports come a little after their batch: wait for the last one of a stopped query."""
        last, end = query.lastProgress, time.monotonic() + seconds
        while last and time.monotonic() < end:
            held = self._open.get(str(query.id))
            if held and (held["faixa"] > last.batchId // self.RANGE or str(last.batchId) in held["linhas"]):
                return
            time.sleep(0.05)

    def frame(self) -> DataFrame:
        """All rows, one per query and batch."""
        names = [s.rsplit(".", 2)[0] for s in files_in(self.spark, f"{self.path}/abertas/*.json")]
        held = [self._record(n).read() for n in sorted(set(names))]
        newest = small_frame(self.spark, [tuple(r) for h in held if h for r in h["linhas"].values()], _PROGRESS)
        if not files_in(self.spark, f"{self.path}/fechadas/*.json"):
            return newest
        closed = self.spark.read.schema(_PROGRESS).json(f"{self.path}/fechadas/*.json")
        # a range can be in both for a moment; the rows are the same
        return closed.unionByName(newest).dropDuplicates(["consulta", "lote"])


class ProgressLog(StreamingQueryListener):
    """Listener that keeps the last ``keep`` progress reports of all queries."""

    def __init__(self, keep: int = 1000):
        self._reports: deque = deque(maxlen=keep)
        self.errors: deque = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._reports.append(event.progress)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.exception:
            self.errors.append((str(event.id), event.exception))

    def frame(self, spark: SparkSession) -> DataFrame:
        return _frame(spark, list(self._reports))
