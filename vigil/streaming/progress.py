"""Progress of streaming queries as a table.

A query keeps the progress of its last 100 batches only, and loses it when the
driver ends. ``ProgressTable`` is a ``StreamingQueryListener`` that appends every
progress event to a JSON table in the shared folder: a row for each batch with
the input rows, the rows dropped by the watermark and the rows in state, and the
metrics observed by expectations. The reports are aggregates over that table, so
they hold for any number of batches, restarts and queries.

Events come to the listener's thread and are written by a thread of their own, as
many as have come, so that queries don't wait for it. A batch that is reported
twice (again after a restart, or as an idle trigger) counts once.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager
from queue import SimpleQueue

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from vigil.operators.quality import Expectation
from vigil.sources.tables import is_missing_path

SCHEMA = ("query_name string, query_id string, run_id string, batch_id long, triggered string, input_rows long, "
          "rows_dropped_by_watermark long, state_rows long, observed map<string, map<string, long>>")


def _row(p) -> tuple:
    observed = {name: {k: int(v) for k, v in row.asDict().items() if v is not None} for name, row in (p.observedMetrics or {}).items()}
    operators = p.stateOperators or []
    return (p.name, str(p.id), str(p.runId), int(p.batchId), p.timestamp, int(p.numInputRows),
            sum(int(o.numRowsDroppedByWatermark) for o in operators), sum(int(o.numRowsTotal) for o in operators), observed)


class ProgressTable(StreamingQueryListener):
    """Appends the progress of the session's streaming queries to the table at ``path``, from ``open`` to ``close``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._events: SimpleQueue = SimpleQueue()
        self._ended: set[str] = set()
        self._news = threading.Condition()
        self._writer = threading.Thread(target=self._write, daemon=True)
        self._failure: BaseException | None = None

    def open(self) -> ProgressTable:
        self._writer.start()
        self.spark.streams.addListener(self)
        return self

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._events.put(_row(event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def _write(self) -> None:
        while True:
            rows = [self._events.get()]
            while not self._events.empty():
                rows.append(self._events.get())
            ends = None in rows
            rows = [r for r in rows if r is not None]
            try:
                if rows:
                    self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(self.path)
            except Exception as e:  # noqa: BLE001 - told to whoever closes the table
                self._failure = self._failure or e
            if ends:
                return

    def close(self, queries: list[StreamingQuery] = (), timeout: float = 120.0) -> None:
        """Wait until the events of the ended ``queries`` have come and are written. Raises what a write failed with."""
        with self._news:
            if not self._news.wait_for(lambda: {str(q.runId) for q in queries} <= self._ended, timeout):
                raise TimeoutError("a query has not ended")
        self.spark.streams.removeListener(self)
        self._events.put(None)
        self._writer.join()
        if self._failure:
            raise self._failure


@contextmanager
def recorded(spark: SparkSession, path: str, queries: list[StreamingQuery]):
    """Progress goes to ``path`` while the block runs; the queries in the list ``queries`` at its end have ended."""
    table = ProgressTable(spark, path).open()
    before = {str(q.runId) for q in queries}
    try:
        yield table
    finally:
        table.close([q for q in queries if str(q.runId) not in before])


def batches(spark: SparkSession, path: str) -> DataFrame:
    """One row for each query and batch."""
    try:
        rows = spark.read.schema(SCHEMA).json(path)
    except AnalysisException as e:
        if not is_missing_path(e):
            raise
        rows = spark.createDataFrame([], SCHEMA)
    counts = [F.max(c).alias(c) for c in ("input_rows", "rows_dropped_by_watermark", "state_rows")]
    return rows.groupBy("query_id", "query_name", "batch_id").agg(F.max("triggered").alias("triggered"), *counts, F.max_by("observed", "input_rows").alias("observed"))


def late_rows_report(spark: SparkSession, path: str) -> DataFrame:
    """For each query: batches with input, input rows, rows that came too late, rows in state after the last batch."""
    return batches(spark, path).groupBy("query_name").agg(
        F.count_if(F.col("input_rows") > 0).alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("rows_dropped_by_watermark").alias("rows_dropped_by_watermark"), F.max_by("state_rows", F.struct("triggered", "batch_id")).alias("state_rows"))


def stream_expectation_report(spark: SparkSession, path: str, name: str, expectations: tuple[Expectation, ...]) -> DataFrame:
    """``quality.expectation_report`` for a stream: the counts observed under ``name`` over all its batches."""
    observed = batches(spark, path).select(F.col("observed")[name].alias("m")).filter("m IS NOT NULL")
    rules = F.explode(F.array(*[F.struct(F.lit(e.name).alias("expectation"), F.lit(e.action).alias("action")) for e in expectations])).alias("rule")
    counts = observed.select(rules, "m").select("rule.*", F.expr("m[rule.expectation]").alias("failed"), F.col("m")["total_records"].alias("total"))
    return counts.groupBy("expectation", "action").agg(F.sum("failed").alias("failed_records"), F.sum("total").alias("total_records"))
