"""Run history and shutdown of streaming jobs."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.listener import StreamingQueryListener

from ledgerloom.schemas import PROGRESS, RUN_HISTORY


def recorded(spark: SparkSession, name: str, history: str, job: Callable[[], object]) -> object:
    """Run a job and append one row (name, state, start, end) to the history, also if it fails."""
    start = datetime.now(timezone.utc)
    state = "FAILED"
    try:
        result = job()
        state = "SUCCEEDED"
        return result
    finally:
        row = (name, state, start, datetime.now(timezone.utc))
        spark.createDataFrame([row], RUN_HISTORY).coalesce(1).write.mode("append").parquet(history)


def run_history(spark: SparkSession, history: str) -> DataFrame:
    return spark.read.schema(RUN_HISTORY).parquet(history)


class ProgressLog(StreamingQueryListener):
    """Progress and end of the session's streaming queries as rows of a history table.

    Within ``with ProgressLog(spark, path)`` every batch of every query is noted: rows read, milliseconds, rows of
    state; and how each query ended, failed ones with their error. The rows are stored once, when the block ends.
    """

    def __init__(self, spark: SparkSession, path: str, patience: float = 30.0):
        self.spark, self.path, self.patience = spark, path, patience
        self.rows: list[tuple] = []
        self.names: dict[str, str | None] = {}
        self.ended = threading.Condition()
        self.open: set[str] = set()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        with self.ended:  # events come after the query's end
            self.ended.wait_for(lambda: not self.open, self.patience)
        self.spark.streams.removeListener(self)
        if self.rows:
            self.spark.createDataFrame(self.rows, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryStarted(self, event) -> None:
        with self.ended:
            self.open.add(str(event.runId))
            self.names[str(event.runId)] = event.name

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = sum(operator.numRowsTotal for operator in p.stateOperators)
        run = str(p.runId)
        self.rows.append((run, p.name, "BATCH", p.batchId, p.numInputRows, p.batchDuration, state, _now(), None))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self.ended:
            state = "FAILED" if event.exception else "FINISHED"
            self.rows.append((run, self.names.get(run), state, None, None, None, None, _now(), event.exception))
            self.open.discard(run)
            self.ended.notify_all()


def progress_history(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(path)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def stop_all(spark: SparkSession) -> list[str]:
    """Stop every running streaming query of the session; returns their names."""
    stopped = []
    for query in spark.streams.active:
        stopped.append(query.name or str(query.id))
        query.stop()
    return stopped
