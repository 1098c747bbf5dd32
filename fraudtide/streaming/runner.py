"""Starting, bounding and observing streaming queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener



def table_writer(df: DataFrame, fmt: str = "parquet", by: list[str] | None = None) -> DataStreamWriter:
    """Return an append writer to a file table; with a checkpoint it is exactly-once."""
    writer = df.writeStream.format(fmt).outputMode("append")
    return writer.partitionBy(*by) if by else writer


def start(writer: DataStreamWriter, checkpoint: str, path: str | None = None, every: str | None = "5 seconds") -> StreamingQuery:
    """Start a query on a trigger interval, or with ``every=None`` over what is there now."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def run_available(df: DataFrame, path: str, checkpoint: str, by: list[str] | None = None) -> list[dict]:
    """Process everything available into a table, then stop; returns the batches' progress.

    Called again with the same checkpoint it continues where it stopped. Where window state is kept
    is the session's choice: ``build_session`` has it in RocksDB, off the heap.
    """
    return run_to_end(table_writer(df, by=by), checkpoint, path)


def run_to_end(writer: DataStreamWriter, checkpoint: str, path: str | None = None) -> list[dict]:
    """Process everything available, then stop; returns the batches' progress."""
    query = start(writer, checkpoint, path, every=None)
    query.awaitTermination()
    return list(query.recentProgress)


def read_backlog(spark: SparkSession, path: str, files: int | None = None, size: str | None = None) -> DataFrame:
    """Read a folder of text records as a stream, at most ``files`` files or ``size`` bytes a batch.

    Files come by the time they were written. The event times of a backlog advance by a batch at a time, so
    a watermark has to allow for the span of the files that one batch takes.
    """
    reader = spark.readStream
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    if size:
        reader = reader.option("maxBytesPerTrigger", size)
    return reader.text(path)


class BatchCounts(StreamingQueryListener):
    """Keeps the progress of every batch of the queries that run while it listens."""

    def __init__(self) -> None:
        self.batches: list[dict] = []
        self._started, self._ended = set(), set()
        self._change = threading.Condition()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        with self._change:
            self._started.add(event.runId)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        with self._change:
            self.batches.append(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        with self._change:
            self._ended.add(event.runId)
            self._change.notify_all()

    def wait(self, seconds: float = 60.0) -> list[dict]:
        """All batches, once every query that was seen to start has been seen to end."""
        with self._change:
            self._change.wait_for(lambda: self._started and self._started == self._ended, seconds)
            return list(self.batches)

    def total(self, name: str, metric: str) -> int:
        """A metric that queries observe, over all batches."""
        return observed(self.batches, name, metric)


@contextmanager
def counted_batches(spark: SparkSession) -> Iterator[BatchCounts]:
    """Listen to the queries of a session for the length of a block."""
    counts = BatchCounts()
    spark.streams.addListener(counts)
    try:
        yield counts
        counts.wait()
    finally:
        spark.streams.removeListener(counts)


def run_for(query: StreamingQuery, seconds: float | None = None) -> None:
    """Wait for ``seconds`` and stop the query, or wait until it ends."""
    if seconds is None:
        query.awaitTermination()
        return
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def late_rows(progress: list[dict]) -> int:
    """Count state rows refused as late; an event counts once per window covering it."""
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])


def observed(progress: list[dict], name: str, metric: str) -> int:
    """Add up a metric the query observes, over its batches."""
    rows = [p.get("observedMetrics", {}).get(name) for p in progress]
    return sum(row[metric] for row in rows if row is not None)
