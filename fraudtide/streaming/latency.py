"""How long events took to reach a sink, from when its batches were committed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def commits(spark: SparkSession, batches: list[dict]) -> DataFrame:
    """``batch, ingest_time`` of the batches that had records: when each of them ended.

    ``batches`` are progress reports, of a listener or of a query that has stopped.
    """
    rows = [
        (b["batchId"], datetime.fromisoformat(b["timestamp"]) + timedelta(milliseconds=b["durationMs"]["triggerExecution"]))
        for b in batches
        if b["numInputRows"]
    ]
    return spark.createDataFrame(rows, "batch long, ingest_time timestamp")


def arrived(written: DataFrame, committed: DataFrame) -> DataFrame:
    """The rows of a sink with a ``batch`` column, each with the ``ingest_time`` of its batch."""
    return written.join(committed, "batch")
