"""Windows that a stopped stream has not yet given out, from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# How the state keeps a window's count, sum and average: the last as a sum and a count.
AGGREGATES = "struct<n:bigint,total:double,sum:double,count:bigint>"


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The windows of a feature stream that its watermark has not passed, in the columns of the features.

    Read with the state data source, after the stream has stopped or as of an earlier ``batch``. Each state
    partition is read by a task; nothing is started again.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint).select("key", F.col("value").cast(AGGREGATES).alias("v"))
    return state.select(
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("key.Class").alias("Class"),
        F.col("v.n").alias("tx_count_1m"),
        F.col("v.total").alias("total_amount_1m"),
        (F.col("v.sum") / F.col("v.count")).alias("avg_amount_1m"),
    )
