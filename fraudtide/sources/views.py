"""Canonical views over the driver's tables, standing in for the card-transaction data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudtide.functions.events import iso_utc
from fraudtide.schemas import COMPONENTS, EVENT_LOG

EPOCH_MICROS = 1_704_067_200_000_000  # 2024-01-01T00:00:00Z, the first day of `events`
MICROS = 1e6


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def as_transactions(events: DataFrame) -> DataFrame:
    """Map the event log to transactions; an error event above 150 is a fraud.

    Watermarks reject TIMESTAMP_NTZ, hence the cast.
    """
    event_time = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        "user_id",
        event_time.alias("event_time"),
        iso_utc(event_time).alias("event_timestamp"),
        ((F.unix_micros(event_time) - EPOCH_MICROS) / F.lit(MICROS)).alias("Time"),
        F.col("value").alias("Amount"),
        ((F.col("event_type") == "error") & (F.col("value") > 150)).cast("int").alias("Class"),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_transactions(spark.read.parquet(table_path(sf_dir, "events")))


def stream_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read the event log as a stream; as a pattern the path may be one file or a folder."""
    return as_transactions(
        spark.readStream.schema(EVENT_LOG).parquet(table_path(sf_dir, "{events}"))
    )


def labelled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map embeddings to `V1..V28, Amount, Time, Class`; label 0 is the positive class."""
    vectors = spark.read.parquet(table_path(sf_dir, "embeddings"))
    value = F.col("embedding")
    return vectors.select(
        "vec_id",
        *[value[i].cast("double").alias(name) for i, name in enumerate(COMPONENTS)],
        (F.abs(value[30].cast("double")) * 100).alias("Amount"),
        F.col("vec_id").cast("double").alias("Time"),
        (F.col("label") == 0).cast("int").alias("Class"),
    )
