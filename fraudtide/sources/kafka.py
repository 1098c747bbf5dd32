"""Kafka source and sinks. They need the spark-sql-kafka package on the classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def source_options(bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Read a topic from its start. Lost offsets are tolerated, so loss must be monitored."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_topic(spark: SparkSession, bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Return a streaming frame of Kafka records (`key`, `value`, …)."""
    options = source_options(bootstrap, topic, max_offsets_per_trigger)
    return spark.readStream.format("kafka").options(**options).load()


def publish_options(bootstrap: str, topic: str) -> dict[str, str]:
    """Batch publication: wait for all replicas, retry, keep the order within a partition."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.retries": "5",
        "kafka.max.in.flight.requests.per.connection": "1",
    }


def publish(records: DataFrame, bootstrap: str, topic: str) -> None:
    """Publish `key, value` records from all executors."""
    records.select("key", "value").write.format("kafka").options(
        **publish_options(bootstrap, topic)
    ).save()


def topic_writer(records: DataFrame, bootstrap: str, topic: str) -> DataStreamWriter:
    """Return a writer of `key, value` records to a topic.

    Spark's Kafka sink is at-least-once: consumers drop what they have seen by ``alert_id``.
    """
    return (
        records.select("key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .outputMode("append")
    )
