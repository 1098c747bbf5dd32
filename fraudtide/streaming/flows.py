"""The streaming queries. Source and sink are arguments: a topic in production, files here."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudtide.functions.events import decode_events
from fraudtide.operators.contract import accepted, reasons, validate_contract
from fraudtide.operators.learning import encode_alerts, fraud_alerts, score
from fraudtide.operators.window_features import window_features
from fraudtide.schemas import FEATURE_COLUMNS

WATERMARK = "10 seconds"
DECODED = "decoded"
SCORING = "scoring"


def feature_stream(
    events: DataFrame,
    size: str = "1 minute",
    slide: str | None = "30 seconds",
    watermark: str = WATERMARK,
    time_col: str = "event_time",
) -> DataFrame:
    """Window features of a stream of decoded events.

    In append mode a window comes out once, when the watermark passes its end.
    """
    return window_features(events.withWatermark(time_col, watermark), size, slide, time_col)


def features_from_records(records: DataFrame, **windows) -> DataFrame:
    """Window features of a stream of `value` JSON records.

    A record without a readable event time belongs to no window; the batches' progress
    reports how many there were, under ``DECODED``.
    """
    decoded = decode_events(records).observe(
        DECODED, F.count("*").alias("records"), F.count_if(F.col("event_time").isNull()).alias("untimed")
    )
    return feature_stream(decoded, **windows)


def _scorable(records: DataFrame) -> DataFrame:
    """Keep events the model can judge. The batches' progress counts all of them under ``SCORING``: records,
    scored, and rejected by reason; ``routed_records`` shows the rejected ones."""
    checked = validate_contract(records, features=FEATURE_COLUMNS)
    why = [F.count_if(F.col("reject_reason") == r).alias(r) for r in reasons(features=FEATURE_COLUMNS)]
    return accepted(checked.observe(SCORING, F.count("*").alias("records"), F.count_if("valid").alias("scored"), *why))


def alerts_from_records(records: DataFrame, model: PipelineModel) -> DataFrame:
    """Score a stream of `value` JSON records and encode frauds as alert records."""
    return encode_alerts(fraud_alerts(score(model, _scorable(records))))


def scored_from_records(records: DataFrame, model: PipelineModel) -> DataFrame:
    """Score a stream and keep every row, for dashboards that show model predictions.

    `ingest_time` is when the micro-batch began, so its distance from `event_time` is a
    measured latency.
    """
    return score(model, _scorable(records)).select(
        "event_time", "event_timestamp", "Time", "Amount", "Class", "prediction", "score",
        F.current_timestamp().alias("ingest_time"),
    )


def routed_records(
    records: DataFrame, features: list[str] | None = None, passthrough: list[str] | None = None
) -> DataFrame:
    """Decode a stream and label each row `accepted` or `quarantined` in `route`.

    Written with ``partitionBy("route")`` good and rejected rows land in one exactly-once
    table, in a folder each.
    """
    return validate_contract(records, features=features, passthrough=passthrough).withColumn(
        "route", F.when(F.col("valid"), "accepted").otherwise("quarantined")
    )
