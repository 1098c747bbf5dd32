"""Windowed transaction features; the same function serves batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_features(
    events: DataFrame,
    size: str = "1 minute",
    slide: str | None = "30 seconds",
    time_col: str = "event_time",
    label: str = "Class",
    amount: str = "Amount",
) -> DataFrame:
    """Count, total and average amount per window and class.

    With ``slide`` below ``size`` each event counts in every window that covers it; with
    ``slide=None`` windows tumble. A window can hold any share of the rows: counts and
    sums are combined before the shuffle.
    """
    span = F.window(time_col, size, slide) if slide else F.window(time_col, size)
    return (
        events.groupBy(span.alias("window"), F.col(label))
        .agg(
            F.count("*").alias("tx_count_1m"),
            F.sum(amount).alias("total_amount_1m"),
            F.avg(amount).alias("avg_amount_1m"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            label,
            "tx_count_1m",
            "total_amount_1m",
            "avg_amount_1m",
        )
    )
