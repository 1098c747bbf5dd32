"""Append-only log of run metrics, kept as JSON rows next to the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_run(metrics: DataFrame, path: str, phase: str, status: str = "SUCCESS", **details) -> None:
    """Append one metrics row, stamped with the phase, status and time of the run."""
    row = metrics.select(
        F.lit(phase).alias("phase"),
        F.lit(status).alias("status"),
        F.current_timestamp().alias("timestamp"),
        *[F.lit(value).alias(name) for name, value in details.items()],
        *[F.col(name) for name in metrics.columns],
    )
    row.write.mode("append").json(path)
