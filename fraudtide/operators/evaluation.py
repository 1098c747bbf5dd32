"""Comparison of measured metrics with published baselines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Published baseline figures. Latencies are seconds, compared to 2 digits and
# better when lower; model metrics are compared to 4 digits and better when higher.
BASELINES = [
    ("latency_10_tps", 0.80, 2, True),
    ("latency_40_tps", 0.90, 2, True),
    ("precision", 0.34, 4, False),
    ("recall", 0.88, 4, False),
    ("f1_score", 0.49, 4, False),
    ("roc_auc", 0.94, 4, False),
]
BASELINE_SCHEMA = "metric string, baseline double, digits int, lower_is_better boolean"


def as_rows(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Turn a one-row metrics frame into `metric, value` rows."""
    return metrics.select([F.col(n).cast("double").alias(n) for n in names]).unpivot([], names, "metric", "value")


def compare_to_baseline(spark: SparkSession, metrics: DataFrame, baselines: list[tuple] = BASELINES) -> DataFrame:
    """Join `metric, value` rows to the baselines and report difference and status.

    A metric without a published baseline keeps its row with nulls.
    """
    published = spark.createDataFrame(baselines, BASELINE_SCHEMA)
    diff = F.col("value") - F.col("baseline")
    better = F.when(F.col("lower_is_better"), diff <= 0).otherwise(diff > 0)
    status = (
        F.when(diff.isNull(), F.lit(None).cast("string"))
        .when(F.col("lower_is_better"), F.when(better, "FASTER (Better)").otherwise("SLOWER"))
        .otherwise(F.when(better, "HIGHER").otherwise("NOT HIGHER"))
    )
    rounded = F.when(F.col("digits") == 2, F.round(diff, 2)).otherwise(F.round(diff, 4))
    return metrics.join(F.broadcast(published), "metric", "left").select(
        "metric", "value", "baseline", rounded.alias("diff"), status.alias("status")
    )
