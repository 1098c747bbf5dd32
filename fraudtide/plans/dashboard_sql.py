"""The dashboard as SQL text over the published views, with named parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATEMENTS = {
    "direct_access": """
        SELECT window_start, count(*) AS total_transactions, count_if(prediction = 1) AS fraud_count,
               avg(Amount) AS avg_amount
        FROM transactions GROUP BY window_start ORDER BY window_start DESC LIMIT :latest""",
    "class_counts": """
        SELECT window_start, count_if(prediction = 0) AS normal_transactions, count_if(prediction = 1) AS fraud_transactions,
               count(*) AS total_volume
        FROM global_temp.transactions GROUP BY window_start ORDER BY window_start DESC""",
    "fraud_kpi": """
        SELECT coalesce(sum(Amount) FILTER (WHERE prediction = 1), 0) AS total_fraud_amount_usd,
               avg(Amount) FILTER (WHERE prediction = 1) AS avg_fraud_amount_usd,
               coalesce(sum(Amount) FILTER (WHERE prediction = 0), 0) AS total_legit_amount_usd,
               sum(Amount) AS total_processed_volume_usd
        FROM `fraud_lakehouse.transactions`""",
    "latency": """
        SELECT window_start, count(*) AS microbatch_size, round(avg(:latency), 2) AS avg_processing_latency_seconds
        FROM transactions GROUP BY window_start ORDER BY window_start DESC""",
    "fraud_rate": """
        SELECT window_start, count(*) AS total_tx, count_if(prediction = 1) AS fraud_tx,
               round(count_if(prediction = 1) * 100.0D / count(*), :digits) AS fraud_rate_percentage
        FROM global_temp.transactions GROUP BY window_start ORDER BY window_start DESC""",
}


def statement(spark: SparkSession, name: str, **args) -> DataFrame:
    """Run a statement; values come as parameters and never become part of its text."""
    return spark.sql(STATEMENTS[name], args=args)
