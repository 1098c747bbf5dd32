"""Dashboard queries over `window_start, prediction, Amount` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1e6
LATENCY_LITERAL = 0.42  # fixed value shown by the latency widget of the original dashboard


def _is(prediction: int) -> Column:
    return F.col("prediction") == F.lit(float(prediction))


def _number(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def direct_access_top(df: DataFrame, n: int = 10) -> DataFrame:
    """Report the ``n`` latest windows: rows, frauds and average amount."""
    return (
        df.groupBy("window_start")
        .agg(
            F.count("*").alias("total_transactions"),
            _number(_is(1)).alias("fraud_count"),
            F.avg("Amount").alias("avg_amount"),
        )
        .orderBy(F.desc("window_start"))
        .limit(n)
    )


def class_counts(df: DataFrame) -> DataFrame:
    """Widget 1: normal and fraudulent rows per window, latest first."""
    return (
        df.groupBy("window_start")
        .agg(
            _number(_is(0)).alias("normal_transactions"),
            _number(_is(1)).alias("fraud_transactions"),
            F.count("*").alias("total_volume"),
        )
        .orderBy(F.desc("window_start"))
    )


def fraud_kpi(df: DataFrame) -> DataFrame:
    """Widget 2: fraudulent, legitimate and total amounts over the whole table."""
    return df.agg(
        F.sum(F.when(_is(1), F.col("Amount")).otherwise(0.0)).alias("total_fraud_amount_usd"),
        F.avg(F.when(_is(1), F.col("Amount"))).alias("avg_fraud_amount_usd"),
        F.sum(F.when(_is(0), F.col("Amount")).otherwise(0.0)).alias("total_legit_amount_usd"),
        F.sum("Amount").alias("total_processed_volume_usd"),
    )


def latency_literal(df: DataFrame, latency: float = LATENCY_LITERAL) -> DataFrame:
    """Widget 3 as published: rows per window beside a constant. See ``latency_trend``."""
    return (
        df.groupBy("window_start")
        .agg(
            F.count("*").alias("microbatch_size"),
            F.round(F.avg(F.lit(float(latency))), 2).alias("avg_processing_latency_seconds"),
        )
        .orderBy(F.desc("window_start"))
    )


def fraud_rate(df: DataFrame) -> DataFrame:
    """Widget 4: share of fraudulent rows per window, in percent."""
    frauds = _number(_is(1))
    return (
        df.groupBy("window_start")
        .agg(
            F.count("*").alias("total_tx"),
            frauds.alias("fraud_tx"),
            F.round(frauds.cast("double") * 100.0 / F.count("*"), 2).alias("fraud_rate_percentage"),
        )
        .orderBy(F.desc("window_start"))
    )


def latency_micros(event_time: str = "event_time", ingest_time: str = "ingest_time") -> Column:
    """Microseconds from event to ingest; whole numbers, so averages do not depend on row order."""
    return F.unix_micros(ingest_time) - F.unix_micros(event_time)


def latency_trend(
    df: DataFrame,
    size: str = "1 minute",
    event_time: str = "event_time",
    ingest_time: str = "ingest_time",
) -> DataFrame:
    """Measured seconds from event to ingest, per tumbling window of event time.

    The 95th percentile is exact at any size: equal latencies are counted first, and their running
    total is taken in order within the window, which streams through a task and may spill.
    """
    measured = df.select(F.window(event_time, size).alias("window"), latency_micros(event_time, ingest_time).alias("latency"))
    counted = measured.groupBy("window", "latency").agg(F.count("*").alias("n"))
    own = Window.partitionBy("window")
    placed = counted.withColumns({"upto": F.sum("n").over(own.orderBy("latency")), "all": F.sum("n").over(own)})
    return (
        placed.groupBy("window")
        .agg(
            F.sum("n").alias("microbatch_size"),
            (F.sum(F.col("latency") * F.col("n")) / F.sum("n") / MICROS).alias("avg_latency_seconds"),
            (F.min(F.when(F.col("upto") * 100 >= F.col("all") * 95, F.col("latency"))) / MICROS).alias("p95_latency_seconds"),
            (F.max("latency") / MICROS).alias("max_latency_seconds"),
        )
        .select(F.col("window.start").alias("window_start"), "*")
        .drop("window")
        .orderBy(F.desc("window_start"))
    )


def weighted_widgets(features: DataFrame) -> DataFrame:
    """Per-window counts, amounts and rate at transaction grain, from feature rows.

    A feature row stands for ``tx_count_1m`` transactions, so counting feature rows (as the
    literal widgets do) undercounts. Feed tumbling windows: sliding ones hold each
    transaction more than once.
    """
    fraud = F.col("Class") == 1
    total = F.sum("tx_count_1m")
    frauds = F.sum(F.when(fraud, F.col("tx_count_1m")).otherwise(0))
    return (
        features.groupBy("window_start")
        .agg(
            (total - frauds).alias("normal_transactions"),
            frauds.alias("fraud_transactions"),
            total.alias("total_volume"),
            F.sum(F.when(fraud, F.col("total_amount_1m")).otherwise(0.0)).alias("fraud_amount_usd"),
            F.sum("total_amount_1m").alias("total_amount_usd"),
            F.round(frauds.cast("double") * 100.0 / total, 2).alias("fraud_rate_percentage"),
        )
        .orderBy(F.desc("window_start"))
    )
