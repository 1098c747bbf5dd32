"""Classifier metrics from scored rows.

Everything derives from one aggregate: per distinct score, how many rows of each class and
how many of them were predicted positive. The areas under the curves need running totals
over the distinct scores; these are taken within score ranges of bounded size and shifted
by the totals of the higher ranges, so no task walks all scores.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.session import materialised

COUNTS = ("tp", "fp", "flagged_tp", "flagged_fp")


def score_counts(
    scored: DataFrame,
    score: str = "score",
    label: str = "Class",
    prediction: str = "prediction",
    digits: int | None = None,
) -> DataFrame:
    """Count rows per distinct score: `tp`/`fp` by label, `flagged_*` those predicted 1.

    Exact by default. ``digits`` rounds the scores first, which bounds how many there are
    (and so what is shuffled) at the price of ties.
    """
    positive, flagged = F.col(label) == 1, F.col(prediction) == 1
    value = F.col(score).cast("double")
    if digits is not None:
        value = F.round(value, digits)
    return scored.groupBy(value.alias("score")).agg(
        F.count_if(positive).alias("tp"),
        F.count_if(~positive).alias("fp"),
        F.count_if(positive & flagged).alias("flagged_tp"),
        F.count_if(~positive & flagged).alias("flagged_fp"),
    )


def _with_range(counts: DataFrame, rows_per_range: int) -> DataFrame:
    """Add `range`: consecutive ranges of about ``rows_per_range`` distinct scores."""
    needed = math.ceil(counts.count() / rows_per_range)
    probabilities = [i / max(needed, 2) for i in range(1, max(needed, 2))]
    ends = counts.agg(F.percentile_approx("score", probabilities, max(10_000, 10 * needed))).first()[0]
    splits = sorted({e for e in ends or [] if math.isfinite(e)} or {0.0})
    bucketizer = Bucketizer(
        splits=[-float("inf"), *splits, float("inf")], inputCol="score", outputCol="range", handleInvalid="keep"
    )
    # A null score ranks below all others, as it does in a descending order.
    return bucketizer.transform(counts).withColumn("range", F.coalesce("range", F.lit(-1.0)))


def curve(counts: DataFrame, rows_per_range: int = 1_000_000) -> DataFrame:
    """Add the running `cum_tp` and `cum_fp` from the highest score down, ties together.

    The counts are written out first: scoring, which may be a whole forest per row, then
    happens once however often the counts are read.
    """
    ranged = _with_range(materialised(counts, "score-counts"), rows_per_range)
    higher = Window.partitionBy(F.lit(0)).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    shifts = (
        ranged.groupBy("range")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
        .select(
            "range",
            F.coalesce(F.sum("tp").over(higher), F.lit(0)).alias("higher_tp"),
            F.coalesce(F.sum("fp").over(higher), F.lit(0)).alias("higher_fp"),
        )
    )
    within = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(shifts, "range").select(
        "score",
        *COUNTS,
        (F.col("higher_tp") + F.sum("tp").over(within)).alias("cum_tp"),
        (F.col("higher_fp") + F.sum("fp").over(within)).alias("cum_fp"),
    )


def _roc_auc() -> Column:
    pairs_won = F.sum(F.col("fp") * (F.col("cum_tp") - F.col("tp") / F.lit(2.0)))
    return F.try_divide(pairs_won, F.sum("tp").cast("double") * F.sum("fp"))


def _pr_auc() -> Column:
    precision = F.col("cum_tp") / (F.col("cum_tp") + F.col("cum_fp"))
    before_tp, before_fp = F.col("cum_tp") - F.col("tp"), F.col("cum_fp") - F.col("fp")
    # The curve starts at recall 0 with the first precision.
    previous = F.coalesce(F.try_divide(before_tp, before_tp + before_fp), precision)
    return F.try_divide(F.sum(F.col("tp") * (precision + previous) / 2.0), F.sum("tp"))


def roc_auc(scored: DataFrame, rows_per_range: int = 1_000_000, **columns) -> DataFrame:
    """Report the exact area under the ROC curve; null when a class is missing."""
    return curve(score_counts(scored, **columns), rows_per_range).agg(_roc_auc().alias("roc_auc"))


def pr_auc(scored: DataFrame, rows_per_range: int = 1_000_000, **columns) -> DataFrame:
    """Report the exact area under the precision-recall curve, by trapezoids."""
    return curve(score_counts(scored, **columns), rows_per_range).agg(_pr_auc().alias("pr_auc"))


def _cells() -> list[Column]:
    tp, fp = F.sum("flagged_tp").cast("double"), F.sum("flagged_fp").cast("double")
    return [
        tp.alias("n11"),
        fp.alias("n01"),
        (F.sum("tp") - tp).alias("n10"),
        (F.sum("fp") - fp).alias("n00"),
    ]


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(0.0))


def _rates() -> list[Column]:
    """Class-weighted and positive-class rates from the four cells `n<label><prediction>`."""
    n11, n01, n10, n00 = (F.col(c) for c in ("n11", "n01", "n10", "n00"))
    positives, negatives = n11 + n10, n01 + n00
    rows = positives + negatives

    def f1(precision: Column, recall: Column) -> Column:
        return _ratio(2.0 * precision * recall, precision + recall)

    precision_1, recall_1 = _ratio(n11, n11 + n01), _ratio(n11, positives)
    precision_0, recall_0 = _ratio(n00, n00 + n10), _ratio(n00, negatives)

    def weighted(of_1: Column, of_0: Column) -> Column:
        return F.try_divide(positives * of_1 + negatives * of_0, rows)

    return [
        weighted(precision_1, precision_0).alias("precision"),
        weighted(recall_1, recall_0).alias("recall"),
        weighted(f1(precision_1, recall_1), f1(precision_0, recall_0)).alias("f1_score"),
        precision_1.alias("fraud_precision"),
        recall_1.alias("fraud_recall"),
        f1(precision_1, recall_1).alias("fraud_f1_score"),
    ]


def confusion_metrics(scored: DataFrame, label: str = "Class", prediction: str = "prediction") -> DataFrame:
    """Report the confusion cells and the rates, class-weighted and for frauds alone.

    On rare frauds the weighted rates mostly describe the majority class.
    """
    positive, flagged = F.col(label) == 1, F.col(prediction) == 1
    counts = scored.agg(
        F.count_if(positive).alias("tp"),
        F.count_if(~positive).alias("fp"),
        F.count_if(positive & flagged).alias("flagged_tp"),
        F.count_if(~positive & flagged).alias("flagged_fp"),
    )
    cells = [c.cast("bigint").alias(n) for c, n in zip(_cells(), ("n11", "n01", "n10", "n00"))]
    return counts.agg(*cells).select(
        F.col("n11").alias("true_positives"),
        F.col("n01").alias("false_positives"),
        F.col("n10").alias("false_negatives"),
        F.col("n00").alias("true_negatives"),
        *_rates(),
    )


def evaluate(scored: DataFrame, rows_per_range: int = 1_000_000, **columns) -> DataFrame:
    """Report ROC-AUC, PR-AUC and all rates of scored rows as one row."""
    points = curve(score_counts(scored, **columns), rows_per_range)
    return points.agg(_roc_auc().alias("roc_auc"), _pr_auc().alias("pr_auc"), *_cells()).select(
        "roc_auc", "pr_auc", *_rates()
    )
