"""Curves and rates against brute force and against the library's evaluator."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

from fraudtide.operators import evaluation, metrics


def scored(spark, n=2_000, levels=None, seed=3):
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < 0.1).astype(int)
    score = np.clip(rng.normal(0.3 + 0.3 * label, 0.2), 0, 1)
    if levels:
        score = np.round(score * levels) / levels
    rows = [(int(c), float(s), float(s >= 0.5)) for c, s in zip(label, score)]
    return spark.createDataFrame(rows, "Class int, score double, prediction double"), label, score


def brute_roc(label, score):
    diff = score[label == 1][:, None] - score[label == 0][None, :]
    return float(np.mean((diff > 0) + 0.5 * (diff == 0)))


@pytest.mark.parametrize("levels", [None, 20])
@pytest.mark.parametrize("rows_per_range", [7, 200, 1_000_000])
def test_areas(spark, levels, rows_per_range):
    df, label, score = scored(spark, levels=levels)
    roc = metrics.roc_auc(df, rows_per_range).first()[0]
    assert roc == pytest.approx(brute_roc(label, score), rel=1e-12)
    exact = BinaryClassificationEvaluator(labelCol="Class", rawPredictionCol="score", metricName="areaUnderPR", numBins=0)
    assert metrics.pr_auc(df, rows_per_range).first()[0] == pytest.approx(exact.evaluate(df), rel=1e-9)


def test_evaluate_agrees_with_library_and_parts(spark):
    df, _, _ = scored(spark)
    row = metrics.evaluate(df, rows_per_range=100).first().asDict()
    for ours, theirs in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1_score", "f1")):
        other = MulticlassClassificationEvaluator(labelCol="Class", metricName=theirs)
        assert row[ours] == pytest.approx(other.evaluate(df), rel=1e-9)
    cells = metrics.confusion_metrics(df).first().asDict()
    assert cells["true_positives"] + cells["false_negatives"] == df.where("Class = 1").count()
    for name in ("precision", "recall", "f1_score", "fraud_precision", "fraud_recall", "fraud_f1_score"):
        assert row[name] == pytest.approx(cells[name], rel=1e-12)


def test_rounded_scores_come_close(spark):
    df, label, score = scored(spark)
    assert metrics.roc_auc(df, digits=2).first()[0] == pytest.approx(brute_roc(label, score), abs=5e-3)
    assert metrics.score_counts(df, digits=1).count() <= 11


def test_one_class_only(spark):
    df, _, _ = scored(spark)
    row = metrics.evaluate(df.where("Class = 0")).first()
    assert row["roc_auc"] is None and row["pr_auc"] is None and row["fraud_recall"] == 0.0


def test_baseline_statuses(spark):
    rows = [("latency_10_tps", 0.42), ("latency_40_tps", 0.95), ("precision", 0.9981), ("recall", 0.5), ("pr_auc", 0.4866)]
    compared = evaluation.compare_to_baseline(spark, spark.createDataFrame(rows, "metric string, value double"))
    found = {r["metric"]: (r["diff"], r["status"]) for r in compared.collect()}
    assert found == {
        "latency_10_tps": (-0.38, "FASTER (Better)"),
        "latency_40_tps": (0.05, "SLOWER"),
        "precision": (0.6581, "HIGHER"),
        "recall": (-0.38, "NOT HIGHER"),
        "pr_auc": (None, None),
    }
