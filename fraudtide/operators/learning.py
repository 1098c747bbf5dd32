"""Fraud classifier: training, scoring, alerts, persistence."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudtide.operators.sampling import SEED, undersample
from fraudtide.schemas import FEATURE_COLUMNS
from fraudtide.session import materialised


def features_complete(columns: list[str] = FEATURE_COLUMNS) -> Column:
    """Mark rows with a usable number in every feature."""
    return reduce(Column.__and__, [F.col(c).isNotNull() & ~F.isnan(c) for c in columns])


def forest_pipeline(
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = SEED,
    label: str = "Class",
    weight_col: str | None = None,
    columns: list[str] = FEATURE_COLUMNS,
) -> Pipeline:
    """Assemble, standardise, random forest.

    ``handleInvalid="keep"`` lets a stream score a row with a missing feature instead of
    failing the query; such rows are recognised with ``features_complete``.
    """
    assembler = VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=True)
    forest = RandomForestClassifier(
        featuresCol="features", labelCol=label, numTrees=num_trees, maxDepth=max_depth, seed=seed
    )
    if weight_col:
        forest = forest.setWeightCol(weight_col)
    return Pipeline(stages=[assembler, scaler, forest])


def train(df: DataFrame, id_col: str, balance: bool = True, label: str = "Class", **forest) -> PipelineModel:
    """Fit the forest on complete rows, undersampled unless a weight column balances them.

    What the fit needs of the training rows is written to the shared folder, as scaler and forest
    pass over it several times. The model is a copy without the summary of its training, which would
    take the session along into every task.
    """
    columns = forest.get("columns", FEATURE_COLUMNS)
    rows = df.where(features_complete(columns))
    if balance:
        rows = undersample(rows, id_col, label)
    needed = [*columns, label, *filter(None, [forest.get("weight_col")])]
    return forest_pipeline(label=label, **forest).fit(materialised(rows.select(*needed), "training-rows")).copy()


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add `prediction` and `score`, the probability of fraud; works on streams."""
    return (
        model.transform(df)
        .withColumn("score", vector_to_array("probability")[1])
        .drop("raw_features", "features", "rawPrediction", "probability")
    )


def fraud_alerts(scored: DataFrame, label: str = "Class") -> DataFrame:
    """Keep rows predicted as fraud, in the shape of an alert."""
    return scored.where(F.col("prediction") == 1.0).select(
        "event_timestamp", "Time", "Amount", "prediction", F.col(label).alias("actual_label")
    )


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Turn alerts into `key, value` records keyed by event timestamp.

    Two alerts of one instant share the key. ``alert_id`` in the value tells them apart: a hash of the
    whole alert, so that a record sent twice has it twice.
    """
    value = F.struct("*", F.sha2(F.to_json(F.struct("*")), 256).alias("alert_id"))
    return alerts.select(F.col("event_timestamp").cast("string").alias("key"), F.to_json(value).alias("value"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
