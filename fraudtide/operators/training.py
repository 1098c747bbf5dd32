"""One run of the classifier: split, balance, fit, evaluate, save, log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fraudtide.functions.hashing import hash_unit
from fraudtide.operators import learning, metrics, sampling
from fraudtide.session import scratch_path
from fraudtide.sources import runlog


def balanced_rows(rows: DataFrame, id_col: str, label: str = "Class") -> tuple[DataFrame, dict]:
    """The complete rows, undersampled, and how many of each class there were.

    The classes are counted while the rows are written, so the table is read once; the written rows are then
    filtered by the counts.
    """
    seen = Observation()
    counts = [F.count_if(F.col(label) == c).alias(name) for c, name in ((0, "legit"), (1, "fraud"))]
    path = scratch_path(rows.sparkSession, "training-run")
    rows.where(learning.features_complete()).observe(seen, *counts).write.parquet(path)
    written = rows.sparkSession.read.schema(rows.schema).parquet(path)
    found = seen.get
    share = found["fraud"] / found["legit"] if 0 < found["fraud"] < found["legit"] else 2.0
    keep = (F.col(label) == 1) | (hash_unit(id_col, sampling.SEED, "sample") < share)
    return written.where(keep), found


def train_run(df: DataFrame, id_col: str, model_path: str, log_path: str, label: str = "Class", train_share: float = 0.7, **forest) -> DataFrame:
    """Train on a part of the rows, judge the rest, save the model and log the run; returns its metrics.

    The row has the rates and areas of ``metrics.evaluate`` on the rest, and how many rows were trained on.
    What is scored is what a loaded model says, so a model that does not survive saving shows.
    """
    split = sampling.random_split(df, id_col, train_share)
    rows, seen = balanced_rows(split.where("split = 'train'").drop("split"), id_col, label)
    model = learning.train(rows, id_col, balance=False, label=label, **forest)
    learning.save_model(model, model_path)
    rest = split.where("split = 'test'").drop("split").where(learning.features_complete())
    found = metrics.evaluate(learning.score(learning.load_model(model_path), rest))
    # One row: kept, so that the log and the result are of the same evaluation.
    measured = df.sparkSession.createDataFrame(found.collect(), found.schema)
    runlog.append_run(measured, log_path, "training", legit_rows=seen["legit"], fraud_rows=seen["fraud"])
    return measured.withColumns({"legit_rows": F.lit(seen["legit"]), "fraud_rows": F.lit(seen["fraud"])})
