"""Audit and descriptive statistics of a labelled transaction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from fraudtide.operators.selection import quantiles


def class_balance(df: DataFrame, label: str = "Class") -> DataFrame:
    """Report rows, rows per class, fraud ratio and legitimate rows per fraud, in one pass."""
    legit = F.count_if(F.col(label) == 0)
    fraud = F.count_if(F.col(label) == 1)
    total = F.count("*")
    return df.agg(
        total.alias("total_rows"),
        legit.alias("legit_count"),
        fraud.alias("fraud_count"),
        (fraud.cast("double") / F.greatest(total, F.lit(1))).alias("fraud_ratio"),
        F.floor(legit / F.greatest(fraud, F.lit(1))).alias("legit_per_fraud"),
    )


def dataset_audit(df: DataFrame, label: str = "Class") -> DataFrame:
    """Report rows, columns, missing values (null or NaN) and class shares, in one pass."""

    def missing(field) -> Column:
        value = F.col(field.name)
        absent = value.isNull()
        if isinstance(field.dataType, (DoubleType, FloatType)):
            absent |= F.isnan(value)
        return F.count_if(absent)

    total = F.count("*")
    fraud = F.count_if(F.col(label) == 1)
    return df.agg(
        total.alias("total_rows"),
        sum((missing(f) for f in df.schema.fields), F.lit(0).cast("bigint")).alias("missing_count"),
        F.count_if(F.col(label) == 0).alias("legit_count"),
        fraud.alias("fraud_count"),
        F.round(F.coalesce(F.try_divide(fraud * 100.0, total), F.lit(0.0)).cast("double"), 4).alias("fraud_percentage"),
    ).select("total_rows", F.lit(len(df.columns)).alias("total_cols"), "missing_count", "legit_count", "fraud_count", "fraud_percentage")


def describe_by_class(df: DataFrame, column: str = "Amount", label: str = "Class") -> DataFrame:
    """Report count, mean, sample deviation, minimum, quartiles and maximum per class, of any number of classes."""
    found = quantiles(df, [column], [0.25, 0.5, 0.75], label)
    names = ["p25", "p50", "p75"]
    quartiles = found.groupBy(F.col("grp").alias("_grp")).agg(
        *[F.max(F.when(F.col("id") == i, F.col("quantile"))).alias(name) for i, name in enumerate(names)]
    )
    stats = df.groupBy(label).agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )
    both = stats.join(quartiles, F.col(label).eqNullSafe(F.col("_grp")), "left")
    return both.select(label, "count", "mean", "std", "min", *names, "max")


def adjusted_skewness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Report the bias-corrected skewness of each column; null below three values."""
    results = []
    for c in columns:
        n = F.count(c).cast("double")
        factor = F.sqrt(n * F.greatest(n - 1, F.lit(0.0)))
        corrected = F.try_divide(F.skewness(c) * factor, n - 2)
        results.append(F.when(n >= 3, corrected).alias(f"{c.lower()}_skewness"))
    return df.agg(*results)
