"""Column scaling and class weights. Fitting returns scalars, applying them is a projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudtide.operators.selection import quantiles

FRAUD_WEIGHT = 290.0  # fixed class weight of a fraud in the published cost-sensitive setting


@dataclass(frozen=True)
class Scale:
    """A column's centre and width; a width of zero leaves differences as they are."""

    centre: float | None
    width: float | None


def fit_robust(df: DataFrame, columns: list[str], exact: bool = True) -> dict[str, Scale]:
    """Fit median and interquartile range, exactly or in one ``percentile_approx`` pass."""
    probabilities = [0.25, 0.5, 0.75]
    if exact:
        # Three rows a column.
        found = {(r["name"], r["id"]): r["quantile"] for r in quantiles(df, columns, probabilities).collect()}
        quartiles = {c: [found.get((c, i)) for i in range(3)] for c in columns}
    else:
        row = df.agg(*[F.percentile_approx(c, probabilities, 10_000).alias(c) for c in columns]).first()
        quartiles = {c: row[c] or [None] * 3 for c in columns}
    return {
        c: Scale(q50, None if q50 is None else (q75 - q25) or 1.0)
        for c, (q25, q50, q75) in quartiles.items()
    }


def fit_standard(df: DataFrame, columns: list[str]) -> dict[str, Scale]:
    """Fit mean and sample deviation of all columns in one pass."""
    row = df.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"s_{c}") for c in columns]
    ).first()
    return {c: Scale(row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def apply_scales(df: DataFrame, scales: dict[str, Scale], prefix: str = "scaled_") -> DataFrame:
    """Add one scaled column per entry. A constant column scales to zero."""

    def scaled(name: str, scale: Scale):
        if scale.centre is None:
            return F.lit(None).cast("double")
        return (F.col(name) - F.lit(float(scale.centre))) / F.lit(float(scale.width or 1.0))

    return df.withColumns({f"{prefix}{c.lower()}": scaled(c, s) for c, s in scales.items()})


def robust_scale(df: DataFrame, columns: list[str], exact: bool = True) -> DataFrame:
    return apply_scales(df, fit_robust(df, columns, exact))


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    return apply_scales(df, fit_standard(df, columns), prefix="standard_")


def class_weight(df: DataFrame, label: str = "Class", fraud_weight: float | None = None) -> DataFrame:
    """Add `class_weight`: 1 for legitimate rows, ``fraud_weight`` for frauds.

    The default weight balances the classes: legitimate rows per fraud.
    """
    if fraud_weight is not None:
        weight = F.lit(float(fraud_weight))
    else:
        legit = F.count_if(F.col(label) == 0).cast("double")
        fraud = F.count_if(F.col(label) == 1)
        weight = df.agg((legit / F.greatest(fraud, F.lit(1))).alias("weight")).scalar()
    return df.withColumn("class_weight", F.when(F.col(label) == 1, weight).otherwise(F.lit(1.0)))
