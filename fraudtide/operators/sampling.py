"""Repeatable undersampling and train / validation / test splits.

Every split is a column computed from the row itself, a few scalars and a row per class, so
labelling the rows does not move them and a majority class of any size stays spread over all tasks.
Row ids must be unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudtide.functions.hashing import hash_unit, row_hash
from fraudtide.operators.selection import quantiles, selected

SEED = 42
SPLITS = ("train", "validation", "test")


def undersample(df: DataFrame, id_col: str, label: str = "Class", seed: int = SEED) -> DataFrame:
    """Keep every fraud and about as many legitimate rows, chosen by the row hash.

    The hash is not that of the splits, so it works alike on every part of a split.

    With no fraud, or no majority of legitimate rows, all legitimate rows pass. The fraction
    is a scalar subquery over one counting pass.
    """
    legit = F.count_if(F.col(label) == 0)
    fraud = F.count_if(F.col(label) == 1)
    # Hashes are below 1: a fraction of 2 passes every row, whatever its label.
    fraction = df.agg(
        F.when((fraud > 0) & (legit > fraud), fraud.cast("double") / legit.cast("double"))
        .otherwise(2.0)
        .alias("fraction")
    ).scalar()
    position = hash_unit(id_col, seed, "sample") + F.when(F.col(label) == 0, 0.0).otherwise(1.0)
    return df.where((F.col(label) == 1) | (position < fraction))


def random_split(df: DataFrame, id_col: str, train_share: float = 0.8, seed: int = SEED) -> DataFrame:
    """Add `split`: each row is train with probability ``train_share``, else test."""
    return df.withColumn(
        "split", F.when(hash_unit(id_col, seed) < train_share, "train").otherwise("test")
    )


def _apportioned(counts: DataFrame, size: str, draws: Column, name: str) -> DataFrame:
    """Add ``name``: ``draws`` divided over the classes in proportion to ``size``, largest remainders first.

    One row per class; a class's share is in decimals, so it is exact.
    """
    every = Window.partitionBy()
    product = F.col(size).cast("decimal(19,0)") * draws.cast("decimal(19,0)")
    total = F.sum(size).over(every).cast("decimal(19,0)")
    shared = counts.withColumns({"_whole": F.call_function("div", product, total), "_rest": product % total})
    shared = shared.withColumn("_left", draws - F.sum("_whole").over(every))
    place = F.row_number().over(Window.orderBy(F.desc("_rest"), F.col("grp").cast("string").asc_nulls_first()))
    extra = F.when(place <= F.col("_left"), 1).otherwise(0)
    whole = F.coalesce("_whole", F.lit(0)) + extra
    return shared.withColumn(name, whole).drop("_whole", "_rest", "_left")


def split_sizes(counts: DataFrame, holdout: float = 0.30, test_of_holdout: float = 0.50) -> DataFrame:
    """Add ``train, validation, test`` to ``grp, n``: the sizes of a two-stage stratified split."""
    every = Window.partitionBy()
    held = F.ceil(F.sum("n").over(every) * F.lit(holdout))
    rows = counts.withColumn("_held", held)
    rows = _apportioned(rows, "n", F.sum("n").over(every) - F.col("_held"), "train")
    rows = rows.withColumn("_over", F.col("n") - F.col("train"))
    rows = _apportioned(rows, "_over", F.col("_held") - F.ceil(F.col("_held") * F.lit(test_of_holdout)), "validation")
    return rows.withColumn("test", F.col("_over") - F.col("validation")).drop("_held", "_over")


def stratified_split(
    df: DataFrame,
    id_col: str,
    label: str = "Class",
    holdout: float = 0.30,
    test_of_holdout: float = 0.50,
    seed: int = SEED,
) -> DataFrame:
    """Add `split` with exact per-class sizes: the rows with the lowest hashes are train.

    The hash, and the id among equal hashes, at each cut is an order statistic of the class, found
    without ranking or moving the class's rows. Any number of classes; a null label is a class.
    """
    place = F.struct(row_hash(id_col, seed).alias("hash"), F.col(id_col).alias("id"))
    keyed = df.select(F.col(label).alias("grp"), F.lit("").alias("name"), place.alias("value"))
    keyed = keyed.withColumn("key", F.col("value.hash")).where("key IS NOT NULL")

    def wanted(sizes: DataFrame) -> DataFrame:
        ends = split_sizes(sizes, holdout, test_of_holdout)
        last = F.posexplode(F.array(F.col("train") - 1, F.col("train") + F.col("validation") - 1)).alias("id", "rank")
        return ends.select("*", last).where("rank >= 0").withColumn("ranks", F.array("rank"))

    found = selected(keyed, wanted)
    last = [F.max(F.when(F.col("id") == i, F.col("value"))).alias(f"_last{i}") for i in (0, 1)]
    cuts = found.groupBy(F.col("grp").alias("_grp")).agg(*last)
    split = F.when(place <= F.col("_last0"), "train").when(place <= F.col("_last1"), "validation").otherwise("test")
    labelled = df.join(cuts, df[label].eqNullSafe(F.col("_grp")), "left")
    return labelled.select(*df.columns, split.alias("split"))


def approximate_stratified_split(
    df: DataFrame, id_col: str, shares: tuple[float, float] = (0.70, 0.15), seed: int = SEED
) -> DataFrame:
    """Add `split` by hash threshold alone: proportions hold per class in expectation."""
    unit = F.col("_unit")
    split = F.when(unit < shares[0], "train").when(unit < shares[0] + shares[1], "validation").otherwise("test")
    return df.withColumn("_unit", hash_unit(id_col, seed)).withColumn("split", split).drop("_unit")


def temporal_split(
    df: DataFrame,
    time_col: str = "event_time",
    shares: tuple[float, float] = (0.70, 0.15),
    exact: bool = True,
) -> DataFrame:
    """Add `split` in time order: the earliest rows train, the latest test.

    Cut points are exact quantiles of time, or one ``percentile_approx`` pass.
    """
    micros = df.select(F.unix_micros(time_col).alias("_micros"))
    probabilities = [shares[0], shares[0] + shares[1]]
    if exact:
        found = quantiles(micros, ["_micros"], probabilities)
        cuts = [found.agg(F.max(F.when(F.col("id") == i, F.floor("quantile")))).scalar() for i in (0, 1)]
    else:
        both = micros.agg(F.percentile_approx("_micros", probabilities, 10_000).alias("cuts"))
        cuts = [both.select(F.get("cuts", F.lit(i))).scalar() for i in (0, 1)]
    at = F.unix_micros(time_col)
    return df.withColumn(
        "split", F.when(at <= cuts[0], "train").when(at <= cuts[1], "validation").when(at.isNotNull(), "test")
    )
