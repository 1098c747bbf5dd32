"""Inputs that are easy to get wrong: other cases and orders of names, nulls, decimals, infinities."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fraudtide.operators import adapt, clustering, metrics, sampling
from fraudtide.operators.selection import quantiles
from fraudtide.sources import tables


@pytest.fixture(scope="module")
def labelled(spark):
    rows = spark.range(40_000).withColumn("Class", (F.pmod(F.xxhash64("id"), F.lit(50)) == 0).cast("int"))
    return rows.withColumnRenamed("id", "event_id").cache()


def test_undersampling_works_alike_on_every_part_of_a_split(labelled):
    for split in (sampling.random_split(labelled, "event_id"), sampling.stratified_split(labelled, "event_id")):
        for (part,) in split.select("split").distinct().collect():
            kept = sampling.undersample(split.where(F.col("split") == part), "event_id")
            legit, fraud = kept.agg(F.count_if(F.col("Class") == 0), F.count_if(F.col("Class") == 1)).first()
            assert abs(legit - fraud) < 5 * fraud**0.5


def test_names_in_another_case_are_not_overwritten(spark):
    df = spark.createDataFrame([(5.0, 1)], "amount double, class int")
    adapted = adapt.adapt_for_dashboard(df)
    assert "Amount" in adapted.columns
    row = adapted.first()
    assert (row["Amount"], row["prediction"]) == (5.0, 1.0)


def test_csv_goes_by_its_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Amount,extra,time\n2.5,x,1.0\n3.5,y,2.0\n")
    rows = tables.scan_csv(spark, str(tmp_path), "Time double, Amount double, V1 double")
    assert sorted(map(tuple, rows.collect())) == [(1.0, 2.5, None), (2.0, 3.5, None)]


def test_null_scores_count_alike_whatever_the_number_of_ranges(spark):
    rows = [(i / 700 if i % 10 else None, i * 7919 % 3 == 0, 0.0) for i in range(700)]
    df = spark.createDataFrame(rows, "score double, positive boolean, prediction double")
    scored = df.withColumn("Class", F.col("positive").cast("int"))
    areas = {metrics.roc_auc(scored, rows_per_range=n).first()[0] for n in (1_000_000, 100, 7)}
    assert max(areas) - min(areas) < 1e-12
    counted = [metrics.curve(metrics.score_counts(scored), n).agg(F.sum("tp") + F.sum("fp")).first()[0] for n in (1_000_000, 50)]
    assert counted == [700, 700]


def test_quartiles_of_decimals(spark):
    df = spark.createDataFrame([(Decimal(i) / 4,) for i in range(101)], "x decimal(12,4)")
    assert sorted(r.quantile for r in quantiles(df, ["x"], [0.25, 0.5]).collect()) == [6.25, 12.5]


def test_z_order_of_what_is_not_finite_and_of_maps(spark):
    rows = [(float(v), i % 5, {"k": i}) for i, v in enumerate(["nan", "inf", "-inf", *range(97)] * 3)] + [(None, None, None)]
    df = spark.createDataFrame(rows, "a double, b int, m map<string,int>")
    assert clustering.clustered(df, ["a", "b"], 4).count() == len(rows)
    assert clustering.clustered(df, ["a"], 4).count() == len(rows)
    with pytest.raises(ValueError):
        clustering.clustered(df, ["a"] * 64)


def test_more_columns_take_fewer_bits_each(spark):
    df = spark.range(500).select(*[(F.col("id") * (i + 3) % 101).alias(f"c{i}") for i in range(9)])
    assert clustering.clustered(df, df.columns, 3).count() == 500
