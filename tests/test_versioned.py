"""Versioned tables on Parquet folders."""

import pytest
from pyspark.sql import functions as F

from fraudtide.operators import clustering, versioned
from fraudtide.session import scratch_path

# Sample rows of the three appends.
SCHEMA = "Amount double, V1 double, V2 double, Class int, event_timestamp string"
FIRST = [
    (100.50, -1.35, 0.42, 0, "2026-07-24T10:00:00Z"),
    (2500.00, 2.10, -0.85, 1, "2026-07-24T10:00:05Z"),
    (12.99, 0.05, 0.12, 0, "2026-07-24T10:00:10Z"),
]
SECOND = [(500.00, -0.50, 1.20, 0, "2026-07-24T10:05:00Z")]
EVOLVED = [(99.00, 0.1, 0.2, 0, "2026-07-24T10:15:00Z", "checked")]


@pytest.fixture
def path(spark):
    target = scratch_path(spark, "versioned")
    assert versioned.append_version(spark.createDataFrame(FIRST, SCHEMA), target) == 0
    assert versioned.append_version(spark.createDataFrame(SECOND, SCHEMA), target) == 1
    return target


def amounts(df):
    return sorted(r["Amount"] for r in df.collect())


def test_time_travel(spark, path):
    assert amounts(versioned.read_version(spark, path, 0)) == [12.99, 100.5, 2500.0]
    assert amounts(versioned.read_version(spark, path, 1)) == amounts(versioned.read_version(spark, path))
    assert versioned.read_version(spark, path).count() == 4
    with pytest.raises(versioned.UnknownVersion):
        versioned.read_version(spark, path, 2)


def test_later_versions_are_not_read(spark, path):
    assert all("_version=0" in f for f in versioned.read_version(spark, path, 0).inputFiles())


def test_enforcement(spark, path):
    bad = spark.createDataFrame([("INVALID", 1.0, 2.0, 0, "t", "x")], SCHEMA.replace("Amount double", "Amount string") + ", unexpected string")
    with pytest.raises(versioned.SchemaMismatch, match="Amount.*unexpected"):
        versioned.append_version(bad, path)
    assert versioned.read_version(spark, path).count() == 4


def test_evolution(spark, path):
    wider = spark.createDataFrame(EVOLVED, SCHEMA + ", device_class string")
    with pytest.raises(versioned.SchemaMismatch):
        versioned.append_version(wider, path)
    assert versioned.append_version(wider, path, merge_schema=True) == 2
    latest = versioned.read_version(spark, path)
    assert latest.count() == 5
    assert latest.where("device_class is null").count() == 4
    assert "device_class" not in versioned.read_version(spark, path, 1).columns
    # A later append without the new column still fits.
    versioned.append_version(spark.createDataFrame(SECOND, SCHEMA), path)
    assert versioned.read_version(spark, path).where("device_class is null").count() == 5


def test_failed_append_shows_nothing(spark, path):
    rows = spark.createDataFrame(FIRST, SCHEMA)
    failing = rows.withColumn("V1", F.when(F.col("Class") == 1, F.raise_error(F.lit("no")).cast("double")).otherwise(F.col("V1")))
    with pytest.raises(Exception):
        versioned.append_version(failing.repartition(3), path)
    assert versioned.read_version(spark, path).count() == 4
    number = versioned.append_version(rows, path)
    assert number > 1 and versioned.read_version(spark, path).count() == 7


def test_empty_append_is_a_version(spark, path):
    versioned.append_version(spark.createDataFrame([], SCHEMA), path)
    assert versioned.versions(spark, path) == [0, 1, 2]
    assert versioned.read_version(spark, path).count() == 4


def test_purge(spark):
    path, purged = scratch_path(spark, "old"), scratch_path(spark, "new")
    for day, rows in (("01", FIRST), ("05", SECOND), ("20", SECOND)):
        versioned.append_version(spark.createDataFrame(rows, SCHEMA), path, committed_at=f"2024-01-{day} 00:00:00")
    assert versioned.purge_history(spark, path, purged, "2024-01-10 00:00:00") == 1
    assert versioned.versions(spark, purged) == [1, 2]
    for v in (1, 2):
        assert amounts(versioned.read_version(spark, purged, v)) == amounts(versioned.read_version(spark, path, v))
    with pytest.raises(versioned.UnknownVersion):
        versioned.read_version(spark, purged, 0)


@pytest.mark.parametrize("columns", [["a"], ["a", "b"]])
def test_clustering_spreads_a_hot_value(spark, columns):
    """A third of the rows has one value of `a`, all of them one of `b`."""
    df = spark.range(3_000).select("id", F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("a"), F.lit(1.0).alias("b"))
    laid = clustering.clustered(df, columns, files=6)
    assert laid.columns == df.columns
    assert laid.exceptAll(df).isEmpty() and df.exceptAll(laid).isEmpty()
    sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 6 and max(sizes) < 1_000


def test_clustered_files_have_narrow_ranges(spark):
    path, target = scratch_path(spark, "flat"), scratch_path(spark, "laid")
    spark.range(1_000).select("id", F.rand(1).alias("a")).write.parquet(path)
    clustering.optimize(spark, path, target, ["a"], files=5)
    spans = spark.read.parquet(target).groupBy(F.input_file_name()).agg(F.max("a") - F.min("a")).collect()
    assert len(spans) == 5 and max(r[1] for r in spans) < 0.4
