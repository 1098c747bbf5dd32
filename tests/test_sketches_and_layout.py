"""Sketches that are merged, and how clustered files lie."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudtide.operators import clustering, sketches


def test_merged_sketches_stay_near_the_ranks(spark):
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.exponential(50, 40_000), np.full(20_000, 7.0), [np.nan]])
    rows = spark.createDataFrame([(float(v), i % 30, i % 2) for i, v in enumerate(values)] + [(None, 1, 1)], "v double, day int, g int")
    kept = sketches.sketched(rows, "v", ["day", "g"])
    assert kept.agg(F.sum("n")).first()[0] == 60_000
    found = sketches.estimates(sketches.merged(kept, ["g"]), [0.0, 0.01, 0.3, 0.5, 0.99, 1.0])
    judged = sketches.rank_errors(rows.where("NOT isnan(v)"), "v", "g", found).collect()
    assert len(judged) == 12 and max(r.error for r in judged) < 0.006
    for g in (0, 1):
        own = values[:-1][np.arange(60_000) % 2 == g]
        ends = {r.p: r.quantile for r in judged if r.g == g}
        assert (ends[0.0], ends[1.0]) == (own.min(), own.max())


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(None, 1), (float("nan"), 1)], "v double, g int")
    assert sketches.estimates(sketches.merged(sketches.sketched(rows, "v", ["g"]), ["g"]), [0.5]).isEmpty()


def test_bits_follow_the_files():
    assert [clustering.bits_for(files, 2) for files in (1, 16, 1_000, 10**6)] == [2, 4, 7, 12]
    assert clustering.bits_for(10**9, 1) == 12 and clustering.bits_for(1, 60) == 1


def test_ranges_by_binary_search(spark):
    ends = [1.0, 2.0, 2.0, 5.5, 9.0, float("inf")]
    rows = spark.createDataFrame([(v,) for v in (None, float("-inf"), 0.0, 1.0, 1.5, 2.0, 5.4, 5.5, 9.0, 1e9, float("nan"))], "v double")
    got = [r[1] for r in clustering._rank_bucket(rows, "v", ends).collect()]
    assert got == [0, 0, 0, 1, 1, 2, 2, 3, 4, 4, 4]
    assert {r[1] for r in clustering._rank_bucket(rows, "v", []).collect()} == {0}


def plain_overlaps(spark, path, column):
    rows = spark.read.parquet(path).select(F.input_file_name().alias("f"), column).groupBy("f").agg(F.min(column), F.max(column)).collect()
    pairs = list(itertools.combinations([(r[1], r[2]) for r in rows], 2))
    return sum(a[0] <= b[1] and b[0] <= a[1] for a, b in pairs), len(pairs)


@pytest.mark.parametrize("columns", [["a"], ["a", "b"]])
def test_layout_counts_overlapping_files(spark, tmp_path, columns):
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    rows = spark.range(20_000).select(F.pmod(F.xxhash64("id"), F.lit(500)).alias("a"), F.rand(2).alias("b"), "id")
    rows.repartition(12).write.parquet(before)
    clustering.optimize(spark, before, after, columns, 12)
    for path in (before, after):
        for r in clustering.layout(spark, path, ["a", "b"]).collect():
            assert (r.overlapping, r.pairs) == plain_overlaps(spark, path, r.column)
            assert r.rows == 20_000 and r.files <= 12
    for r in clustering.layout(spark, after, columns).collect():
        assert r.overlapping <= 0.75 * r.pairs and r.largest_share <= 2 / 12
    assert spark.read.parquet(after).exceptAll(spark.read.parquet(before)).isEmpty()


def test_files_follow_the_stored_bytes(spark, tmp_path):
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    spark.range(50_000).select("id", F.rand(1).alias("x")).repartition(3).write.parquet(before)
    size = clustering.stored_bytes(spark, before)
    clustering.optimize(spark, before, after, ["x"], file_bytes=size // 5 + 1)
    assert clustering.layout(spark, after, ["x"]).first()["files"] == 5


def test_files_follow_the_rows_in_memory(spark, tmp_path, monkeypatch):
    """A table that is stored in next to nothing is still sorted by several tasks."""
    before = str(tmp_path / "before")
    text, items = F.repeat(F.lit("x"), 984), F.when(F.col("id") % 2 == 0, F.array(F.lit(1)))
    spark.range(10_000).select("id", (F.col("id") % 7).alias("a"), text.alias("text"), items.alias("items")).write.parquet(before)
    rows = spark.read.parquet(before)
    assert clustering.row_bytes(rows) == 10_000 * (984 + 5 * 8) + 5_000 * len("[1]")
    assert clustering.row_bytes(rows.limit(0)) == 0
    monkeypatch.setattr(clustering, "TASK_BYTES", 1 << 20)
    for columns in (["id"], ["id", "a"]):
        after = str(tmp_path / "-".join(columns))
        clustering.optimize(spark, before, after, columns)
        laid = clustering.layout(spark, after, ["id"]).first()
        assert laid["files"] == 10 and laid["rows"] == 10_000 and laid["largest_share"] < 0.2
        assert spark.read.parquet(after).exceptAll(rows).isEmpty()
