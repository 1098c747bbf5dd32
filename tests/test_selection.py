"""Order statistics and everything cut by them, against brute force."""

import math
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudtide.operators import profile, sampling, selection
from fraudtide.operators.selection import quantiles, selected

QUARTILES = [0.0, 0.25, 0.5, 0.75, 1.0]


def found(df, columns, probabilities, by=None):
    return {(r.grp, r.name, r.id): r.quantile for r in quantiles(df, columns, probabilities, by).collect()}


def at_ranks(df, ranks):
    """The rows found at ranks of one column, all of them in one group."""
    values = df.select(F.lit(None).cast("int").alias("grp"), F.lit("v").alias("name"), F.col("v").alias("key"), F.col("v").alias("value"))
    rows = selected(values, lambda sizes: sizes.select("*", F.posexplode(F.lit(ranks)).alias("id", "rank")).withColumn("ranks", F.array("rank")))
    return {r["rank"]: (r["value"], r["below"], r["equal"]) for r in rows.collect()}


def test_quantiles_of_skewed_values_with_heavy_ties(spark):
    """A third of the rows is one value; infinities are values, nulls and NaN are not."""
    rng = np.random.default_rng(7)
    values = np.concatenate([np.full(1_000, 20.0), rng.exponential(88.0, 1_000), rng.normal(20, 1e-6, 1_000), [np.inf, -np.inf]])
    groups = rng.integers(0, 2, values.size)
    rows = [(int(g), float(v)) for g, v in zip(groups, values)] + [(0, None), (1, float("nan")), (2, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = found(df, ["v"], QUARTILES[1:-1], "g")
    assert {key[0] for key in got} == {0, 1}
    for g in (0, 1):
        want = np.quantile(values[groups == g], QUARTILES[1:-1])
        assert [got[g, "v", i] for i in range(3)] == pytest.approx(want, rel=1e-12)


def test_fifteen_hundred_groups_of_decimals_doubles_and_bigints(spark):
    """Against DuckDB: a null group, groups of one value, decimals beyond the precision of doubles."""
    import duckdb

    rows = spark.range(40_000).select(
        F.when(F.col("id") % 1501 > 0, F.col("id") % 1501).alias("g"),
        (F.pmod(F.xxhash64("id"), F.lit(10**9)).cast("decimal(20,0)") * F.lit(Decimal("1000000000.000001"))).cast("decimal(30,6)").alias("d"),
        F.pmod(F.xxhash64("id"), F.lit(97)).cast("double").alias("x"),
        F.xxhash64("id").alias("b"),
    )
    con = duckdb.connect()
    con.register("numbers", rows.toArrow())
    for column in "dxb":
        sql = f"SELECT g, quantile_cont({column}::DOUBLE, [0.25, 0.5, 0.9]) FROM numbers GROUP BY g"
        want = {(g, column, i): q for g, qs in con.execute(sql).fetchall() for i, q in enumerate(qs)}
        assert len(want) == 3 * 1501
        got = found(rows, [column], [0.25, 0.5, 0.9], "g")
        assert got.keys() == want.keys()
        assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-6) for k in want)


def test_many_groups(spark):
    rows = spark.range(30_000).select((F.col("id") % 1_700).alias("g"), F.col("id").cast("double").alias("v"))
    got = found(rows, ["v"], [0.5], "g")
    values = np.arange(30_000)
    assert got == {(g, "v", 0): float(np.median(values[values % 1_700 == g])) for g in range(1_700)}


def test_rows_below_and_equal(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 2, 2, 5, 9] * 50], "v bigint")
    assert at_ranks(df, [0, 60, 299]) == {0: (1, 0, 50), 60: (2, 50, 150), 299: (9, 250, 50)}


def test_bigints_beyond_double_precision(spark):
    values = [2**62 + i for i in range(300)] + [2**62 + 1000] * 100
    got = at_ranks(spark.createDataFrame([(v,) for v in values], "v bigint"), [0, 7, 299, 350])
    assert {rank: row[0] for rank, row in got.items()} == {0: 2**62, 7: 2**62 + 7, 299: 2**62 + 299, 350: 2**62 + 1000}


def test_sketches_that_are_far_off_cost_a_pass_only(spark, monkeypatch):
    """A sketch of eight values and no slack misses most ranks."""
    monkeypatch.setattr(selection, "SKETCH", 8)
    monkeypatch.setattr(selection, "SLACK", 0)
    df = spark.range(20_000).select((F.pmod(F.xxhash64("id"), F.lit(9_999_991))).cast("bigint").alias("v"))
    ordered = sorted(r.v for r in df.collect())
    ranks = [0, 11, 5_000, 9_999, 15_123, 19_999]
    assert {rank: row[0] for rank, row in at_ranks(df, ranks).items()} == {rank: ordered[rank] for rank in ranks}


def test_quantiles_of_nothing(spark):
    assert found(spark.createDataFrame([(None,)], "v double"), ["v"], [0.5]) == {}
    with pytest.raises(TypeError):
        quantiles(spark.createDataFrame([("a",)], "v string"), ["v"], [0.5])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=25))
def test_every_rank_of_small_lists(spark, values):
    got = at_ranks(spark.createDataFrame([(v,) for v in values], "v bigint"), list(range(len(values))))
    assert [got[i][0] for i in range(len(values))] == sorted(values)


def test_describe_has_a_row_for_every_class(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 4.0), (None, 7.0), (3, None)], "Class int, Amount double")
    rows = {r["Class"]: (r["count"], r["p25"], r["p50"], r["p75"]) for r in profile.describe_by_class(df).collect()}
    assert rows == {1: (2, 2.5, 3.0, 3.5), None: (1, 7.0, 7.0, 7.0), 3: (0, None, None, None)}


def _labelled(spark, n=4_000, every=37):
    return spark.range(n).select(
        F.col("id").alias("event_id"), (F.col("id") % every == 0).cast("int").alias("Class")
    )


def _sizes(split):
    return {(r["Class"], r["split"]): r["count"] for r in split.groupBy("Class", "split").count().collect()}


def apportion(counts, draws):
    """``draws`` in proportion to ``counts``, largest remainders first."""
    total = sum(counts.values())
    result = {g: n * draws // total for g, n in counts.items()}
    by_remainder = sorted(counts, key=lambda g: (-(counts[g] * draws % total), str(g)))
    for g in by_remainder[: draws - sum(result.values())]:
        result[g] += 1
    return result


def plain_sizes(counts, holdout=0.30, test_of_holdout=0.50):
    total = sum(counts.values())
    held = math.ceil(holdout * total)
    train = apportion(counts, total - held)
    rest = {g: counts[g] - train[g] for g in counts}
    validation = apportion(rest, held - math.ceil(test_of_holdout * held))
    return {g: (train[g], validation[g], rest[g] - validation[g]) for g in counts}


@pytest.mark.parametrize("counts", [{0: 284_315, 1: 492}, {g: 1 + g * g % 91 for g in range(300)}, {0: 1}, {5: 2, 6: 1}])
def test_split_sizes(spark, counts):
    rows = sampling.split_sizes(spark.createDataFrame(list(counts.items()), "grp int, n long")).collect()
    assert {r.grp: (r.train, r.validation, r.test) for r in rows} == plain_sizes(counts)


def test_split_sizes_of_the_published_data():
    sizes = plain_sizes({0: 284_315, 1: 492})
    assert sum(train for train, _, _ in sizes.values()) == 199_364
    assert sizes[1][0] == 344


def test_stratified_split_is_exact_and_repeatable(spark):
    df = _labelled(spark)
    counts = {r["Class"]: r["count"] for r in df.groupBy("Class").count().collect()}
    expected = plain_sizes(counts)
    labels = []
    for parts in (1, 8):
        split = sampling.stratified_split(df.repartition(parts), "event_id")
        sizes = _sizes(split)
        for g, (train, validation, test) in expected.items():
            assert [sizes[(g, s)] for s in sampling.SPLITS] == [train, validation, test]
        labels.append({r["event_id"]: r["split"] for r in split.collect()})
    assert labels[0] == labels[1]


def test_stratified_split_of_many_classes(spark):
    df = spark.range(20_000).select(F.col("id").alias("event_id"), F.when(F.col("id") > 50, F.col("id") % 1_200).alias("Class"))
    counts = {r["Class"]: r["count"] for r in df.groupBy("Class").count().collect()}
    sizes = _sizes(sampling.stratified_split(df, "event_id"))
    got = {g: tuple(sizes.get((g, s), 0) for s in sampling.SPLITS) for g in counts}
    assert {g: sum(t) for g, t in got.items()} == counts
    assert [sum(t[i] for t in got.values()) for i in range(3)] == [14_000, 3_000, 3_000]
    assert all(abs(t[0] - 0.7 * counts[g]) < 1 for g, t in got.items())


def test_stratified_split_with_colliding_hashes(spark, monkeypatch):
    """Rows that share the hash at a cut are told apart by id."""
    monkeypatch.setattr(sampling, "row_hash", lambda id_col, seed: F.pmod(F.col(id_col), F.lit(3)))
    split = sampling.stratified_split(_labelled(spark), "event_id")
    sizes = _sizes(split)
    for g, (train, validation, test) in plain_sizes({0: 4_000 - 109, 1: 109}).items():
        assert [sizes[(g, s)] for s in sampling.SPLITS] == [train, validation, test]


def test_stratified_split_moves_no_rows(spark):
    """Labelling joins the rows to one row per class where they are."""
    split = sampling.stratified_split(_labelled(spark), "event_id")
    split.collect()
    plan = split._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan.split("BroadcastHashJoin")[0]


def test_tiny_classes(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "event_id bigint, Class int")
    assert sampling.stratified_split(df, "event_id").where("split is null").isEmpty()
    assert sampling.stratified_split(df.where("false"), "event_id").isEmpty()


def test_temporal_split_keeps_order(spark):
    df = spark.range(1_000).select(F.timestamp_seconds("id").alias("event_time"))
    for exact in (True, False):
        split = sampling.temporal_split(df, exact=exact)
        spans = {r["split"]: (r["a"], r["b"]) for r in split.groupBy("split").agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).collect()}
        assert spans["train"][1] < spans["validation"][0] <= spans["validation"][1] < spans["test"][0]
    assert sampling.temporal_split(df.where("false")).isEmpty()


def test_undersample(spark):
    df = _labelled(spark)
    kept = {parts: {r["event_id"] for r in sampling.undersample(df.repartition(parts), "event_id").collect()} for parts in (1, 8)}
    assert kept[1] == kept[8]
    assert 109 + 60 < len(kept[1]) < 109 + 170
    assert sampling.undersample(df, "event_id").where("Class = 1").count() == 109


@pytest.mark.parametrize("label", [0, 1])
def test_undersample_passes_a_single_class(spark, label):
    df = spark.range(50).select(F.col("id").alias("event_id"), F.lit(label).alias("Class"))
    assert sampling.undersample(df, "event_id").count() == 50


def test_random_split_shares(spark):
    split = sampling.random_split(spark.range(5_000).toDF("event_id"), "event_id")
    assert 0.77 < split.where("split = 'train'").count() / 5_000 < 0.83


def test_approximate_split_shares(spark):
    sizes = _sizes(sampling.approximate_stratified_split(_labelled(spark, every=2), "event_id"))
    for label in (0, 1):
        assert sizes[(label, "train")] == pytest.approx(1_400, abs=90)
