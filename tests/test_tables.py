"""Dashboards, adaptation, profiles, scaling, sources: golden rows and edge cases."""

import pytest
from pyspark.sql import functions as F

from fraudtide.operators import dashboards, learning, profile, scaling
from fraudtide.operators.adapt import adapt_for_dashboard
from fraudtide.schemas import FEATURE_COLUMNS
from fraudtide.session import scratch_path, session_conf
from fraudtide.sources import catalog, jdbc, kafka, runlog, tables

# Sample rows with answers worked out by hand.
EXPORT = [
    ("2026-07-26 10:28:30", 0.0, 91.76),
    ("2026-07-26 10:28:00", 0.0, 64.23),
    ("2026-07-26 10:27:30", 0.0, 13.11),
    ("2026-07-26 10:27:00", 0.0, 13.11),
    ("2026-07-26 10:17:00", 0.0, 130.01),
    ("2026-07-26 10:16:30", 1.0, 45.25),
    ("2026-07-26 10:16:00", 1.0, 42.98),
    ("2026-07-26 10:15:30", 0.0, 82.36),
    ("2026-07-26 10:09:00", 0.0, 68.12),
    ("2026-07-26 10:08:30", 0.0, 68.12),
]
WINDOWS = [
    ("2026-07-28 08:30:00", 1.0, 149.99),
    ("2026-07-28 08:30:00", 0.0, 25.50),
    ("2026-07-28 08:31:00", 1.0, 1200.00),
    ("2026-07-28 08:31:00", 0.0, 12.99),
    ("2026-07-28 08:32:00", 0.0, 89.00),
]
DASHBOARD = "window_start string, prediction double, Amount double"


def test_golden_export_rows(spark):
    df = spark.createDataFrame(EXPORT, DASHBOARD)
    kpi = dashboards.fraud_kpi(df).first()
    assert kpi["total_fraud_amount_usd"] == pytest.approx(88.23)
    assert kpi["avg_fraud_amount_usd"] == pytest.approx(44.115)
    counts = dashboards.class_counts(df).agg(F.sum("normal_transactions"), F.sum("fraud_transactions"), F.count("*")).first()
    assert tuple(counts) == (8, 2, 10)


def test_golden_windows(spark):
    df = spark.createDataFrame(WINDOWS, DASHBOARD)
    rates = [(r["window_start"][11:16], r["total_tx"], r["fraud_tx"], r["fraud_rate_percentage"]) for r in dashboards.fraud_rate(df).collect()]
    assert rates == [("08:32", 1, 0, 0.0), ("08:31", 2, 1, 50.0), ("08:30", 2, 1, 50.0)]
    kpi = dashboards.fraud_kpi(df).first()
    assert kpi["total_fraud_amount_usd"] == pytest.approx(1349.99)
    assert kpi["total_processed_volume_usd"] == pytest.approx(1477.48)
    assert [r[0][11:16] for r in dashboards.direct_access_top(df, 2).collect()] == ["08:32", "08:31"]
    assert {r[2] for r in dashboards.latency_literal(df).collect()} == {0.42}


def test_no_fraud_at_all(spark):
    kpi = dashboards.fraud_kpi(spark.createDataFrame([("w", 0.0, 5.0)], DASHBOARD)).first()
    assert kpi["avg_fraud_amount_usd"] is None and kpi["total_fraud_amount_usd"] == 0.0


@pytest.mark.parametrize(
    "schema, row, expected",
    [
        ("Class int, avg_amount_1m double, window_start string", (1, 5.0, "w"), ("w", 1.0, 5.0)),
        ("total_amount_1m double, event_timestamp string", (7.0, "t"), ("t", 0.0, 7.0)),
        ("window_start string, prediction double, Amount double, Class int", ("w", 0.0, 3.0, 1), ("w", 0.0, 3.0)),
        ("window_start string", ("w",), ("w", 0.0, 100.0)),
    ],
)
def test_adaptation(spark, schema, row, expected):
    assert tuple(jdbc.mirror_rows(spark.createDataFrame([row], schema)).first()) == expected


def test_adaptation_stamps_rows_without_a_time(spark):
    assert len(adapt_for_dashboard(spark.createDataFrame([(1,)], "x int")).first()["window_start"]) == 19


def test_views_answer_dashboard_sql(spark):
    catalog.publish_views(spark, spark.createDataFrame(WINDOWS, DASHBOARD), location=scratch_path(spark, "db"))
    for name in ("transactions", "global_temp.transactions", "`fraud_lakehouse.transactions`"):
        top = spark.sql(f"SELECT window_start, COUNT(*) AS n FROM {name} GROUP BY window_start ORDER BY window_start DESC LIMIT 10")
        assert [r["n"] for r in top.collect()] == [1, 2, 2]


def test_audit_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0), (float("nan"), 1), (None, 0)], "Amount double, Class int")
    row = profile.dataset_audit(df).first()
    assert (row["missing_count"], row["total_cols"], row["fraud_percentage"]) == (2, 2, 33.3333)
    assert profile.dataset_audit(df.where("false")).first()["fraud_percentage"] == 0.0


def test_balance_without_fraud(spark):
    row = profile.class_balance(spark.createDataFrame([(0,), (0,)], "Class int")).first()
    assert (row["fraud_ratio"], row["legit_per_fraud"]) == (0.0, 2)


def test_skewness_needs_three_values(spark):
    assert profile.adjusted_skewness(spark.createDataFrame([(1.0,), (2.0,)], "a double"), ["a"]).first()[0] is None


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "a double")
    for scaled in (scaling.robust_scale(df, ["a"]), scaling.robust_scale(df, ["a"], exact=False), scaling.standard_scale(df, ["a"])):
        assert {r[1] for r in scaled.collect()} == {0.0}


def test_scales_fit_on_train_apply_to_test(spark):
    train = spark.createDataFrame([(float(v),) for v in range(9)], "a double")
    fitted = scaling.fit_robust(train, ["a"])
    assert scaling.apply_scales(spark.createDataFrame([(8.0,)], "a double"), fitted).first()["scaled_a"] == 1.0


def test_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "Class int")
    assert {tuple(r) for r in scaling.class_weight(df).collect()} == {(0, 1.0), (1, 9.0)}
    assert {tuple(r) for r in scaling.class_weight(df, fraud_weight=290.0).collect()} == {(0, 1.0), (1, 290.0)}


def test_csv_fields_that_do_not_parse_become_null(spark):
    path = scratch_path(spark, "csv")
    spark.createDataFrame([("Time,Amount",), ("1.5,2.5",), ("x,3",)], "value string").coalesce(1).write.text(path)
    rows = tables.scan_csv(spark, path, "Time double, Amount double")
    assert sorted(tuple(r) for r in rows.select(F.coalesce("Time", F.lit(-1.0)), "Amount").collect()) == [(-1.0, 3.0), (1.5, 2.5)]


def test_first_available_may_find_nothing(spark):
    assert tables.scan_first_available(spark, [("delta", "/nowhere"), ("parquet", "/nowhere")]) is None


def test_first_available_passes_over_a_damaged_file(spark):
    bad, good = scratch_path(spark, "bad"), scratch_path(spark, "good")
    spark.createDataFrame([("no parquet",)], "value string").write.text(bad)
    spark.range(3).write.parquet(good)
    found = tables.scan_first_available(spark, [("parquet", f"{bad}/*.txt"), ("parquet", good)])
    assert found.count() == 3


def test_run_log_appends(spark):
    path = scratch_path(spark, "log")
    for f1 in (0.5, 0.6):
        runlog.append_run(spark.createDataFrame([(f1,)], "f1 double"), path, "evaluation", target=10)
    rows = spark.read.schema("phase string, status string, target int, f1 double, timestamp timestamp").json(path).collect()
    assert sorted(r["f1"] for r in rows) == [0.5, 0.6] and all(r["timestamp"] for r in rows)


def test_connection_options():
    source = kafka.source_options("broker:9092", "creditcard-transactions", 500)
    assert source["startingOffsets"] == "earliest" and source["failOnDataLoss"] == "false"
    assert source["maxOffsetsPerTrigger"] == "500"
    assert kafka.publish_options("broker:9092", "t")["kafka.acks"] == "all"
    options = jdbc.jdbc_options("jdbc:x", "transactions", "u", "p", "d", connections=4)
    assert options["numPartitions"] == "4" and options["dbtable"] == "transactions"


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_session_conf_is_put_back(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with session_conf(spark, {key: "3"}):
        assert spark.conf.get(key) == "3"
    assert spark.conf.get(key) == before


def test_incomplete_rows_are_left_out_of_training_but_scored(spark):
    rows = [(i, i % 2, *[float(i % 2 + j) for j in range(30)]) for i in range(40)]
    schema = "id bigint, Class int, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    df = spark.createDataFrame(rows, schema)
    broken = df.limit(1).withColumn("V3", F.lit(None).cast("double"))
    model = learning.train(df.unionByName(broken), "id", balance=False, num_trees=3, max_depth=2)
    scored = learning.score(model, df.unionByName(broken))
    assert scored.count() == 41 and scored.where("score is null or isnan(score)").isEmpty()
    assert scored.where("id > 0 and prediction <> Class").isEmpty()
    path = scratch_path(spark, "model")
    learning.save_model(model, path)
    again = learning.score(learning.load_model(path), df)
    assert again.where("prediction <> Class").isEmpty()
