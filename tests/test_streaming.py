"""Streaming queries against the batch result of the same rows."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fraudtide.functions.events import decode_events, encode_events
from fraudtide.operators import learning, training
from fraudtide.operators.contract import reasons
from fraudtide.operators.window_features import window_features
from fraudtide.plans import dashboard_sql
from fraudtide.plans.registry import _feature_events
from fraudtide.schemas import ALERT, FEATURE_COLUMNS
from fraudtide.session import consumed, scratch_path
from fraudtide.sources import catalog, tables
from fraudtide.streaming import compaction, flows
from fraudtide.streaming.runner import (
    counted_batches,
    late_rows,
    observed,
    read_backlog,
    run_available,
    run_for,
    run_to_end,
    start,
    table_writer,
)
from fraudtide.streaming.state import open_windows

COLUMNS = ["window_start", "window_end", "Class", "tx_count_1m", "total_amount_1m"]


def events(spark, seconds):
    return spark.createDataFrame([(float(s), 10.0, s % 2) for s in seconds], "Time double, Amount double, Class int").withColumn(
        "event_time", F.timestamp_seconds(1_704_067_200 + F.col("Time"))
    )


def append(df, path):
    encode_events(df, clock=F.col("event_time")).select("value").write.mode("append").text(path)


def features(spark, records):
    return flows.features_from_records(spark.readStream.text(records))


def as_set(df):
    return {tuple(r) for r in df.select(*COLUMNS).collect()}


def test_restarts_give_the_batch_result_without_duplicates(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    parts = [range(0, 200), range(200, 201), range(201, 500)]
    for part in parts:
        append(events(spark, part), records)
        run_available(features(spark, records), out, f"{out}-cp")
    everything = window_features(events(spark, range(500)))
    closed = everything.where(F.col("window_end") <= F.timestamp_seconds(F.lit(1_704_067_200 + 499 - 10)))
    got = spark.read.parquet(out)
    assert as_set(got) == as_set(closed)
    assert got.count() == closed.count()
    # Nothing new: a further run adds nothing.
    run_available(features(spark, records), out, f"{out}-cp")
    assert spark.read.parquet(out).count() == closed.count()


def test_late_rows_are_dropped_and_counted(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    append(events(spark, range(600, 900)), records)
    assert late_rows(run_available(features(spark, records), out, f"{out}-cp")) == 0
    append(events(spark, [5]), records)
    assert late_rows(run_available(features(spark, records), out, f"{out}-cp")) == 2
    assert spark.read.parquet(out).where("window_end < '2024-01-01 00:09:30'").isEmpty()


def test_untimed_records_are_counted(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    append(events(spark, range(30)), records)
    spark.createDataFrame([("{bad",), ('{"event_timestamp": "soon"}',)], "value string").write.mode("append").text(records)
    progress = run_available(features(spark, records), out, f"{out}-cp")
    assert (observed(progress, flows.DECODED, "records"), observed(progress, flows.DECODED, "untimed")) == (32, 2)


def test_consumed_data_is_deleted(spark):
    with consumed(spark, "in") as path:
        append(events(spark, range(3)), path)
        assert spark.read.text(path).count() == 3
    assert tables.scan_first_available(spark, [("text", path)]) is None


def test_sliding_windows_hold_each_event_twice(spark):
    counted = window_features(events(spark, range(777))).agg(F.sum("tx_count_1m")).first()[0]
    assert counted == 2 * 777
    assert window_features(events(spark, range(777)), slide=None).agg(F.sum("tx_count_1m")).first()[0] == 777


def test_windows_do_not_depend_on_partitioning(spark):
    results = [as_set(window_features(events(spark, range(300)).repartition(n))) for n in (1, 4, 8)]
    assert results[0] == results[1] == results[2]


def test_routing_keeps_every_record(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    append(events(spark, range(20)), records)
    spark.createDataFrame([("{bad",), ('{"Time": 1}',)], "value string").write.mode("append").text(records)
    run_available(flows.routed_records(spark.readStream.text(records)), out, f"{out}-cp", by=["route"])
    routed = spark.read.parquet(out)
    counts = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
    assert counts == {"accepted": 20, "quarantined": 2}
    assert routed.where("route = 'quarantined' and value is not null").count() == 2


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return learning.train(_feature_events(spark, sf_dir), "vec_id", num_trees=5, max_depth=4)


def test_stream_alerts_equal_batch_scoring(spark, sf_dir, model):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "alerts")
    append(_feature_events(spark, sf_dir), records)
    spark.createDataFrame([("{bad",)], "value string").write.mode("append").text(records)
    run_available(flows.alerts_from_records(spark.readStream.text(records), model), out, f"{out}-cp")
    scored = learning.score(model, decode_events(spark.read.text(records).where("value <> '{bad'")))
    batch = learning.encode_alerts(learning.fraud_alerts(scored))
    got = {tuple(r) for r in spark.read.parquet(out).select("key", "value").collect()}
    assert got == {tuple(r) for r in batch.collect()} and got


def test_scored_stream_keeps_every_row_and_its_latency(spark, sf_dir, model):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "scored")
    rows = _feature_events(spark, sf_dir)
    append(rows, records)
    run_available(flows.scored_from_records(spark.readStream.text(records), model), out, f"{out}-cp")
    got = spark.read.parquet(out)
    assert got.count() == rows.count()
    assert got.where("ingest_time <= event_time or score is null").isEmpty()


def test_bounded_run_stops(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    append(events(spark, range(5)), records)
    stream = decode_events(spark.readStream.text(records)).select("event_time", "Amount")
    query = start(table_writer(stream), f"{out}-cp", out, every="1 seconds")
    run_for(query, 8)
    assert not query.isActive
    assert spark.read.parquet(out).count() == 5


def test_a_backlog_comes_in_batches_and_its_open_windows_stay_in_the_state(spark):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for start_at in (0, 300, 600):
        append(events(spark, range(start_at, start_at + 300)).coalesce(1), records)
    backlog = flows.features_from_records(read_backlog(spark, records, files=1), watermark="1 minute")
    progress = run_available(backlog, out, f"{out}-cp")
    assert sum(p["numInputRows"] > 0 for p in progress) == 3
    everything = as_set(window_features(events(spark, range(900))))
    closed, still_open = as_set(spark.read.parquet(out)), as_set(open_windows(spark, f"{out}-cp"))
    assert closed | still_open == everything and not closed & still_open and still_open
    # As of the first batch the state knows nothing of what came later.
    early = open_windows(spark, f"{out}-cp", batch=0)
    assert early.agg(F.max("window_end")).first()[0] <= early.select(F.timestamp_seconds(F.lit(1_704_067_200 + 360))).first()[0]


def test_a_listener_counts_what_a_scoring_stream_rejects(spark, sf_dir, model):
    records, out = scratch_path(spark, "in"), scratch_path(spark, "judged")
    rows = _feature_events(spark, sf_dir).limit(40)
    append(rows.coalesce(1), records)
    append(rows.withColumn("V7", F.lit(None).cast("double")).limit(7).coalesce(1), records)
    spark.createDataFrame([("{bad",), ("",), ('{"Time": 1}',)], "value string").coalesce(1).write.mode("append").text(records)
    scored = flows.scored_from_records(read_backlog(spark, records, files=1), model)
    with counted_batches(spark) as counts:
        run_available(scored, out, f"{out}-cp")
    found = {name: counts.total(flows.SCORING, name) for name in ["records", "scored", *reasons(features=FEATURE_COLUMNS)]}
    assert {k: n for k, n in found.items() if n} == {"records": 50, "scored": 40, "no_number:V7": 7, "malformed_json": 2, "missing:event_timestamp": 1}
    assert len([b for b in counts.batches if b["numInputRows"]]) == 3
    assert spark.read.parquet(out).count() == 40


def test_compaction_bounds_files_and_changes_nothing_when_repeated(spark):
    records, raw, target = (scratch_path(spark, n) for n in ("in", "raw", "days"))
    for day in range(3):
        append(events(spark, range(86_400 * day, 86_400 * day + 4_000, 7)).repartition(4), records)
    features = flows.features_from_records(read_backlog(spark, records, files=2), watermark="1 day")
    run_to_end(compaction.batch_writer(features, raw, ["window_start"], files=3), f"{raw}-cp")
    before = spark.read.parquet(raw).drop("batch")
    listed = []
    for _ in range(2):
        compaction.compact(spark, raw, target, F.to_date("window_start"), ["window_start"], files=2)
        after = spark.read.parquet(target).drop("day")
        assert after.exceptAll(before).isEmpty() and before.exceptAll(after).isEmpty()
        listed.append(sorted(map(tuple, compaction.files_by_day(spark, target).collect())))
    assert listed[0] == listed[1] and all(files <= 2 for _, files, _ in listed[0])


def test_alerts_of_one_instant_have_ids_of_their_own(spark):
    rows = [("2024-01-01T00:00:00Z", 1.0, amount, 1.0, 1) for amount in (5.0, 6.0, 6.0)]
    alerts = learning.encode_alerts(spark.createDataFrame(rows, ALERT)).collect()
    assert len({r.key for r in alerts}) == 1 and len({r.value for r in alerts}) == 2
    assert all('"alert_id":"' in r.value for r in alerts)


def test_models_score_in_sessions_that_observe(spark, sf_dir):
    """A model with its training's summary would drag the session into every task."""
    seen = Observation()
    spark.range(5).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 5
    rows = _feature_events(spark, sf_dir)
    assert learning.score(learning.train(rows, "vec_id", num_trees=3, max_depth=3), rows).count() == rows.count()


def test_a_training_run_is_saved_and_logged(spark, sf_dir):
    saved, log = scratch_path(spark, "model"), scratch_path(spark, "log")
    rows = _feature_events(spark, sf_dir)
    for _ in range(2):
        run = training.train_run(rows, "vec_id", saved, log, num_trees=5, max_depth=4).first()
    logged = spark.read.json(log).collect()
    assert [(r.phase, r.legit_rows, r.fraud_rows, r.roc_auc) for r in logged] == [("training", run.legit_rows, run.fraud_rows, run.roc_auc)] * 2
    assert learning.score(learning.load_model(saved), rows).count() == rows.count()


def test_statements_take_values_as_parameters(spark):
    rows = spark.createDataFrame([(f"w{i}", float(i % 2), 10.0 * i) for i in range(9)], "window_start string, prediction double, Amount double")
    catalog.publish_views(spark, rows, location=scratch_path(spark, "database"))
    assert [r.window_start for r in dashboard_sql.statement(spark, "direct_access", latest=2).collect()] == ["w8", "w7"]
    kpi = dashboard_sql.statement(spark, "fraud_kpi").first()
    assert (kpi.total_fraud_amount_usd, kpi.avg_fraud_amount_usd, kpi.total_processed_volume_usd) == (160.0, 40.0, 360.0)
    with pytest.raises(Exception, match="LIMIT|limit|INT"):
        dashboard_sql.statement(spark, "direct_access", latest="2; DROP VIEW transactions").collect()
