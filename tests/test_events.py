"""Encoding, decoding and validation of events, including broken ones."""

import json

import pytest
from pyspark.sql import functions as F

from fraudtide.functions.events import decode_events, encode_events, first_events, message_key
from fraudtide.operators.contract import accepted, quarantined, validate_contract
from fraudtide.schemas import FEATURE_COLUMNS

GOOD = {"event_timestamp": "2026-07-24T10:23:45.123456Z", "Time": 406.0, "Amount": 149.62, "Class": 0}


def record(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "absent"})


CASES = [
    (record(), None),
    (record(V1=1.5, unknown="ignored"), None),
    ("{bad", "malformed_json"),
    ("", "malformed_json"),
    (None, "malformed_json"),
    (record(Amount="absent"), "missing:Amount"),
    (record(Amount=None), "missing:Amount"),
    (record(Amount="12.5"), "type:Amount"),
    (record(Class=1.0), None),
    (record(Class=1.5), "type:Class"),
    (record(Class="1"), "type:Class"),
    (record(Class=True), "type:Class"),
    (record(event_timestamp="absent"), "missing:event_timestamp"),
    (record(event_timestamp="yesterday"), "bad_timestamp"),
    (record(event_timestamp=2024), "bad_timestamp"),
    (record(Time=7), None),
]


def test_contract(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "i int, value string")
    checked = validate_contract(df, passthrough=["i"])
    found = {r["i"]: r["reject_reason"] for r in checked.collect()}
    assert found == {i: reason for i, (_, reason) in enumerate(CASES)}
    assert accepted(checked).count() == 4 and quarantined(checked).count() == len(CASES) - 4


def test_missing_feature_is_rejected_for_scoring(spark):
    full = {f"V{i}": 0.5 for i in range(1, 29)}
    rows = [(record(**full),), (record(**{**full, "V3": None}),)]
    checked = validate_contract(spark.createDataFrame(rows, "value string"), features=FEATURE_COLUMNS)
    assert sorted(r["reject_reason"] or "" for r in checked.collect()) == ["", "no_number:V3"]


def test_round_trip_keeps_microseconds(spark):
    df = spark.createDataFrame([(406.9, 149.62, 1)], "Time double, Amount double, Class int").withColumn(
        "at", F.lit("2026-07-24 10:23:45.000001").cast("timestamp")
    )
    sent = encode_events(df, clock=F.col("at"))
    assert sent.first()["key"] == "tx_406"
    back = decode_events(sent).first()
    assert back["event_timestamp"] == "2026-07-24T10:23:45.000001Z"
    assert back["event_time"].microsecond == 1 and (back["Amount"], back["Class"]) == (149.62, 1)


def test_live_clock_and_binary_value(spark):
    sent = encode_events(spark.createDataFrame([(1.0, 2.0, 0)], "Time double, Amount double, Class int"))
    binary = sent.select(F.col("value").cast("binary").alias("value"))
    assert decode_events(binary).where("event_time > current_timestamp() - interval 1 hour").count() == 1


@pytest.mark.parametrize("time, key", [(-1.9, "tx_-1"), (1.9, "tx_1"), (None, "tx_8")])
def test_key_truncates_or_falls_back(spark, time, key):
    df = spark.createDataFrame([(8, time)], "id bigint, Time double")
    assert df.select(message_key(fallback_id="id")).first()[0] == key


def test_first_events(spark):
    df = spark.range(100).select(F.timestamp_seconds(100 - F.col("id")).alias("event_time"), "id")
    assert {r["id"] for r in first_events(df, 3, id_col="id").collect()} == {99, 98, 97}
