"""The registered queries as plain SQL over the same tables, for an independent check.

Written for DuckDB. Queries whose result is a trained model's have no entry.
"""

from __future__ import annotations

COMPONENTS = [f"V{i}" for i in range(1, 29)]

TX = """
tx AS (
  SELECT event_id, user_id, ts AS event_time,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
         (epoch_us(ts) - 1704067200000000) / 1e6::DOUBLE AS "Time",
         value AS "Amount",
         CAST(event_type = 'error' AND value > 150 AS INT) AS "Class"
  FROM events)"""

FEATURES = f"""
feat AS (
  SELECT vec_id,
         {", ".join(f'embedding[{i}]::DOUBLE AS "{name}"' for i, name in enumerate(COMPONENTS, 1))},
         abs(embedding[31]::DOUBLE) * 100 AS "Amount", vec_id::DOUBLE AS "Time",
         CAST(label = 0 AS INT) AS "Class"
  FROM embeddings)"""

SCORED = f"""{TX},
scored AS (
  SELECT *, CAST(score >= 0.5 AS DOUBLE) AS prediction
  FROM (SELECT *, floor("Amount" * 1000.0::DOUBLE / ("Amount" + 150.0::DOUBLE)) / 1000.0::DOUBLE AS score FROM tx))"""


def windows(size: str, slide: str, source: str = "tx") -> str:
    """Sliding windows with size = 2 * slide: each row belongs to two of them."""
    return f"""
bucketed AS (SELECT time_bucket(INTERVAL {slide}, event_time) AS b, "Class", "Amount" FROM {source}),
covered AS (
  SELECT b AS window_start, "Class", "Amount" FROM bucketed
  UNION ALL SELECT b - INTERVAL {slide}, "Class", "Amount" FROM bucketed),
wf AS (
  SELECT window_start, window_start + INTERVAL {size} AS window_end, "Class",
         count(*) AS tx_count_1m, sum("Amount") AS total_amount_1m, avg("Amount") AS avg_amount_1m
  FROM covered GROUP BY window_start, "Class")"""


MINUTE = windows("1 MINUTE", "30 SECOND")
DASHBOARD = f"""{TX}, {MINUTE},
dash AS (SELECT window_start, CAST("Class" AS DOUBLE) AS prediction, avg_amount_1m AS "Amount" FROM wf)"""

PLAIN = 'event_id, event_timestamp, "Time", "Amount", "Class"'
CUT = "TIMESTAMP '2024-01-16 00:00:00'"


def row_hash(seed: int | str, id_col: str = "event_id") -> str:
    return f"('0x' || substr(md5('{seed}:' || {id_col}), 1, 13))::BIGINT"


def hash_unit(seed: int | str, id_col: str = "event_id") -> str:
    return f"({row_hash(seed, id_col)}::DOUBLE / {1 << 52}::DOUBLE)"


def ingest_time(run: int) -> str:
    return f"event_time + to_microseconds({row_hash(run)} % 900000 + 100000)"


CURVE = f"""{SCORED},
counts AS (
  SELECT score, sum("Class")::DOUBLE AS tp, sum(1 - "Class")::DOUBLE AS fp FROM scored GROUP BY score),
points AS (
  SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM counts
  WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
precisions AS (
  SELECT *, ctp / (ctp + cfp) AS p,
         lag(ctp / (ctp + cfp)) OVER (ORDER BY score DESC) AS before
  FROM points),
pr AS (SELECT sum(tp * (p + coalesce(before, p)) / 2) / sum(tp) AS pr_auc FROM precisions),
ranked AS (
  SELECT "Class", avg(rn) OVER (PARTITION BY score) AS r
  FROM (SELECT "Class", score, row_number() OVER (ORDER BY score) AS rn FROM scored)),
roc AS (
  SELECT (sum(CASE WHEN "Class" = 1 THEN r END) - p * (p + 1) / 2) / (p * n) AS roc_auc
  FROM ranked, (SELECT sum("Class")::DOUBLE AS p, sum(1 - "Class")::DOUBLE AS n FROM scored) GROUP BY p, n)"""

RATES = """
cells AS (
  SELECT count(*) FILTER ("Class" = 1 AND prediction = 1) AS tp,
         count(*) FILTER ("Class" = 0 AND prediction = 1) AS fp,
         count(*) FILTER ("Class" = 1 AND prediction = 0) AS fn,
         count(*) FILTER ("Class" = 0 AND prediction = 0) AS tn
  FROM scored),
per_class AS (
  SELECT *, coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS p1, coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS r1,
         coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p0, coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r0
  FROM cells),
f AS (
  SELECT *, coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0) AS f1, coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0) AS f0,
         (tp + fn)::DOUBLE AS n1, (tn + fp)::DOUBLE AS n0
  FROM per_class),
rates AS (
  SELECT tp AS true_positives, fp AS false_positives, fn AS false_negatives, tn AS true_negatives,
         (n1 * p1 + n0 * p0) / (n1 + n0) AS precision, (n1 * r1 + n0 * r0) / (n1 + n0) AS recall,
         (n1 * f1 + n0 * f0) / (n1 + n0) AS f1_score,
         p1 AS fraud_precision, r1 AS fraud_recall, f1 AS fraud_f1_score
  FROM f)"""

# Sizes of the two-stage split: 30% held out, half of that for test; rows of each stage are
# divided over the classes in proportion, the largest remainders rounded up.
STRATIFIED = f"""{TX},
sizes AS (SELECT "Class", count(*) AS n, sum(count(*)) OVER () AS total FROM tx GROUP BY "Class"),
held AS (SELECT *, ceil(0.30::DOUBLE * total)::BIGINT AS h FROM sizes),
train0 AS (SELECT *, n * (total - h)::DOUBLE / total AS share FROM held),
train1 AS (
  SELECT *, floor(share)::BIGINT AS base,
         row_number() OVER (ORDER BY share - floor(share) DESC, "Class") AS pos,
         total - h - sum(floor(share)::BIGINT) OVER () AS extra
  FROM train0),
train AS (SELECT "Class", n, h, base + CAST(pos <= extra AS BIGINT) AS n_train FROM train1),
val0 AS (SELECT *, n - n_train AS rest, h - ceil(0.5::DOUBLE * h)::BIGINT AS v FROM train),
val1 AS (SELECT *, rest * v::DOUBLE / sum(rest) OVER () AS share FROM val0),
val2 AS (
  SELECT *, floor(share)::BIGINT AS base,
         row_number() OVER (ORDER BY share - floor(share) DESC, "Class") AS pos,
         v - sum(floor(share)::BIGINT) OVER () AS extra
  FROM val1),
bounds AS (SELECT "Class", n_train, n_train + base + CAST(pos <= extra AS BIGINT) AS n_val_end FROM val2),
placed AS (
  SELECT tx.*, row_number() OVER (PARTITION BY "Class" ORDER BY {row_hash(42)}, event_id) AS rn FROM tx),
split AS (
  SELECT placed.*, CASE WHEN rn <= n_train THEN 'train' WHEN rn <= n_val_end THEN 'validation' ELSE 'test' END AS split
  FROM placed JOIN bounds USING ("Class"))"""

BROKEN = """
CASE WHEN "Amount" <= 60 THEN 'ok'
     WHEN "Class" = 1 THEN 'malformed_json'
     WHEN "Amount" > 140 THEN 'type:Amount'
     WHEN "Amount" > 120 THEN 'missing:event_timestamp'
     WHEN "Amount" > 100 THEN 'bad_timestamp'
     WHEN "Amount" > 80 THEN 'type:Class'
     WHEN "Amount" > 70 THEN 'ok'
     ELSE 'missing:Time' END"""

CLOSED = "window_end <= (SELECT max(event_time) FROM tx) - INTERVAL 10 SECOND"
FRACTION = """
(SELECT CASE WHEN sum("Class") > 0 AND sum(1 - "Class") > sum("Class")
             THEN sum("Class")::DOUBLE / sum(1 - "Class")::DOUBLE ELSE 1.0::DOUBLE END FROM tx)"""


def _skew(column: str) -> str:
    return f"skewness(\"{column}\") AS {column.lower()}_skewness"


def _standard(column: str) -> str:
    c = f'"{column}"'
    return f"""({c} - (SELECT avg({c}) FROM feat)) /
        coalesce(nullif((SELECT stddev_samp({c}) FROM feat), 0), 1) AS standard_{column.lower()}"""


def _robust(column: str) -> str:
    c = f'"{column}"'
    return f"""({c} - (SELECT quantile_cont({c}, 0.5) FROM tx)) /
        (SELECT coalesce(nullif(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25), 0), 1) FROM tx) AS scaled_{column.lower()}"""


def _with(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


ALL_TX = _with(TX) + f"SELECT {PLAIN} FROM tx"

ORACLE = {
    # sources and sinks
    "scan_csv": ALL_TX,
    "scan_table": "SELECT * FROM events",
    "scan_first_available": "SELECT * FROM events",
    "source_stream": ALL_TX,
    "write_table": ALL_TX,
    "write_splits": _with(STRATIFIED) + f"SELECT {PLAIN}, split FROM split",
    "export_rows": _with(DASHBOARD) + 'SELECT window_start, prediction, "Amount" FROM dash',
    "run_log": _with(CURVE, RATES)
    + """SELECT 'evaluation' AS phase, 'SUCCESS' AS status, 1 AS rows_per_window, roc_auc, pr_auc, recall
         FROM roc, pr, rates""",
    "views": _with(DASHBOARD)
    + """SELECT source, prediction, count(*) AS n, max(window_start) AS latest
         FROM dash, (VALUES ('session'), ('global'), ('dotted')) AS names(source) GROUP BY source, prediction""",
    # versioned tables
    "versioned_append": ALL_TX,
    "version_history": f"SELECT CAST(ts >= {CUT} AS INT) AS version, count(*) AS rows FROM events GROUP BY 1",
    "time_travel": f"{ALL_TX} WHERE event_time < {CUT}",
    "schema_enforcement": _with(TX) + f"SELECT {PLAIN}, true AS refused FROM tx",
    "schema_evolution": _with(TX)
    + f"""SELECT {PLAIN}, CASE WHEN event_time < {CUT} THEN NULL WHEN "Amount" > 150 THEN 'checked'
          ELSE 'trusted' END AS device_class FROM tx""",
    "atomic_append": f"{ALL_TX} WHERE event_time < {CUT}",
    "optimize_zorder": "SELECT * FROM events",
    "optimize_zorder_two_columns": "SELECT * FROM events",
    "retention_purge": """
        SELECT CASE WHEN ts < '2024-01-21' THEN 1 ELSE 2 END AS version, count(*) AS rows,
               CASE WHEN ts < '2024-01-21' THEN TIMESTAMP '2024-01-21' ELSE TIMESTAMP '2024-01-31' END AS committed_at
        FROM events GROUP BY ALL
        UNION ALL SELECT -1, count(*), max(ts) FROM events WHERE ts < '2024-01-21'""",
    # events
    "encode_events": _with(TX)
    + """SELECT event_id, 'tx_' || trunc("Time")::BIGINT AS key, event_timestamp, "Time", "Amount", "Class" FROM tx""",
    "replay_first_500": _with(TX)
    + """SELECT 'tx_' || trunc("Time")::BIGINT AS key, event_timestamp, "Amount", "Class"
         FROM tx ORDER BY event_time LIMIT 500""",
    "decode_events": _with(TX, f"b AS (SELECT *, {BROKEN} AS broken FROM tx)")
    + """SELECT event_id,
                CASE WHEN broken NOT IN ('malformed_json', 'missing:event_timestamp', 'bad_timestamp') THEN event_time END AS event_time,
                CASE WHEN broken NOT IN ('malformed_json', 'missing:Time') THEN "Time" END AS "Time",
                CASE WHEN broken NOT IN ('malformed_json', 'type:Amount') THEN "Amount" END AS "Amount",
                CASE WHEN broken NOT IN ('malformed_json', 'type:Class') AND NOT ("Amount" > 70 AND "Amount" <= 80) THEN "Class" END AS "Class"
         FROM b""",
    "validate_contract": _with(TX, f"b AS (SELECT *, {BROKEN} AS broken FROM tx)")
    + "SELECT event_id, broken = 'ok' AS valid, nullif(broken, 'ok') AS reject_reason FROM b",
    "project": _with(TX)
    + """SELECT event_id::VARCHAR AS key, event_timestamp, "Class"::DOUBLE AS prediction,
                round("Amount", 1) AS rounded_amount, "Class" AS actual_label FROM tx""",
    "filter_class": _with(TX) + 'SELECT event_id, event_time, "Amount" FROM tx WHERE "Class" = 1',
    "adapt_schema": _with(TX, MINUTE)
    + """SELECT 'features' AS shape, strftime(window_start, '%Y-%m-%dT%H:%M:%S.%fZ') AS window_start,
                "Class"::DOUBLE AS prediction, avg_amount_1m AS "Amount" FROM wf
         UNION ALL SELECT 'totals', event_timestamp, 0.0::DOUBLE, "Amount" FROM tx
         UNION ALL SELECT 'bare', 'now', 0.0::DOUBLE, 100.0::DOUBLE FROM tx
         UNION ALL SELECT 'lower', event_timestamp, "Class"::DOUBLE, "Amount" FROM tx""",
    "preview": _with(TX) + "SELECT * FROM tx ORDER BY event_time, event_id LIMIT 20",
    # window features and dashboards
    "window_features": _with(TX, MINUTE) + "SELECT * FROM wf",
    "direct_access_top10": _with(DASHBOARD)
    + """SELECT window_start, count(*) AS total_transactions,
                sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fraud_count, avg("Amount") AS avg_amount
         FROM dash GROUP BY window_start ORDER BY window_start DESC LIMIT 10""",
    "widget_class_counts": _with(DASHBOARD)
    + """SELECT window_start, sum(CASE WHEN prediction = 0 THEN 1 ELSE 0 END)::BIGINT AS normal_transactions,
                sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fraud_transactions, count(*) AS total_volume
         FROM dash GROUP BY window_start ORDER BY window_start DESC""",
    "widget_fraud_kpi": _with(DASHBOARD)
    + """SELECT sum(CASE WHEN prediction = 1 THEN "Amount" ELSE 0 END) AS total_fraud_amount_usd,
                avg(CASE WHEN prediction = 1 THEN "Amount" END) AS avg_fraud_amount_usd,
                sum(CASE WHEN prediction = 0 THEN "Amount" ELSE 0 END) AS total_legit_amount_usd,
                sum("Amount") AS total_processed_volume_usd
         FROM dash""",
    "widget_latency_literal": _with(DASHBOARD)
    + """SELECT window_start, count(*) AS microbatch_size, round(avg(0.42::DOUBLE), 2) AS avg_processing_latency_seconds
         FROM dash GROUP BY window_start ORDER BY window_start DESC""",
    "widget_fraud_rate": _with(DASHBOARD)
    + """SELECT window_start, count(*) AS total_tx,
                sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::BIGINT AS fraud_tx,
                round(sum(CASE WHEN prediction = 1 THEN 1 ELSE 0 END)::DOUBLE * 100.0 / count(*), 2) AS fraud_rate_percentage
         FROM dash GROUP BY window_start ORDER BY window_start DESC""",
    "widget_weighted": _with(TX)
    + """SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start,
                sum(1 - "Class")::BIGINT AS normal_transactions, sum("Class")::BIGINT AS fraud_transactions,
                count(*) AS total_volume,
                coalesce(sum("Amount") FILTER ("Class" = 1), 0) AS fraud_amount_usd, sum("Amount") AS total_amount_usd,
                round(sum("Class")::DOUBLE * 100.0 / count(*), 2) AS fraud_rate_percentage
         FROM tx GROUP BY 1""",
    "latency_trend": _with(TX, f"arrived AS (SELECT *, {ingest_time(10)} AS ingest_time FROM tx)")
    + """SELECT time_bucket(INTERVAL 1 HOUR, event_time) AS window_start, count(*) AS microbatch_size,
                avg(l) / 1e6::DOUBLE AS avg_latency_seconds, quantile_disc(l, 0.95) / 1e6::DOUBLE AS p95_latency_seconds,
                max(l) / 1e6::DOUBLE AS max_latency_seconds
         FROM (SELECT *, epoch_us(ingest_time) - epoch_us(event_time) AS l FROM arrived) GROUP BY 1""",
    # profile, sampling, scaling
    "class_balance": _with(TX)
    + """SELECT count(*) AS total_rows, sum(1 - "Class")::BIGINT AS legit_count, sum("Class")::BIGINT AS fraud_count,
                sum("Class")::DOUBLE / greatest(count(*), 1) AS fraud_ratio,
                floor(sum(1 - "Class") / greatest(sum("Class"), 1)::DOUBLE)::BIGINT AS legit_per_fraud
         FROM tx""",
    "dataset_audit": _with(FEATURES)
    + f"""SELECT count(*) AS total_rows, 32 AS total_cols,
                 sum({" + ".join(f'CAST("{c}" IS NULL OR isnan("{c}") AS INT)' for c in [*COMPONENTS, "Amount", "Time"])}
                     + CAST(vec_id IS NULL AS INT) + CAST("Class" IS NULL AS INT))::BIGINT AS missing_count,
                 sum(1 - "Class")::BIGINT AS legit_count, sum("Class")::BIGINT AS fraud_count,
                 round(sum("Class")::DOUBLE * 100.0 / count(*), 4) AS fraud_percentage
          FROM feat""",
    "describe_by_class": _with(TX)
    + """SELECT "Class", count("Amount") AS count, avg("Amount") AS mean, stddev_samp("Amount") AS std, min("Amount") AS min,
                quantile_cont("Amount", 0.25) AS p25, quantile_cont("Amount", 0.5) AS p50,
                quantile_cont("Amount", 0.75) AS p75, max("Amount") AS max
         FROM tx GROUP BY "Class" """,
    "skewness": _with(TX) + f"SELECT {_skew('Amount')}, {_skew('Time')} FROM tx",
    "undersample": _with(TX)
    + f"""SELECT event_id, "Amount", "Class" FROM tx
          WHERE "Class" = 1 OR {FRACTION} = 1.0 OR {hash_unit('42:sample')} < {FRACTION}""",
    "undersample_train": _with(STRATIFIED, "part AS (SELECT * FROM split WHERE split = 'train')")
    + f"""SELECT event_id, "Amount", "Class" FROM part
          WHERE "Class" = 1 OR {FRACTION.replace("FROM tx", "FROM part")} = 1.0
             OR {hash_unit('42:sample')} < {FRACTION.replace("FROM tx", "FROM part")}""",
    "random_split": f"SELECT event_id, CASE WHEN {hash_unit(42)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM events",
    "stratified_split": _with(STRATIFIED) + 'SELECT event_id, "Class", split FROM split',
    "stratified_split_approximate": _with(TX)
    + f"""SELECT event_id, "Class", CASE WHEN {hash_unit(42)} < 0.70::DOUBLE THEN 'train'
                 WHEN {hash_unit(42)} < 0.70::DOUBLE + 0.15::DOUBLE THEN 'validation' ELSE 'test' END AS split
          FROM tx""",
    "temporal_split": """
        WITH cuts AS (
          SELECT floor(quantile_cont(epoch_us(ts)::DOUBLE, 0.70)) AS a, floor(quantile_cont(epoch_us(ts)::DOUBLE, 0.85)) AS b
          FROM events)
        SELECT event_id, CASE WHEN epoch_us(ts) <= a THEN 'train' WHEN epoch_us(ts) <= b THEN 'validation' ELSE 'test' END AS split
        FROM events, cuts""",
    "robust_scale": _with(TX) + f"SELECT event_id, {_robust('Amount')}, {_robust('Time')} FROM tx",
    "standard_scale": _with(FEATURES)
    + f"SELECT vec_id, {', '.join(_standard(c) for c in [*COMPONENTS, 'Amount', 'Time'])} FROM feat",
    "class_weight": _with(TX)
    + """SELECT event_id, "Class", CASE WHEN "Class" = 1
                THEN (SELECT sum(1 - "Class")::DOUBLE / greatest(sum("Class"), 1) FROM tx) ELSE 1.0::DOUBLE END AS class_weight
         FROM tx""",
    "class_weight_fixed": _with(TX)
    + 'SELECT event_id, "Class", CASE WHEN "Class" = 1 THEN 290.0::DOUBLE ELSE 1.0::DOUBLE END AS class_weight FROM tx',
    # metrics
    "roc_auc": _with(CURVE) + "SELECT roc_auc FROM roc",
    "pr_auc": _with(CURVE) + "SELECT pr_auc FROM pr",
    "confusion_metrics": _with(SCORED, RATES) + "SELECT * FROM rates",
    "fraud_alerts": _with(SCORED)
    + 'SELECT event_timestamp, "Time", "Amount", prediction, "Class" AS actual_label FROM scored WHERE prediction = 1',
    "baseline_compare": _with(CURVE, RATES)
    + f""", measured AS (
            SELECT unnest(['precision', 'recall', 'f1_score', 'roc_auc', 'pr_auc']) AS metric,
                   unnest([precision, recall, f1_score, roc_auc, pr_auc]) AS value FROM rates, roc, pr
            UNION ALL SELECT 'latency_10_tps', avg(epoch_us({ingest_time(10)}) - epoch_us(event_time)) / 1e6::DOUBLE FROM tx
            UNION ALL SELECT 'latency_40_tps', avg(epoch_us({ingest_time(40)}) - epoch_us(event_time)) / 1e6::DOUBLE FROM tx),
          published(metric, baseline, digits) AS (VALUES
            ('latency_10_tps', 0.80::DOUBLE, 2), ('latency_40_tps', 0.90::DOUBLE, 2), ('precision', 0.34::DOUBLE, 4),
            ('recall', 0.88::DOUBLE, 4), ('f1_score', 0.49::DOUBLE, 4), ('roc_auc', 0.94::DOUBLE, 4))
          SELECT metric, value, baseline,
                 CASE WHEN digits = 2 THEN round(value - baseline, 2) ELSE round(value - baseline, 4) END AS diff,
                 CASE WHEN baseline IS NULL THEN NULL
                      WHEN digits = 2 THEN CASE WHEN value <= baseline THEN 'FASTER (Better)' ELSE 'SLOWER' END
                      ELSE CASE WHEN value > baseline THEN 'HIGHER' ELSE 'NOT HIGHER' END END AS status
          FROM measured LEFT JOIN published USING (metric)""",
    # streaming
    "stream_window_features": _with(TX, MINUTE) + f"SELECT * FROM wf WHERE {CLOSED}",
    "stream_restart": _with(TX, MINUTE) + f"SELECT * FROM wf WHERE {CLOSED}",
    "stream_late_data": _with(TX, f"punctual AS (SELECT * FROM tx WHERE event_time >= {CUT})", windows("1 MINUTE", "30 SECOND", "punctual"))
    + f"SELECT * FROM wf WHERE {CLOSED}",
    "stream_rejects": _with(TX, f"b AS (SELECT *, {BROKEN} AS broken FROM tx)")
    + """SELECT CASE WHEN broken = 'ok' THEN 'accepted' ELSE 'quarantined' END AS route,
                nullif(broken, 'ok') AS reject_reason, count(*) AS records FROM b GROUP BY 1, 2""",
    # What a trained forest says SQL cannot; that every row has been scored, and alike both ways, it can.
    "rf_train_score": _with(FEATURES)
    + f"""SELECT vec_id, "Class", true AS score_in_range, true AS prediction_agrees
          FROM feat WHERE {hash_unit(42, "vec_id")} >= 0.8::DOUBLE""",
    "model_roundtrip": _with(FEATURES)
    + f"""SELECT count(*) AS scored, 0::BIGINT AS mismatches FROM feat WHERE {hash_unit(42, "vec_id")} >= 0.8::DOUBLE""",
    "stream_alerts": _with(FEATURES)
    + f"""SELECT count(*) AS records, 0::BIGINT AS mismatches FROM feat WHERE {hash_unit(42, "vec_id")} >= 0.8::DOUBLE""",
    "stream_scored": _with(FEATURES)
    + f"""SELECT count(*) AS scored, 0::BIGINT AS unscored, count(*) AS records, 0::BIGINT AS mismatches
          FROM feat WHERE {hash_unit(42, "vec_id")} >= 0.8::DOUBLE""",
}

LATE = f"event_id % 97 = 0 AND event_time < {CUT}"
BACKLOG = _with(
    TX, f"punctual AS (SELECT * FROM tx WHERE NOT ({LATE}))", windows("1 MINUTE", "30 SECOND", "punctual"),
    "gone AS (SELECT * FROM wf WHERE window_end <= (SELECT max(event_time) FROM punctual) - INTERVAL 5 DAY)",
)
ORACLE |= {
    "stream_many_batches": BACKLOG
    + f"""SELECT *, true AS several_batches, (SELECT count(*) FROM (
              SELECT DISTINCT time_bucket(INTERVAL 30 SECOND, event_time) - i * INTERVAL 30 SECOND, "Class"
              FROM tx, (SELECT unnest([0, 1]) AS i) WHERE {LATE})) AS late_groups FROM gone""",
    "stream_compacted": BACKLOG
    + """SELECT strftime(window_start, '%Y-%m-%d') AS day, count(*) AS rows, true AS few_files, 0::BIGINT AS mismatches
         FROM gone GROUP BY 1""",
    "stream_open_windows": _with(TX, windows("1 HOUR", "30 MINUTE"))
    + """SELECT *, window_end > (SELECT max(event_time) FROM tx) - INTERVAL 5 DAY AS open FROM wf""",
    "stream_score_rejects": _with(FEATURES)
    + f"""SELECT unnest(CASE vec_id % 10 WHEN 1 THEN ['records', 'malformed_json'] WHEN 2 THEN ['records', 'type:Class']
                 WHEN 3 THEN ['records', 'no_number:V3'] WHEN 4 THEN ['records', 'bad_timestamp']
                 ELSE ['records', 'scored', 'written'] END) AS outcome, count(*) AS records
          FROM feat WHERE {hash_unit(42, "vec_id")} >= 0.8::DOUBLE GROUP BY 1""",
    "measured_latency": """SELECT count(*) AS arrived, count(*) AS after_event, true AS several_batches,
                                  count(*)::BIGINT AS in_trend, true AS in_order FROM events""",
    "sql_direct_access": ORACLE["direct_access_top10"],
    "sql_class_counts": ORACLE["widget_class_counts"],
    "sql_fraud_kpi": ORACLE["widget_fraud_kpi"],
    "sql_latency": ORACLE["widget_latency_literal"],
    "sql_fraud_rate": ORACLE["widget_fraud_rate"],
    "sketch_quantiles": _with(TX)
    + """SELECT "Class", count(*) AS n, p, true AS near FROM tx, (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95])::DOUBLE AS p)
         GROUP BY "Class", p""",
    "optimize_layout": """SELECT unnest(['value', 'user_id']) AS "column", count(*) AS rows, true AS few_files, true AS even,
                                 true AS skips_more FROM events""",
    "train_run": _with(FEATURES)
    + f"""SELECT count(*) FILTER (NOT large) AS legit_rows, count(*) FILTER (large) AS fraud_rows, 1::BIGINT AS logged,
                 true AS area_in_range, true AS above_chance
          FROM (SELECT vec_id, "Amount" > (SELECT avg("Amount") FROM feat) * 1.5::DOUBLE AS large FROM feat)
          WHERE {hash_unit(42, "vec_id")} < 0.7::DOUBLE""",
}
