from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from klaxon.functions import decode_alerts
from klaxon.operators import alerts_between, severity_counts

SCHEMA = "incident_id string, system string, severity string, timestamp timestamp"


def at(minute, second, microsecond=0):
    return datetime(2026, 1, 2, 10, minute, second, microsecond)


def rows_of(counts):
    return {tuple(row) for row in counts.collect()}


def test_windows_are_half_open_and_aligned_to_the_epoch(spark):
    alerts = spark.createDataFrame(
        [
            ("1", "A", "HIGH", at(10, 0)),
            ("2", "A", "HIGH", at(10, 9, 999999)),
            ("3", "A", "HIGH", at(10, 10)),
        ],
        SCHEMA,
    )
    assert rows_of(severity_counts(alerts)) == {
        ("A", 2, at(10, 0), at(10, 10)),
        ("A", 1, at(10, 10), at(10, 20)),
    }


def test_nulls_in_time_system_and_id(spark):
    alerts = spark.createDataFrame(
        [
            ("1", "A", "HIGH", None),
            ("2", None, "HIGH", at(10, 1)),
            (None, None, "HIGH", at(10, 2)),
            (None, "B", "HIGH", at(10, 3)),
            ("3", "C", None, at(10, 3)),
        ],
        SCHEMA,
    )
    assert rows_of(severity_counts(alerts)) == {
        (None, 1, at(10, 0), at(10, 10)),
        ("B", 0, at(10, 0), at(10, 10)),
    }


def test_repeated_ids_count_and_severity_matches_exactly(spark):
    alerts = spark.createDataFrame(
        [("1", "A", level, at(10, 1)) for level in ("HIGH", "HIGH", "high", " HIGH", "LOW")], SCHEMA
    )
    assert rows_of(severity_counts(alerts)) == {("A", 2, at(10, 0), at(10, 10))}
    assert rows_of(severity_counts(alerts, severity="LOW")) == {("A", 1, at(10, 0), at(10, 10))}


@pytest.mark.parametrize("fraction,windows", [("required", 0), ("optional", 3)])
def test_times_without_fraction(spark, fraction, windows):
    samples = [
        ("HPE-NONSTOP", "HIGH", "2026-01-02T10:10:00"),
        ("MAINFRAME", "MEDIUM", "2026-01-02T10:12:30"),
        ("LINUX-OPS", "HIGH", "2026-01-02T10:15:00"),
        ("HPE-NONSTOP", "LOW", "2026-01-02T10:18:00"),
        ("MAINFRAME", "HIGH", "2026-01-02T10:20:00"),
    ]
    raw = spark.createDataFrame(samples, "system string, severity string, timestamp string")
    raw = raw.withColumn("incident_id", F.lit("INC1")).select(F.to_json(F.struct("*")).alias("value"))
    counts = severity_counts(decode_alerts(raw, fraction))
    assert counts.count() == windows
    assert {row.high_severity_count for row in counts.collect()} <= {1}


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_alerts_between_is_half_open(spark, kind):
    times = [datetime(2026, 1, 1, 23, 59, 59), datetime(2026, 1, 2), datetime(2026, 1, 2, 23), datetime(2026, 1, 3)]
    alerts = spark.createDataFrame([(time,) for time in times], "timestamp timestamp")
    alerts = alerts.withColumn("timestamp", F.col("timestamp").cast(kind))
    kept = alerts_between(alerts, date(2026, 1, 2), date(2026, 1, 3))
    assert {row.timestamp for row in kept.collect()} == set(times[1:3])


def test_count_shuffles_once_after_combining(spark):
    alerts = spark.createDataFrame([("1", "A", "HIGH", at(10, 0))], SCHEMA)
    plan = severity_counts(alerts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "partial_count" in plan
