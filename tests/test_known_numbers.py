"""Numbers for the driver's tables at all three sizes, found by another engine."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from klaxon import operators as ops
from klaxon.operators.similarity import knn_exact

ROOT = "/root/testdata"

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="driver tables not here")

# size, severities, window, windows, spikes, top count, windows with it
KNOWN = [
    ("0.001", (389, 360, 251), "10 seconds", 389, 0, 1, 389),
    ("0.001", (389, 360, 251), "6 hours", 357, 1, 3, 1),
    ("0.01", (3665, 3783, 2552), "10 seconds", 3665, 0, 1, 3665),
    ("0.01", (3665, 3783, 2552), "6 hours", 2556, 207, 6, 1),
    ("0.1", (36771, 37705, 25524), "10 seconds", 36695, 1, 3, 1),
    ("0.1", (36771, 37705, 25524), "6 hours", 4798, 4722, 23, 1),
]


@pytest.mark.parametrize("size,severities,window,windows,spikes,top,tied", KNOWN)
def test_windows(spark, size, severities, window, windows, spikes, top, tied):
    alerts = entry_module._all_alerts(spark, f"{ROOT}/sf{size}")
    found = {row.severity: row["count"] for row in alerts.groupBy("severity").count().collect()}
    assert (found["HIGH"], found["MEDIUM"], found["LOW"]) == severities
    counts = ops.severity_counts(alerts, window)
    assert counts.count() == windows
    assert counts.agg(F.sum("high_severity_count")).first()[0] == severities[0]
    assert ops.spikes(counts).count() == spikes
    assert ops.has_spikes(counts) == (spikes > 0)
    assert ops.peak_window(counts).first().high_severity_count == top
    assert counts.filter(F.col("high_severity_count") == top).count() == tied


def test_a_day(spark):
    day = ops.for_day(entry_module._counts(spark, f"{ROOT}/sf0.01"), date(2024, 1, 2))
    rows = {row.system: (row.total_high_severity, row.avg_per_window) for row in ops.system_stats(day).collect()}
    known = {"host-0": (5, 2.5), "host-1": (3, 1.0), "host-10": (5, 1.25), "host-11": (6, 2.0)}
    assert {system: rows[system] for system in known} == known


def test_neighbours(spark):
    queries, corpus = entry_module._vectors(spark, f"{ROOT}/sf0.01")
    rows = knn_exact(queries, corpus, 3).filter("query_id = 0").orderBy("rank").collect()
    found = [(row.id, round(row.l2, 6)) for row in rows]
    assert found == [(0, 0.0), (365, 1.260013), (334, 1.274556)]


@pytest.mark.parametrize("size,windows,alerts", [("0.001", 352, 384), ("0.01", 2536, 3639), ("0.1", 4758, 36456)])
def test_closed_windows_of_the_stream(spark, size, windows, alerts):
    counts = entry_module.stream_window_counts(spark, f"{ROOT}/sf{size}")
    assert tuple(counts.agg(F.count("*"), F.sum("high_severity_count")).first()) == (windows, alerts)
