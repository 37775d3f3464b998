"""Open windows, dropped groups, time of all severities, quarantine: streams beside their batch."""

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_streaming import LATE, alert, drop_files, run, stream_of

from klaxon import sources
from klaxon.functions import checked_alerts, decode_alerts
from klaxon.operators import severity_counts
from klaxon.plans import count_stream, counts_of_stream
from klaxon.streaming import DroppedRows, open_windows, read_dropped, start_checked

START = datetime(2026, 1, 2, 10)


def counts(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("time_of", ["chosen", "all"])
def test_closed_and_open_windows_are_those_of_the_batch(spark, tmp_path, time_of):
    """No alert is late here, so that nothing is dropped."""
    alerts = [
        [alert(1, "10:00:01.000000"), alert(2, "10:00:12.000000", system=None)],
        [alert(3, "10:00:13.000000"), alert(4, "10:01:30.000000", "LOW")],
        [alert(5, "10:02:00.500000"), alert(6, "10:02:01.500000", system="B"), alert(None, "10:02:02.000000")],
    ]
    drop_files(tmp_path / "in", alerts)
    stream = counts_of_stream(stream_of(spark, tmp_path / "in"), time_of=time_of)
    _, closed = run(spark, tmp_path, stream)
    left = open_windows(spark, str(tmp_path / "progress"))
    raw = sources.read_alerts(spark, "text", str(tmp_path / "in"))
    whole = counts(severity_counts(decode_alerts(raw)).collect())
    left = [tuple(row) for row in left.collect()]
    assert closed and left and not closed & set(left)
    assert counts([*closed, *left]) == whole


def test_open_windows_grow_and_go(spark, tmp_path):
    folder, progress = tmp_path / "in", str(tmp_path / "progress")
    drop_files(folder, [[alert(1, "10:00:01.000000")]])
    stream = counts_of_stream(stream_of(spark, folder))
    run(spark, tmp_path, stream)
    first = (START, START + timedelta(seconds=10))
    assert counts(open_windows(spark, progress).collect()) == [("A", 1, *first)]
    drop_files(folder, [[alert(2, "10:00:02.000000")], [alert(3, "10:09:00.000000")]], first=1)
    _, closed = run(spark, tmp_path, stream)
    assert closed == {("A", 2, *first)}
    later = START + timedelta(minutes=9)
    assert counts(open_windows(spark, progress).collect()) == [("A", 1, later, later + timedelta(seconds=10))]
    # The state of an earlier batch can be read as well.
    assert counts(open_windows(spark, progress, batchId="0").collect()) == [("A", 1, *first)]


def test_alerts_of_all_severities_advance_the_watermark(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    stream = counts_of_stream(stream_of(spark, tmp_path / "in"), time_of="all")
    query, rows = run(spark, tmp_path, stream)
    # The LOW alert of 10:30 closes the window before alert 5 comes; 4 and 6 are late as well.
    assert rows == {("A", 3, START, START + timedelta(seconds=10))}
    marks = [p["eventTime"].get("watermark") for p in query.recentProgress if p["eventTime"]]
    assert max(marks) == "2026-01-02T10:29:00.000Z"
    assert open_windows(spark, str(tmp_path / "progress")).isEmpty()


def test_time_of_is_checked(spark):
    with pytest.raises(ValueError):
        severity_counts(spark.createDataFrame([], "severity string, timestamp timestamp"), time_of="some")


@pytest.fixture
def dropped(spark, tmp_path):
    """Table of what streams drop while the test runs."""
    listener = DroppedRows(spark, str(tmp_path / "dropped"))
    spark.streams.addListener(listener)
    yield str(tmp_path / "dropped")
    spark.streams.removeListener(listener)


def wait_for_listeners(spark):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)


def test_dropped_groups_are_written(spark, tmp_path, dropped):
    late = [alert(n, f"10:00:0{n}.000000", system=system) for n in (5, 6) for system in "AB"]
    on_time = [[alert(1, "10:00:01.000000")], [alert(2, "10:09:00.000000")], [alert(3, "10:09:01.000000")]]
    drop_files(tmp_path / "in", [*on_time, late, [alert(4, "10:09:02.000000")]])
    query = count_stream(
        stream_of(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"),
        trigger=None, console_rows=0,
    )
    query.awaitTermination()
    wait_for_listeners(spark)
    found = read_dropped(spark, dropped).collect()
    # Four alerts in one window of two systems.
    assert [(row["query_id"], row["batch_id"], row["dropped"]) for row in found] == [(query.id, 3, 2)]
    assert found[0]["watermark"] == START + timedelta(minutes=8, seconds=1)


def test_a_progress_that_is_reported_again_counts_once(spark, tmp_path):
    class Event:
        class progress:
            id, name, batchId = "q", None, 7
            eventTime = {"watermark": "2026-01-02T10:08:00.000Z"}
            stateOperators = [type("state", (), {"numRowsDroppedByWatermark": n}) for n in (2, 1)]

    listener = DroppedRows(spark, str(tmp_path / "dropped"))
    listener.onQueryProgress(Event)
    listener.onQueryProgress(Event)
    assert [row["dropped"] for row in read_dropped(spark, str(tmp_path / "dropped")).collect()] == [3]


PAYLOADS = [
    ('{"incident_id": "1", "severity": "HIGH", "timestamp": "2026-01-02T10:00:01.000000"}', None),
    (' {"timestamp": "2026-01-02T10:00:01.000000", "more": [1]}', None),
    ("no json", "not JSON"),
    ('{"incident_id": "2", "timestamp"', "not JSON"),
    ('[{"timestamp": "2026-01-02T10:00:01.000000"}]', "not JSON"),
    ("17", "not JSON"),
    ('"text"', "not JSON"),
    ("null", "not JSON"),
    ("", "not JSON"),
    (None, "not JSON"),
    ("{}", "no event time"),
    ('{"timestamp": "yesterday"}', "no event time"),
    ('{"timestamp": null, "system": "A"}', "no event time"),
]


def test_problems_of_payloads(spark):
    raw = spark.createDataFrame([(text,) for text, _ in PAYLOADS], "value string")
    found = checked_alerts(raw).collect()
    assert counts((row["payload"], row["problem"]) for row in found) == counts(PAYLOADS)
    binary = checked_alerts(raw.select(F.col("value").cast("binary"))).collect()
    assert counts(binary) == counts(found)


def test_quarantine_survives_a_restart_and_a_repeated_batch(spark, tmp_path):
    folder = tmp_path / "in"
    drop_files(folder, [[alert(1, "10:00:01.000000")], [alert(2, "10:00:02.000000")]])
    with open(folder / "b1.json", "a") as file:
        file.write('broken {\n{"a": 1}\n')
    os.utime(folder / "b1.json", (1_700_000_010,) * 2)
    out, bad, progress = (str(tmp_path / name) for name in ("out", "bad", "progress"))

    def go():
        checked = checked_alerts(stream_of(spark, folder))
        start_checked(checked, out, bad, progress, trigger=None).awaitTermination()
        sound = spark.read.parquet(out).select("incident_id").collect()
        others = spark.read.parquet(bad).select("payload", "problem").collect()
        return sorted(row[0] for row in sound), sorted(map(tuple, others))

    lost = [("broken {", "not JSON"), ('{"a": 1}', "no event time")]
    assert go() == (["1", "2"], lost)
    # A batch that was written but not recorded runs again and replaces its folders.
    last = max((tmp_path / "progress" / "commits").glob("[0-9]*"), key=lambda path: int(path.name))
    last.rename(tmp_path / "done")
    (last.parent / f".{last.name}.crc").rename(tmp_path / "done.crc")
    assert go() == (["1", "2"], lost)
    drop_files(folder, [[alert(3, "10:00:03.000000")]], first=2)
    assert go() == (["1", "2", "3"], lost)


def test_folders_of_a_quarantine_belong_to_one_query(spark, tmp_path):
    folder = tmp_path / "in"
    drop_files(folder, [[alert(1, "10:00:01.000000")]])
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    checked = checked_alerts(stream_of(spark, folder))
    start_checked(checked, out, bad, str(tmp_path / "p1"), trigger=None).awaitTermination()
    query = start_checked(checked, str(tmp_path / "out2"), bad, str(tmp_path / "p2"), trigger=None)
    with pytest.raises(Exception, match="belongs to the streaming query"):
        query.awaitTermination()
