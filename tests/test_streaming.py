"""Streams over text files, one file per batch, in the order of their modification times."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from klaxon import sources
from klaxon.functions import decode_alerts
from klaxon.operators import for_day
from klaxon.plans import count_stream, counts_of_stream, daily_metrics
from klaxon.streaming import start_both, start_stream

DAY = "2026-01-02T"


def alert(number, time, severity="HIGH", system="A"):
    return {"incident_id": str(number), "system": system, "severity": severity, "timestamp": time and DAY + time}


def drop_files(folder, batches, first=0):
    folder.mkdir(exist_ok=True)
    for position, batch in enumerate(batches, first):
        path = folder / f"b{position}.json"
        path.write_text("".join(json.dumps(item) + "\n" for item in batch))
        os.utime(path, (1_700_000_000 + 10 * position,) * 2)


# Late, null-timed, repeated and low alerts.
LATE = [
    [alert(1, "10:00:01.000000"), alert(1, "10:00:02.000000"), alert(2, None)],
    [alert(9, "10:30:00.000000", "LOW")],
    [alert(3, "10:00:05.000000")],
    [alert(4, "10:05:00.500000")],
    [alert(5, "10:00:06.000000")],
    [alert(6, "10:04:30.000000")],
]


def stream_of(spark, folder):
    return sources.stream_alerts(spark, "text", str(folder), maxFilesPerTrigger="1")


def run(spark, tmp_path, counts, folder="out", checkpoint="progress"):
    query = start_stream(counts, "csv", str(tmp_path / checkpoint), str(tmp_path / folder), trigger=None)
    query.awaitTermination()
    read = sources.typed_metrics(sources.read_counts(spark, str(tmp_path / folder), file_format="csv"))
    return query, {tuple(row) for row in read.collect()}


def test_late_alerts_and_open_windows(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    counts = counts_of_stream(stream_of(spark, tmp_path / "in"))
    query, rows = run(spark, tmp_path, counts)
    start = datetime(2026, 1, 2, 10)
    # Alert 5 comes within the one batch of grace; 4 and 6 are in windows still open.
    assert rows == {("A", 4, start, start + timedelta(seconds=10))}
    marks = [p["eventTime"].get("watermark") for p in query.recentProgress if p["eventTime"]]
    # The LOW alert at 10:30 does not advance the watermark.
    assert max(marks) == "2026-01-02T10:04:00.500Z"


def test_watermark_before_the_filter_gives_the_same(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    alerts = decode_alerts(stream_of(spark, tmp_path / "in")).withWatermark("timestamp", "1 minute")
    counts = (
        alerts.filter("severity = 'HIGH'")
        .groupBy(F.window("timestamp", "10 seconds"), "system")
        .agg(F.count("incident_id").alias("high_severity_count"))
        .select("system", "high_severity_count",
                F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"))
    )
    assert run(spark, tmp_path, counts)[1] == run(
        spark, tmp_path, counts_of_stream(stream_of(spark, tmp_path / "in")), "out2", "progress2"
    )[1]


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    drop_files(
        tmp_path / "in",
        [[alert(1, "10:00:01.000000")], [alert(2, "10:10:00.000000")], [alert(3, "10:10:01.000000")],
         [alert(4, "10:00:02.000000")], [alert(5, "10:20:00.000000")], [alert(6, "10:20:01.000000")]],
    )
    query, rows = run(spark, tmp_path, counts_of_stream(stream_of(spark, tmp_path / "in")))
    assert {(row[1], row[2].minute) for row in rows} == {(1, 0), (2, 10)}
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped == 1


def test_append_equals_batch_on_closed_windows(spark, tmp_path):
    moments = [datetime(2026, 1, 2, 10) + timedelta(seconds=7 * i) for i in range(200)]
    alerts = [
        alert(i, moment.time().isoformat(timespec="microseconds"), ("HIGH", "LOW")[i % 5 == 0], "ABC"[i % 3])
        for i, moment in enumerate(moments)
    ]
    drop_files(tmp_path / "in", [alerts[:70], alerts[70:150], alerts[150:]])
    _, rows = run(spark, tmp_path, counts_of_stream(stream_of(spark, tmp_path / "in")))
    raw = sources.read_alerts(spark, path=str(tmp_path / "in"))
    last = decode_alerts(raw).filter("severity = 'HIGH'").agg(F.max("timestamp")).first()[0]
    batch = counts_of_stream(raw).filter(F.col("window_end") <= F.lit(last - timedelta(minutes=1)))
    assert rows == {tuple(row) for row in batch.collect()}
    assert len(rows) > 100


def test_restart_goes_on_and_new_checkpoint_replays(spark, tmp_path):
    first = [[alert(1, "10:00:01.000000"), alert(2, "10:05:00.000000")]]
    second = [[alert(3, "10:10:00.000000")]]
    drop_files(tmp_path / "in", first)
    stream = lambda: counts_of_stream(stream_of(spark, tmp_path / "in"))
    assert {row[2].minute for row in run(spark, tmp_path, stream())[1]} == {0}
    drop_files(tmp_path / "in", second, first=1)
    assert {row[2].minute for row in run(spark, tmp_path, stream())[1]} == {0, 5}
    run(spark, tmp_path, stream(), "replay", "other")
    both = tmp_path / "runs"
    both.mkdir()
    for name in ("out", "replay"):
        os.symlink(tmp_path / name, both / name)
    once = sources.read_counts(spark, str(tmp_path / "out"), file_format="csv")
    twice = sources.union_runs(once, sources.read_counts(spark, str(tmp_path / "replay"), file_format="csv"))
    assert (once.count(), twice.count(), twice.dropDuplicates().count()) == (2, 4, 2)


def test_both_sinks_from_one_query(spark, tmp_path, capsys):
    drop_files(tmp_path / "in", LATE)
    query = count_stream(
        stream_of(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"), trigger=None
    )
    query.awaitTermination()
    counts = sources.typed_metrics(sources.read_counts(spark, str(tmp_path / "out")))
    assert [row.high_severity_count for row in counts.collect()] == [4]
    assert "2026-01-02 10:00:00" in capsys.readouterr().out
    # One query reads the source once and keeps one state.
    assert all(len(p["stateOperators"]) == 1 and len(p["sources"]) == 1 for p in query.recentProgress)


def test_a_folder_belongs_to_one_query(spark, tmp_path):
    drop_files(tmp_path / "in", [[alert(1, "10:00:01.000000"), alert(2, "10:05:00.000000")]])

    def start(checkpoint):
        counts = counts_of_stream(stream_of(spark, tmp_path / "in"))
        start_both(counts, str(tmp_path / "out"), str(tmp_path / checkpoint), trigger=None).awaitTermination()

    start("one")
    with pytest.raises(Exception, match="belongs to"):
        start("two")
    assert sources.read_counts(spark, str(tmp_path / "out")).count() == 1
    drop_files(tmp_path / "in", [[alert(3, "10:10:00.000000")]], first=1)
    start("one")
    assert sources.read_counts(spark, str(tmp_path / "out")).count() == 2


@pytest.mark.parametrize("sink", ["parquet", "csv"])
def test_odd_systems_survive_the_way_to_the_daily_job(spark, tmp_path, sink):
    systems = ["x\ny", "", " A", "A", 'say "a"', "b,c"]
    drop_files(
        tmp_path / "in",
        [[alert(i, "10:00:01.000000", "HIGH", system) for i, system in enumerate(systems)], [alert(9, "10:05:00.000000")]],
    )
    count_stream(
        stream_of(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), trigger=None, sink=sink
    ).awaitTermination()
    counts = sources.read_counts(spark, str(tmp_path / "out"), file_format=sink)
    stats = daily_metrics(counts, "2026-01-02")["stats"].collect()
    assert {row.system for row in stats} == set(systems)


def test_a_day_reads_its_folder_only(spark, tmp_path, capsys):
    drop_files(tmp_path / "in", LATE)
    count_stream(
        stream_of(spark, tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), trigger=None
    ).awaitTermination()
    counts = sources.read_counts(spark, str(tmp_path / "out"))
    for_day(counts, "2026-01-02").explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if "PartitionFilters" in line]
    assert filters and all("window_date" in line for line in filters)


def test_runs_are_read_together(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    for run_name in ("run_1", "run_2"):
        count_stream(
            stream_of(spark, tmp_path / "in"), str(tmp_path / "runs" / run_name), str(tmp_path / run_name), trigger=None
        ).awaitTermination()
    assert sources.read_counts(spark, str(tmp_path / "runs"), all_runs=True).count() == 2


def test_console_and_fixed_number_of_files(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    counts = counts_of_stream(stream_of(spark, tmp_path / "in"))
    start_stream(counts, "console", str(tmp_path / "c1"), trigger=None).awaitTermination()
    query = start_stream(counts, "parquet", str(tmp_path / "c2"), str(tmp_path / "out"), trigger=None, files=1, name="one")
    query.awaitTermination()
    assert query.name == "one"
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_stored_by_date_then_metrics_of_a_day(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    counts = counts_of_stream(stream_of(spark, tmp_path / "in"))
    start_stream(
        counts, "parquet", str(tmp_path / "c"), str(tmp_path / "out"), trigger=None, partition_by=["window_date"]
    ).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "out"))
    (row,) = daily_metrics(stored, "2026-01-02")["enriched"].collect()
    assert (row.high_severity_count, row.total_high_severity, row.avg_per_window) == (4, 4, 4.0)
    assert daily_metrics(stored, "2026-01-03")["windows"].isEmpty()


def test_processing_time_trigger(spark, tmp_path):
    drop_files(tmp_path / "in", LATE)
    counts = counts_of_stream(stream_of(spark, tmp_path / "in"))
    query = start_stream(counts, "csv", str(tmp_path / "progress"), str(tmp_path / "out"), trigger="100 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert sources.read_counts(spark, str(tmp_path / "out"), file_format="csv").count() == 1


def test_needs_utc(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        with pytest.raises(ValueError, match="UTC"):
            counts_of_stream(raw)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_kafka_without_its_package_says_so(spark):
    with pytest.raises(Exception, match="kafka"):
        sources.stream_alerts(spark, **{"kafka.bootstrap.servers": "nowhere:9092"})


def test_state_plan_combines_before_the_shuffle(spark, tmp_path, capsys):
    drop_files(tmp_path / "in", LATE[:1])
    query, _ = run(spark, tmp_path, counts_of_stream(stream_of(spark, tmp_path / "in")))
    query.explain()
    plan = capsys.readouterr().out
    assert plan.index("StateStoreSave") < plan.index("Exchange") < plan.index("partial_count")
