from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from klaxon import operators as ops
from klaxon.functions import is_normal, is_spike
from klaxon.plans import daily_metrics, overview
from klaxon.sources import typed_metrics

SCHEMA = "system string, high_severity_count int, window_start timestamp, window_end timestamp"


def window(second):
    return datetime(2026, 1, 2, 10, 0, second), datetime(2026, 1, 2, 10, 0, second + 10)


def frame(spark, *rows):
    return spark.createDataFrame([(system, n, *window(s)) for system, n, s in rows], SCHEMA)


@pytest.fixture(scope="module")
def counts(spark):
    return frame(
        spark, ("A", 5, 0), ("A", 1, 10), ("B", 5, 0), ("B", None, 10), (None, 3, 0), (None, 3, 0)
    )


def test_system_stats_follow_sql(counts):
    rows = {row.system: (row.total_high_severity, row.avg_per_window) for row in ops.system_stats(counts).collect()}
    assert rows == {"A": (6, 3.0), "B": (5, 5.0), None: (6, 3.0)}
    assert {tuple(row) for row in ops.totals(counts).collect()} == {("A", 6), ("B", 5), (None, 6)}
    assert {tuple(row) for row in ops.averages(counts).collect()} == {("A", 3.0), ("B", 5.0), (None, 3.0)}


def test_total_of_nulls_only_is_null(spark):
    row = ops.system_stats(frame(spark, ("A", None, 0))).first()
    assert (row.total_high_severity, row.avg_per_window) == (None, None)


# Bounds that take the broadcast and the shuffle.
@pytest.mark.parametrize("max_rows", [1000, 0])
def test_enrich_keeps_every_window_and_leaves_null_system_without_statistics(counts, max_rows):
    enriched = ops.enrich(counts, max_rows=max_rows)
    assert enriched.columns == [*counts.columns, "total_high_severity", "avg_per_window"]
    rows = sorted(
        ((r.system, r.high_severity_count, r.total_high_severity, r.avg_per_window) for r in enriched.collect()),
        key=str,
    )
    assert rows == sorted(
        [
            ("A", 5, 6, 3.0),
            ("A", 1, 6, 3.0),
            ("B", 5, 5, 5.0),
            ("B", None, 5, 5.0),
            (None, 3, None, None),
            (None, 3, None, None),
        ],
        key=str,
    )


def test_peak_takes_earliest_then_system_of_equals(spark):
    tied = frame(spark, ("B", 5, 10), ("C", 5, 0), ("B", 5, 0), ("A", None, 0), ("A", 4, 0))
    peak = ops.peak_window(tied)
    assert [tuple(row) for row in peak.collect()] == [("B", 5, *window(0))]
    assert "TakeOrderedAndProject" in peak._jdf.queryExecution().executedPlan().toString()


def test_spikes_are_inclusive_distinct_and_skip_null(counts):
    rows = sorted(((r.system, r.high_severity_count) for r in ops.spikes(counts).collect()), key=str)
    assert rows == sorted([("A", 5), ("B", 5), (None, 3)], key=str)
    assert ops.has_spikes(counts)
    assert not ops.has_spikes(counts, threshold=6)


def test_null_count_is_neither_normal_nor_spike(counts):
    assert counts.filter(is_normal()).count() == 1
    assert counts.filter(is_spike()).count() == 4


def test_for_day_on_typed_bounds(spark):
    days = spark.sql(
        "SELECT * FROM VALUES (TIMESTAMP '2026-01-01 23:59:59'), (TIMESTAMP '2026-01-02 00:00:00'),"
        " (TIMESTAMP '2026-01-02 23:59:59'), (TIMESTAMP '2026-01-03 00:00:00'), (NULL) AS t(window_start)"
    )
    for as_of in ("2026-01-02", date(2026, 1, 2)):
        assert ops.for_day(days, as_of).count() == 2
        assert ops.for_day(days.selectExpr("CAST(window_start AS timestamp_ntz)"), as_of).count() == 2


def test_for_day_on_text_skips_bad_cells(spark):
    texts = ["2026-01-02T10:10:00.000Z", "2026-01-02 00:00:00", "2026-01-03T00:00:00.000Z", "bad", None]
    df = spark.createDataFrame([(text,) for text in texts], "window_start string")
    assert [row[0] for row in ops.for_day(df, "2026-01-02").collect()] == texts[:2]


def test_for_day_defaults_to_today(spark):
    df = spark.range(1).select(
        F.current_timestamp().alias("window_start")
    ).union(spark.sql("SELECT TIMESTAMP '2000-01-01 00:00:00'"))
    assert ops.for_day(df).count() == 1
    assert ops.for_day(df.selectExpr("CAST(window_start AS string)")).count() == 1


def test_typed_counts_reads_numbers_as_text(spark):
    cells = ["3", "3.0", "x", "", None, "3000000000"]
    df = spark.createDataFrame([("A", cell, "s", "e") for cell in cells],
                               "system string, high_severity_count string, window_start string, window_end string")
    typed = ops.typed_counts(df.withColumn("day", F.lit(1)))
    assert typed.columns == ["system", "high_severity_count", "window_start", "window_end"]
    assert dict(typed.dtypes)["high_severity_count"] == "int"
    assert [row.high_severity_count for row in typed.collect()] == [3, 3, None, None, None, None]


def test_summary_drops_null_system_and_sums_nothing_to_zero(spark):
    rows = ops.system_summary(frame(spark, ("B", 3, 0), ("B", 2, 10), ("A", None, 0), (None, 9, 0))).collect()
    assert [tuple(row) for row in rows] == [("A", 0, None, 0), ("B", 5, 2.5, 1)]


def test_kpis_include_null_system(counts, spark):
    assert tuple(ops.kpis(counts).first()) == (17, 3.4, 4)
    assert tuple(ops.kpis(counts.limit(0)).first()) == (0, None, 0)


def test_system_list_is_in_order_of_first_appearance(spark):
    df = frame(spark, ("B", 1, 20), ("A", 1, 10), (None, 1, 0), ("B", 1, 5), ("C", 1, 10))
    assert [row.system for row in ops.system_list(df).collect()] == [None, "B", "A", "C"]


def test_selection(counts):
    assert ops.select_system(counts).count() == 6
    assert ops.select_system(counts, "A").count() == 2


def test_series_labels_points_in_time_order(counts):
    points = ops.in_time_order(ops.series(counts))
    assert points.columns == ["series", "system", "window_start", "window_end", "high_severity_count"]
    assert [(p.series, p.system, p.high_severity_count) for p in points.collect()] == [
        ("spike", "A", 5), ("spike", "B", 5), ("spike", None, 3), ("spike", None, 3), ("normal", "A", 1),
    ]
    assert ops.series(counts, system="B").count() == 1


def test_time_order_puts_null_last_and_breaks_ties_by_all_columns(spark):
    rows = [("A", i, window(0)[0] if i % 2 else None, None) for i in range(9, -1, -1)]
    df = spark.createDataFrame([*rows, (None, 0, *window(0))], SCHEMA)
    assert [row[1] for row in ops.in_time_order(df).collect()] == [1, 3, 5, 7, 9, 0, 0, 2, 4, 6, 8]


def test_time_order_cuts_a_run_of_equal_rows(spark):
    df = spark.range(0, 4000, 1, 8).selectExpr(
        "'A' AS system", "1 AS high_severity_count", "TIMESTAMP '2026-01-02' AS window_start"
    )
    ordered = ops.in_time_order(df)
    assert ordered.columns == df.columns
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = ordered.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and sum(row["count"] for row in sizes) == 4000


def test_parts_add_up(counts):
    normal, spike = counts.filter(is_normal()).count(), counts.filter(is_spike()).count()
    missing = counts.filter("high_severity_count IS NULL").count()
    assert normal + spike + missing == counts.count()
    stats = ops.system_stats(counts).filter("system = 'A'").first()
    assert stats.total_high_severity == stats.avg_per_window * counts.filter("system = 'A'").count()


def test_daily_metrics_and_overview(counts):
    texts = counts.select(*[F.col(name).cast("string") for name in counts.columns])
    day = daily_metrics(texts, "2026-01-02")
    assert day["windows"].count() == day["enriched"].count() == 6
    assert day["peak"].first().high_severity_count == 5
    assert day["spikes"].count() == 3
    assert daily_metrics(texts, "2026-01-03")["enriched"].isEmpty()
    stored = overview(typed_metrics(day["enriched"]))
    assert dict(stored["systems"].dtypes)["first_seen"] == "timestamp"
    assert [row.system for row in stored["systems"].collect()] == ["A", "B", None]
    shown = overview(counts, system="A")
    assert shown["series"].count() == 2
    assert shown["summary"].count() == 2
    assert shown["systems"].count() == 3
    assert shown["kpis"].first().spikes == 4
