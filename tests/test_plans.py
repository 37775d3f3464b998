"""Physical plans of the registered queries: what reaches the scan and what moves."""

import os
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from klaxon import operators, sinks
from klaxon.operators.embedding import embed

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not here")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def plan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    yield lambda name: plan_of(entry_module.queries()[name](spark, SF_DIR))
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def scan(text):
    return re.search(r"FileScan parquet \[(.*?)\].*PushedFilters: \[(.*?)\], ReadSchema: (.*)", text)


def test_filters_and_columns_reach_the_scan(plan):
    columns, pushed, _ = scan(plan("window_counts")).groups()
    assert "GreaterThanOrEqual(value,50.0)" in pushed and "IsNotNull(ts)" in pushed
    assert "event_type" not in columns and "props" not in columns
    pushed = scan(plan("day_windows")).group(2)
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in pushed and "LessThan(ts,2024-01-03T00:00)" in pushed


@pytest.mark.parametrize(
    "name,exchanges",
    [
        ("severity_filter", 0),
        ("window_counts", 1),
        ("decode_json", 0),
        ("system_stats", 2),
        ("kpis", 2),
        ("incident_text", 0),
        ("knn_exact", 0),
    ],
)
def test_number_of_shuffles(plan, name, exchanges):
    text = plan(name)
    assert len(re.findall(r"Exchange (?:hash|range|Single)", text)) == exchanges
    assert text.count("FileScan") == 1


# Queries of the optional package have tests of their own beside it.
OWN = sorted(name for name in entry_module.queries() if not re.match(r"op\d+_|pipeline$", name))


@pytest.mark.parametrize("name", OWN)
def test_no_cross_join_and_no_collected_groups(plan, name):
    text = plan(name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "ArrowEvalPython", "BatchEvalPython"):
        assert operator not in text


def test_embedding_moves_nothing(spark):
    text = plan_of(embed(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["spike_check", "indexed_count"])
def test_results_stay_in_the_plan(plan, name):
    assert "FileScan" in plan(name)


def test_enriching_moves_only_the_statistics(plan):
    text = plan("enriched_metrics")
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text


def test_a_day_of_a_partitioned_table_reads_one_folder(spark, tmp_path):
    rows = [("A", day, datetime(2026, 1, day, 10)) for day in range(1, 6)]
    counts = spark.createDataFrame(rows, "system string, high_severity_count int, window_start timestamp")
    sinks.write_metrics(counts, str(tmp_path / "t"), "parquet", partition_by=["window_date"])
    day = operators.for_day(spark.read.parquet(str(tmp_path / "t")), "2026-01-03")
    assert [row.high_severity_count for row in day.collect()] == [3]
    assert len(day.inputFiles()) == 5 and "PartitionFilters: [isnotnull(window_date" in plan_of(day)


def test_a_day_on_typed_bounds_reaches_the_scan(spark, plan, tmp_path):
    for kind in ("timestamp", "timestamp_ntz"):
        path = str(tmp_path / kind)
        spark.range(3).select(F.timestamp_seconds("id").cast(kind).alias("window_start")).write.parquet(path)
        text = plan_of(operators.for_day(spark.read.parquet(path), "1970-01-01"))
        assert "GreaterThanOrEqual(window_start" in text and "LessThan(window_start" in text
