from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from klaxon.operators.joins import fits_broadcast, left_join_measured, left_join_spread
from klaxon.session import new_folder, settle, shared_folder, store


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(0, 3000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("key"),
        (F.col("id") % 2).alias("kind"),
    )
    right = left.groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n"))
    return left, right


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


# Broadcast; shuffle as rows exceed; shuffle as bytes exceed; shuffle with hot keys cut.
@pytest.mark.parametrize(
    "bounds", [{}, {"max_rows": 1}, {"max_bytes": 1}, {"max_rows": 1, "rows_per_task": 100}]
)
def test_measured_join_equals_plain_join(sides, bounds):
    left, right = sides
    expected = left.join(right, ["key", "kind"], "left")
    found = left_join_measured(left, right, ["key", "kind"], **bounds)
    assert found.columns == expected.columns
    assert rows(found) == rows(expected)


def test_broadcast_only_within_bounds(sides):
    left, right = sides

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(left_join_measured(left, right, ["key", "kind"]))
    # Hot keys are broadcast, the right side is not.
    spread = plan(left_join_measured(left, right, ["key", "kind"], max_rows=1))
    assert "SortMergeJoin" in spread or "ShuffledHashJoin" in spread


def test_spread_join_cuts_hot_and_null_keys(spark, sides):
    left, right = sides
    # 500 rows of a hot key in 8 input partitions end up in 8 pieces rather than in one.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", 64)
    try:
        joined = left_join_spread(left, right, ["key", "kind"], rows_per_task=50)
        tasks = joined.withColumn("task", F.spark_partition_id()).groupBy("key", "kind").agg(
            F.countDistinct("task").alias("tasks")
        )
        spread = {(row.key, row.kind): row.tasks for row in tasks.collect()}
        assert spread[("hot", 0)] > 3
        assert spread[(None, 0)] > 3
        assert max(n for (key, _), n in spread.items() if key and key != "hot") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 10 << 20)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_too_many_hot_keys_to_broadcast_are_joined_by_a_shuffle(sides, monkeypatch):
    left, right = sides
    expected = rows(left.join(right, ["key", "kind"], "left"))
    monkeypatch.setattr("klaxon.operators.joins.fits_broadcast", lambda df, *bounds: False)
    assert rows(left_join_spread(left, right, ["key", "kind"], rows_per_task=5)) == expected


def test_measure(spark):
    df = settle(spark.range(100))
    assert fits_broadcast(df)
    assert not fits_broadcast(df, max_rows=99)
    assert not fits_broadcast(df, max_bytes=100)
    assert fits_broadcast(settle(spark.range(0)), 0, 0)


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first != second and first.startswith(folder)


def test_a_cluster_has_to_name_its_shared_folder():
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_settled_and_stored_frames_keep_rows(spark):
    df = spark.range(10)
    assert settle(df).count() == store(df, "ids").count() == 10
