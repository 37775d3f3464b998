"""Numbers behind an alert overview: per system, in total, and as a time series.

Here a window without system belongs to no system, but counts in the grand totals, and a
sum over nothing is 0.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from klaxon.functions.conversions import SPIKE_THRESHOLD, is_normal, is_spike
from klaxon.session import settle

COUNT = "high_severity_count"
ALL_SYSTEMS = "All"


def _total() -> Column:
    return F.coalesce(F.sum(COUNT), F.lit(0)).cast("bigint")


def system_summary(counts: DataFrame, threshold: int = SPIKE_THRESHOLD) -> DataFrame:
    """Total, average and number of spikes per system, ordered by system."""
    return (
        counts.filter(F.col("system").isNotNull())
        .groupBy("system")
        .agg(
            _total().alias("total_high_severity"),
            F.avg(COUNT).alias("avg_per_window"),
            F.count_if(is_spike(threshold)).alias("spikes"),
        )
        .orderBy("system")
    )


def kpis(counts: DataFrame, threshold: int = SPIKE_THRESHOLD) -> DataFrame:
    """One row: all alerts, average per window, number of spikes."""
    return counts.agg(
        _total().alias("total_incidents"),
        F.avg(COUNT).alias("avg_per_window"),
        F.count_if(is_spike(threshold)).alias("spikes"),
    )


def system_list(counts: DataFrame) -> DataFrame:
    """Distinct systems in the order of their first window, a NULL system included."""
    return (
        counts.groupBy("system")
        .agg(F.min("window_start").alias("first_seen"))
        .orderBy(F.asc_nulls_last("first_seen"), F.asc_nulls_last("system"))
    )


def select_system(counts: DataFrame, system: str = ALL_SYSTEMS) -> DataFrame:
    """Windows of one system, or all of them, those without system included."""
    return counts if system == ALL_SYSTEMS else counts.filter(F.col("system") == system)


def series(
    counts: DataFrame, threshold: int = SPIKE_THRESHOLD, system: str = ALL_SYSTEMS
) -> DataFrame:
    """Points of the time series, labelled as normal or spike; NULL counts give none."""
    label = F.when(is_normal(threshold), "normal").when(is_spike(threshold), "spike")
    return (
        select_system(counts, system)
        .filter(F.col(COUNT).isNotNull())
        .select(label.alias("series"), "system", "window_start", "window_end", COUNT)
    )


def in_time_order(counts: DataFrame) -> DataFrame:
    """Global sort by window start, then system, then whatever else a row holds.

    The input partition as last key lets the range partitioner cut a run of equal rows, so
    that no task has to sort all of it. Unlike a row number it is the same when a task runs
    again. Sort at the output only.
    """
    keys = ["window_start", "system"]
    keys += [name for name in counts.columns if name not in keys]
    return (
        counts.withColumn("_part", F.spark_partition_id())
        .orderBy(*[F.asc_nulls_last(key) for key in keys], "_part")
        .drop("_part")
    )


def with_places(ordered: DataFrame, place: str = "place") -> DataFrame:
    """A frame in global order with the place of each row from 1, without gathering its rows.

    The rows are kept partition by partition; a row's place is its own in its partition
    behind those of the partitions before, of which only the sizes come together.
    """
    number = F.monotonically_increasing_id()
    kept = settle(ordered).withColumn("_id", number).withColumn("_in", F.shiftright("_id", 33))
    before = Window.orderBy("_in").rowsBetween(Window.unboundedPreceding, -1)
    sizes = settle(kept.groupBy("_in").count()).select(
        "_in", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    # A row per partition.
    placed = kept.join(F.broadcast(sizes), "_in")
    own = F.row_number().over(Window.partitionBy("_in").orderBy("_id"))
    return placed.select(*ordered.columns, (F.col("_before") + own).cast("bigint").alias(place))
