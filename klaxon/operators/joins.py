"""Joins whose small side is measured before it is broadcast."""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from klaxon.session import settle

# A side may be broadcast up to both bounds; past either the join shuffles. A row's bytes are
# those of its text as JSON and of its place in the hashed table, where it has a key, a
# pointer, a length and eight bytes per column.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20
ROW_BYTES = 64
COLUMN_BYTES = 8

# When a join shuffles, rows of one key that a single task takes on.
ROWS_PER_TASK = 5_000_000


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure a settled frame: its rows, and if they are few their bytes once broadcast."""
    if df.count() > max_rows:
        return False
    fixed = ROW_BYTES + COLUMN_BYTES * len(df.columns)
    size = F.octet_length(F.to_json(F.struct("*"))) + fixed
    return df.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0] <= max_bytes


def left_join_measured(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left equi join of a large side with one expected to be much smaller.

    ``right`` is computed once, kept in the shared folder and measured. Within the bounds
    it is broadcast, so ``left`` does not move. Past them both sides shuffle, and the rows
    of hot keys spread over several tasks.
    """
    return left_join_settled(left, settle(right), on, max_rows, max_bytes, rows_per_task)


def left_join_settled(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """:func:`left_join_measured` for a right side that is settled or stored already."""
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), list(on), "left")
    return left_join_spread(left, right, on, rows_per_task)


def left_join_spread(
    left: DataFrame, right: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Left equi join that cuts hot keys of ``left`` into pieces of ``rows_per_task`` rows.

    Only the rows of hot keys are repeated on the right, once per piece. NULL keys match
    nothing but still have to come out, and are cut as well. Hot keys are broadcast within
    bounds and joined by a shuffle past them.
    """
    hot = settle(
        left.groupBy(*[F.col(name).alias(f"_hot_{name}") for name in on])
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > rows_per_task)
    )
    few = fits_broadcast(hot)
    hot = hot.withColumn("_pieces", F.ceil(F.col("_rows") / rows_per_task).cast("int"))
    # More hot keys than fit a broadcast meet their rows by a shuffle, whose large
    # partitions the adaptive skew join divides.
    keys = F.broadcast(hot) if few else hot

    def with_pieces(side: DataFrame) -> DataFrame:
        same = [side[name].eqNullSafe(hot[f"_hot_{name}"]) for name in on]
        joined = side.join(keys, _all(same), "left")
        names = [F.col(name) for name in side.columns]
        return joined.select(*names, F.coalesce("_pieces", F.lit(1)).alias("_pieces"))

    # The piece follows from the input partition, so a task that runs again cuts alike.
    cut_left = (
        left.withColumn("_part", F.spark_partition_id())
        .transform(with_pieces)
        .withColumn("_piece", F.pmod("_part", "_pieces"))
        .drop("_part", "_pieces")
    )
    cut_right = (
        right.transform(with_pieces)
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .drop("_pieces")
    )
    return cut_left.join(cut_right, [*on, "_piece"], "left").drop("_piece")


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)
