"""Numbers from 0 within groups of any size, without a group in one task."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from klaxon.session import settle


def partitions_of(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` with a gapless number from 0 within each group of ``keys``, as ``name``.

    A row's number is its place in its partition plus the rows of its group in the
    partitions before. Only the count of each group in each partition leaves a partition,
    so a group may hold all rows. ``df`` has to give the same rows in the same partitions
    when read twice, as a stored table does, and no nulls in ``keys``. The order within a group is that of the table.
    """
    part, place = "_part", "_place"
    # Numbers ascend within a partition, whose number stands in the upper bits.
    marked = df.withColumn("_id", F.monotonically_increasing_id())
    marked = marked.withColumn(part, F.shiftright("_id", 33))
    counts = settle(marked.groupBy(*keys, part).count())
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *keys, part, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    within = Window.partitionBy(part, *keys).orderBy("_id")
    numbered = marked.withColumn(place, F.row_number().over(within) - 1)
    matched = numbered.join(
        offsets.select(*[F.col(key).alias(f"_{key}") for key in keys], F.col(part).alias("_p"), "_before"),
        [F.col(part) == F.col("_p"), *[F.col(key) == F.col(f"_{key}") for key in keys]],
    )
    return matched.select(*df.columns, (F.col("_before") + F.col(place)).alias(name))
