"""What a stream of window counts still holds, and what it has dropped."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from klaxon.schema import DROPPED, WINDOW_COUNT


def open_windows(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """Windows that a stream has counted but not yet emitted, from the state in its checkpoint.

    A window comes out when the watermark passes its end, so those behind the last alerts of a
    stream that was stopped are nowhere but in its state. With what the stream has written
    they make up the counts of all alerts that were not dropped as late. The stream may run
    meanwhile; the state is that of its last finished batch. Options of Spark's state
    reader, such as ``batchId``, go through. A checkpoint without state gives no rows.
    """
    state = spark.read.format("statestore").options(**options).load(checkpoint)
    span = state.schema["key"].dataType[0].name
    key = F.col("key")
    values: StructType = state.schema["value"].dataType
    count, *others = [F.col("value").getField(field.name) for field in values]
    if others:
        # Counts under the time of all alerts keep beside whether there is a chosen one.
        state = state.filter(others[0])
    return state.select(
        key.getField("system").alias("system"),
        count.alias("high_severity_count"),
        key.getField(span).getField("start").alias("window_start"),
        key.getField(span).getField("end").alias("window_end"),
    ).to(WINDOW_COUNT)


class DroppedRows(StreamingQueryListener):
    """Writes what each batch dropped as late to a table at ``path``.

    ``spark.streams.addListener(DroppedRows(spark, path))`` before the streams start. A batch
    that dropped nothing leaves no row. What is dropped are groups: alerts of one window and
    system that came in one batch, as Spark counts them before it drops them. A batch has
    a folder of its own, replaced if its progress is reported again, by the id that the
    query keeps over restarts.
    """

    def __init__(self, spark: SparkSession, path: str):
        super().__init__()
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        dropped = sum(one.numRowsDroppedByWatermark for one in progress.stateOperators)
        if not dropped:
            return
        row = (
            str(progress.id),
            progress.name,
            progress.batchId,
            progress.eventTime.get("watermark"),
            dropped,
        )
        rows = self.spark.createDataFrame([row], DROPPED).coalesce(1)
        target = f"{self.path}/query={progress.id}/batch={progress.batchId}"
        rows.write.mode("overwrite").parquet(target)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def read_dropped(spark: SparkSession, path: str) -> DataFrame:
    """The table of :class:`DroppedRows`."""
    files = spark.read.schema(DROPPED).option("recursiveFileLookup", "true")
    return files.parquet(path).withColumn("watermark", F.to_timestamp("watermark"))
