"""Raw alerts: one JSON payload per row in a ``value`` column."""

from pyspark.sql import DataFrame, SparkSession

# Topic and first offset of the message source. Options of the call win.
KAFKA_DEFAULTS = {"subscribe": "incident_alerts", "startingOffsets": "earliest"}


def stream_alerts(
    spark: SparkSession, source: str = "kafka", path: str | None = None, **options: str
) -> DataFrame:
    """Unbounded stream of payloads from Kafka, text files or any other stream source.

    Kafka needs the ``spark-sql-kafka-0-10`` package of the running Spark version and the
    option ``kafka.bootstrap.servers``. One task reads one topic partition, so where a
    partition holds much of the topic set ``minPartitions`` to divide it, and bound a
    batch with ``maxOffsetsPerTrigger`` (files: ``maxFilesPerTrigger``): the first batch
    would otherwise be the whole backlog.
    """
    return _load(spark.readStream, source, path, options)


def read_alerts(
    spark: SparkSession, source: str = "text", path: str | None = None, **options: str
) -> DataFrame:
    """The same payloads as a bounded frame, for replays."""
    return _load(spark.read, source, path, options)


def _load(reader, source, path, options) -> DataFrame:
    if source == "kafka":
        options = {**KAFKA_DEFAULTS, **options}
    reader = reader.format(source).options(**options)
    return reader.load(path) if path is not None else reader.load()
