"""Running streams: sinks, triggers and checkpoints.

A checkpoint is durable: a restart goes on where the last run stopped, and the starting
offsets of the source only apply to the first start. For a replay from the beginning pass
a new checkpoint and a new output folder.
"""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from klaxon.functions.conversions import WINDOW_DATE
from klaxon.schema import CSV
from klaxon.sinks.tables import with_window_date

TRIGGER = "10 seconds"


def start_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    path: str | None = None,
    trigger: str | None = TRIGGER,
    name: str | None = None,
    files: int | None = None,
    partition_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append a stream to a sink: ``csv`` or ``parquet`` files at ``path``, ``console``.

    ``trigger`` is the time between batches; ``None`` works off what is available and
    ends the query. ``files`` is the number of files per batch, by default one for every
    state partition that has rows. Parquet files partitioned by ``window_date`` let the
    metrics of a day skip other days.
    """
    stream = with_window_date(stream, partition_by)
    if files is not None:
        stream = stream.repartition(files)
    writer = _writer(stream, checkpoint, trigger, name).format(sink)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if sink == "csv":
        writer = writer.options(**CSV)
    if sink == "console":
        writer = writer.option("truncate", False)
    return writer.start(path) if path is not None else writer.start()


def start_both(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    console_rows: int = 20,
    name: str | None = None,
    files: int | None = None,
    sink: str = "parquet",
) -> StreamingQuery:
    """Append a stream of window counts to files and show it, from one read and one state store.

    Each batch goes to its own folder ``batch_id=N`` and replaces what an attempt that
    failed may have left there, so a restart neither loses nor repeats rows. Numbers of
    batches belong to a checkpoint, so ``path`` does too: a query with another checkpoint
    fails on its first batch rather than replace foreign ones. Parquet, the default, keeps
    every text as it is and is partitioned by ``window_date``; CSV is for export.

    A batch is written in as many tasks as its size asks for, which is one file per day unless it
    is large; ``files`` sets their number. The console is a display only: it gets
    the first ``console_rows`` rows of a batch, if any, and all rows are in the files.
    """
    owned = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not owned:
            owned.append(_own(spark, path))
        target = f"{path.rstrip('/')}/batch_id={batch_id}"
        # Without a number Spark joins the partitions of small batches and splits large ones.
        rows = batch.hint("rebalance") if files is None else batch.repartition(files)
        if sink == "csv":
            rows.write.mode("overwrite").options(**CSV).csv(target)
        else:
            rows = with_window_date(rows, [WINDOW_DATE])
            rows.write.mode("overwrite").partitionBy(WINDOW_DATE).format(sink).save(target)
        if console_rows == 0:
            return
        # Show what was written rather than compute the batch again.
        reader = spark.read.schema(batch.schema)
        reader = reader.options(**CSV) if sink == "csv" else reader
        print(f"Batch: {batch_id}")
        reader.format(sink).load(target).show(console_rows, truncate=False)

    return _writer(stream, checkpoint, trigger, name).foreachBatch(write).start()


def start_checked(
    checked: DataFrame,
    path: str,
    quarantine: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    name: str | None = None,
) -> StreamingQuery:
    """Append sound alerts of a stream (``checked_alerts``) to ``path``, the others to ``quarantine``.

    Both are Parquet tables with a folder ``batch_id=N`` for each batch, which a batch that runs
    again replaces, so a restart neither loses nor repeats rows on either side. The folders
    belong to one query, as those of :func:`start_both`. The quarantine keeps payload and
    problem, from which the alerts can be sent again once mended; a batch without such
    payloads leaves no folder there.
    """
    owned = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not owned:
            owned.extend([_own(spark, path), _own(spark, quarantine)])
        # Parsed once for both; what an executor loses with its cache is parsed again.
        batch = batch.persist()
        try:
            sound = batch.filter("problem IS NULL").drop("payload", "problem")
            sound.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
            others = batch.filter("problem IS NOT NULL").select("payload", "problem")
            target = f"{quarantine.rstrip('/')}/batch_id={batch_id}"
            if not others.isEmpty():
                others.write.mode("overwrite").parquet(target)
        finally:
            batch.unpersist()

    return _writer(checked, checkpoint, trigger, name).foreachBatch(write).start()


def _own(spark, path: str) -> str:
    """Claim an output folder for the running query, or fail if another one has it."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    mark = f"{path.rstrip('/')}/_query"
    try:
        owner = spark.read.text(mark).first()[0]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        # Nothing is replaced: of two queries that start at once, one fails here.
        spark.createDataFrame([(query,)], "value string").coalesce(1).write.text(mark)
        return query
    if owner != query:
        raise ValueError(f"{path} belongs to the streaming query {owner}: take a new folder")
    return owner


def _writer(
    stream: DataFrame, checkpoint: str, trigger: str | None, name: str | None
) -> DataStreamWriter:
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)
