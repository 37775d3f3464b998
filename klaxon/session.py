"""Session settings and the shared folder for tables that a job writes on its way."""

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_job_folder: ContextVar[str | None] = ContextVar("job_folder", default=None)
_local_folder: list[str] = []

# Naive event times are UTC, so the session has to be as well.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # State of many (window, system) groups stays off the JVM heap, and a commit uploads
    # the changes of a batch rather than the whole store.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Texts may be long, and a batch of 64 MB takes several times that on its way to Python.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
ENGINE_CONF[ARROW_BYTES] = str(BATCH_BYTES)


def bound_batches(spark: SparkSession) -> None:
    """Let a session of someone else's send rows to Python in batches of a few megabytes."""
    spark.conf.set(ARROW_BYTES, str(BATCH_BYTES))


def engine_session(app_name: str = "klaxon", **conf: str) -> SparkSession:
    """Session with the engine's settings; ``conf`` adds to or overrides them.

    Leave ``spark.sql.shuffle.partitions`` to the cluster, but set it on purpose before
    the first start of a stream: its state keeps that number for good.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver
    and executors are one process, may fall back to a folder of this machine, which is
    removed when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not _local_folder and context.getCheckpointDir() is not None:
        folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        if not _local_folder:
            _local_folder.append(tempfile.mkdtemp(prefix="klaxon-"))
            atexit.register(shutil.rmtree, _local_folder[0], ignore_errors=True)
        folder = _local_folder[0]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


@contextmanager
def job(spark: SparkSession, name: str) -> Iterator[str]:
    """One folder for all a job writes on its way, removed when the job ends.

    Write the job's results inside the block: they may read from the folder.
    """
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    outer = _job_folder.set(path)
    spark.sparkContext.setCheckpointDir(path)
    try:
        yield path
    finally:
        _job_folder.reset(outer)
        remove_folder(spark, path)


def _file_system(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    files, folder = _file_system(spark, path)
    files.delete(folder, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """The folders directly in a folder, by name."""
    files, folder = _file_system(spark, path)
    return sorted(one.getPath().toString() for one in files.listStatus(folder) if one.isDirectory())


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, below the job's folder or else the shared one."""
    return f"{_job_folder.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and keep the result in the shared folder.

    For small intermediate results that a plan reads more than once or has to measure.
    The result outlives the executors that computed it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    For results of any size that a job reads several times: unlike a checkpoint, the
    table gives later scans only the columns they ask for.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
