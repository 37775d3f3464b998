"""Batch sinks."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klaxon.functions.conversions import WINDOW_DATE, as_window_date
from klaxon.functions.payload import encode_alerts
from klaxon.schema import CSV
from klaxon.session import settle, store

# Folders of a corpus that is kept up by key, and the column that names them.
BUCKETS = 256
BUCKET, LAYOUT = "corpus_bucket", "corpus_buckets"


def with_window_date(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Add the day a window starts on, where a table is to be partitioned by it."""
    if WINDOW_DATE not in partition_by or WINDOW_DATE in rows.columns:
        return rows
    return rows.withColumn(WINDOW_DATE, as_window_date(F.col("window_start")))


def write_alerts(
    alerts: DataFrame,
    sink: str = "kafka",
    path: str | None = None,
    key: str | None = None,
    **options: str,
) -> None:
    """Append alerts as JSON payloads, to Kafka (options ``kafka.bootstrap.servers`` and
    ``topic``) or to text files at ``path``, where a stream of alerts can read them."""
    writer = encode_alerts(alerts, key).write.format(sink).mode("append").options(**options)
    writer.save(path) if path is not None else writer.save()


def write_metrics(
    metrics: DataFrame,
    path: str,
    file_format: str = "csv",
    partition_by: Sequence[str] = (),
    single_file: bool = False,
    replace: str = "table",
) -> None:
    """Replace the metrics at ``path``, as CSV with header or as Parquet.

    With ``replace="partitions"`` only those folders are replaced for which there are rows, so
    a day can be computed again without touching the others.

    ``single_file`` sends every row through one task; leave it off unless the result is
    known to be small. Partitioned by ``window_date``, which is derived where it is
    missing, a table lets ``for_day`` skip the folders of other days.
    """
    if replace not in ("table", "partitions") or (replace == "partitions" and not partition_by):
        raise ValueError("replace is table, or partitions where partition_by names some")
    metrics = with_window_date(metrics, partition_by)
    rows = metrics.coalesce(1) if single_file else metrics
    writer = rows.write.mode("overwrite").partitionBy(*partition_by)
    # Stated either way, as a session may have another default.
    mode = "dynamic" if replace == "partitions" else "static"
    writer = writer.option("partitionOverwriteMode", mode)
    if file_format == "csv":
        writer = writer.options(**CSV)
    writer.format(file_format).save(path)


def write_vectors(
    vectors: DataFrame, path: str, key: str = "incident_id", vector: str = "embedding"
) -> int:
    """Replace the vector corpus at ``path`` and return its number of rows.

    The table holds key, vector and all other columns, so that a neighbour's id leads to
    its description and resolution. A repeated key is a row of its own, as in a search; a
    row without key could never be named and is refused. The number comes from the
    written file footers.
    """
    for name in (key, vector):
        if name not in vectors.columns:
            raise ValueError(f"the vector table needs a column {name}")
    named = F.assert_true(F.col(key).isNotNull(), F.lit(f"a vector has no {key}")).isNull()
    vectors.filter(named).write.mode("overwrite").parquet(path)
    return vectors.sparkSession.read.parquet(path).count()


def upsert_vectors(
    vectors: DataFrame,
    path: str,
    key: str = "incident_id",
    buckets: int = BUCKETS,
    vector: str = "embedding",
) -> int:
    """Add rows to the vector corpus at ``path``, in place of those with the same key; return the
    number of buckets that were written.

    The corpus is partitioned by a hash of the key, and only buckets that get a new or
    changed row are read and written again; files of the others stay. The first call makes the
    corpus and fixes the number of buckets. A corpus has one row per key: of several new
    rows with one key the last stands, by all their columns in order. A bucket is replaced
    as a folder when all are written, so a call that fails leaves the old rows, and may be
    repeated.
    """
    spark = vectors.sparkSession
    for name in (key, vector):
        if name not in vectors.columns:
            raise ValueError(f"the vector table needs a column {name}")
    named = F.assert_true(F.col(key).isNotNull(), F.lit(f"a vector has no {key}")).isNull()
    known = _corpus_at(spark, path)
    if known is not None:
        buckets = known.select(LAYOUT).first()[0]
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)
    others = [name for name in vectors.columns if name != key]
    newest = F.max(F.struct(*others)).alias("_row")
    fresh = vectors.filter(named).groupBy(key).agg(newest).select(key, "_row.*")
    fresh = settle(fresh.select(*vectors.columns, bucket))
    touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]
    rows = fresh
    if known is not None:
        kept = known.filter(F.col(BUCKET).isin(touched)).join(fresh, [BUCKET, key], "left_anti")
        rows = fresh.unionByName(kept.select(*fresh.columns))
    # Written elsewhere first, as the buckets cannot be read while they are replaced.
    rows = store(rows, "merged").withColumn(LAYOUT, F.lit(buckets))
    writer = rows.repartition(BUCKET).write.mode("overwrite").partitionBy(LAYOUT, BUCKET)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return len(touched)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The corpus that :func:`upsert_vectors` keeps, without its layout."""
    return spark.read.parquet(path).drop(LAYOUT, BUCKET)


def _corpus_at(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
