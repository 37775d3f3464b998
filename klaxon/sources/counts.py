"""Window counts and metrics as Parquet or CSV files."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klaxon.functions.conversions import WINDOW_DATE, as_count, as_window_time
from klaxon.schema import CSV_READ, METRIC, WINDOW_COUNT_TEXT
from klaxon.session import folders_in

# Columns every overview needs. Where a file has none, 0 stands in: the text "0", the
# number 0, the start of the epoch.
EXPECTED = ("system", "high_severity_count", "window_start", "window_end")


def read_counts(
    spark: SparkSession, path: str, all_runs: bool = False, file_format: str = "parquet"
) -> DataFrame:
    """Window counts that a stream wrote, every column of CSV files as text.

    ``path`` is the folder of one run, which also honours the commit log of the sink, or
    with ``all_runs`` a folder of such folders. Several runs over the same alerts hold
    the same windows, which then count once per run. A table by ``window_date`` keeps that
    column, so that the metrics of a day read its folders only.
    """
    if file_format != "csv":
        # Every run has columns among its folders, so each is a table of its own.
        runs = folders_in(spark, path) if all_runs else [path]
        tables = [spark.read.format(file_format).load(run) for run in runs]
        date = [WINDOW_DATE] if all(WINDOW_DATE in rows.columns for rows in tables) else []
        return union_runs(*[rows.select(*WINDOW_COUNT_TEXT.fieldNames(), *date) for rows in tables])
    reader = spark.read.schema(WINDOW_COUNT_TEXT).options(**CSV_READ)
    # Columns are matched by position; a header in another order has to fail, not mix.
    reader = reader.option("enforceSchema", False)
    if all_runs:
        reader = reader.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    # The sink may have left a folder per batch, which reads as one more column.
    return reader.csv(path).select(*WINDOW_COUNT_TEXT.fieldNames())


def read_metrics(spark: SparkSession, path: str, drifting: bool = False) -> DataFrame:
    """Metrics from the CSV files directly in a folder, typed and with all columns needed.

    All files have the same header unless ``drifting`` says otherwise; then one pass over
    the text finds the headers, and files are read per header and united by column name.
    A folder without CSV files gives an empty frame.
    """
    groups = _files_by_header(spark, path) if drifting else [path]
    frames = [frame for group in groups if (frame := _read_csv(spark, group)) is not None]
    if not frames:
        return spark.createDataFrame([], METRIC)
    return backfill(typed_metrics(union_runs(*frames)))


def union_runs(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, by column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def typed_metrics(metrics: DataFrame, strict: bool = True) -> DataFrame:
    """Numbers and window bounds from text. Bad bounds fail if ``strict``, else are NULL."""
    columns = []
    for name in metrics.columns:
        column = F.col(name)
        if metrics.schema[name].dataType.typeName() == "string":
            if name == "high_severity_count":
                column = as_count(column)
            elif name in ("window_start", "window_end"):
                column = as_window_time(column, strict)
            elif name in METRIC.fieldNames():
                column = column.try_cast(METRIC[name].dataType)
        columns.append(column.alias(name))
    return metrics.select(columns)


def backfill(metrics: DataFrame) -> DataFrame:
    """Add the expected columns that are missing, filled with 0 in the column's type."""
    for name in EXPECTED:
        if name not in metrics.columns:
            metrics = metrics.withColumn(name, F.lit(0).cast(METRIC[name].dataType))
    return metrics


def _read_csv(spark: SparkSession, path: str | list[str]) -> DataFrame | None:
    """CSV files as text columns named by their header, or None if there are none."""
    reader = spark.read.options(**CSV_READ).option("pathGlobFilter", "*.csv")
    try:
        names = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    schema = ", ".join(f"`{name}` string" for name in names)
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Paths of the CSV files in a folder, grouped by first line.

    Only the paths reach the driver, which lists them anyway for any read.
    """
    lines = (
        spark.read.option("pathGlobFilter", "*.csv")
        .text(path)
        .filter(F.col("_metadata.file_block_start") == 0)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("position"),
        )
    )
    first_lines = lines.groupBy("file").agg(F.min_by("value", "position").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first_lines.orderBy("file").toLocalIterator():
        groups.setdefault(row.header, []).append(row.file)
    return list(groups.values())
