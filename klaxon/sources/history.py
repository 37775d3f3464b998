"""Resolved incidents of the past."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from klaxon.schema import CSV_READ, HISTORY


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """CSV files with header, columns by name; one that no file has is NULL.

    Quoted texts may hold line breaks and doubled quotes. All files of a call have the same
    header; files with another one are an error rather than mixed up.
    """
    reader = spark.read.options(**CSV_READ)
    names = reader.csv(path).columns
    schema = ", ".join(f"`{name}` string" for name in names)
    rows = reader.schema(schema).option("enforceSchema", False).csv(path)
    return rows.select(
        *[
            (F.col(f"`{field.name}`") if field.name in names else F.lit(None))
            .try_cast(field.dataType)
            .alias(field.name)
            for field in HISTORY.fields
        ]
    )
