"""CSV and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from vigil.schemas import family_schema
from vigil.sources.days import Days, stored_days
from vigil.sources.sinks import CSV_TEXT


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header line that must name the schema's columns in order.

    Fields bind by position; a different header is an error, not a mix-up.
    Fields that do not parse are null. Text comes back as ``sinks.write_csv``
    took it.
    """
    return spark.read.options(header=True, enforceSchema=False, **CSV_TEXT).schema(schema).csv(path)


def read_snapshot_csv(spark: SparkSession, path: str, family: str) -> DataFrame:
    return read_csv(spark, path, family_schema(family))


def read_snapshot_parquet(
    spark: SparkSession, path: str, family: str, days: Days | None = None, dated: bool = False
) -> DataFrame:
    """A Parquet snapshot; ``days`` limit one written by date to their folders, ``dated`` keeps the date.

    Folders of other days are not looked into, so a read costs what its days have.
    """
    schema = family_schema(family)
    if days is None and not dated:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    reader = spark.read.schema(family_schema(family).add("date", "date"))
    if days is None:
        rows = reader.parquet(path)
    else:
        stored = stored_days(spark, path)
        folders = [] if days.undated else [f"{path}/date={d}" for d in stored if d in days]
        some = 0 < len(folders) < len(stored)
        rows = reader.option("basePath", path).parquet(*folders) if some else reader.parquet(path)
        rows = rows.where(days.holds(F.col("date")))
    return rows.select(*schema.names, *(["date"] if dated else []))


def read_dataset_csv(spark: SparkSession, path: str) -> DataFrame:
    """Wide CSV as text, columns named by its header in any order.

    Empty fields, and fields a short line lacks, are empty text.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
        .na.fill("")
    )
