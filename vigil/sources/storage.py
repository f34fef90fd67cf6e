"""Folders a job writes for itself, and what lies in a folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTING = "spark.checkpoint.dir"


def job_folder(spark: SparkSession, name: str) -> str:
    """New folder for one run below the folder the session's setting names.

    Without the setting the job is refused: no folder of one machine is one that
    all executors can reach.
    """
    shared = spark.conf.get(SETTING, None)
    if not shared:
        raise ValueError(f"set {SETTING} to a folder all executors can reach")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _place(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a run's folder once its result has been read."""
    path, files = _place(spark, folder)
    files.delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    path, files = _place(spark, folder)
    return files.exists(path)


def is_folder(spark: SparkSession, path: str) -> bool:
    place, files = _place(spark, path)
    return files.exists(place) and files.getFileStatus(place).isDirectory()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders right below a folder, by one listing without a job; none if it is not there."""
    path, files = _place(spark, folder)
    return [found.getPath().getName() for found in files.listStatus(path)] if files.exists(path) else []


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, length, modified) of the files below a folder, hidden ones left out; no file is opened."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return rows.select("path", "length", F.col("modificationTime").alias("modified"))
