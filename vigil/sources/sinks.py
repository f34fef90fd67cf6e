"""Writing snapshots, reports and records."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, functions as F

from vigil.operators.report import summary_counts
from vigil.sources.days import Days, day_of, stored_days
from vigil.sources.storage import remove_folder


#: How text is written and read back: quotes doubled, blanks kept.
CSV_TEXT = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_csv(rows: DataFrame, path: str, set_aside: str | None = None) -> int:
    """Directory of CSV files with header lines, replacing what is there.

    The files of a sorted frame, taken by name, hold it in order. A file with a
    line break in a text could not be split over tasks: rows that have one go to
    Parquet at ``set_aside`` and their number is returned; without that folder
    the first of them fails the job. They are counted while the others are
    written, and a second pass takes place only if there are any.
    """
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    broken = reduce(or_, (F.coalesce(F.col(c).rlike(r"[\r\n]"), F.lit(False)) for c in texts), F.lit(False))

    def write(whole: DataFrame) -> None:
        whole.write.mode("overwrite").options(header=True, **CSV_TEXT).csv(path)

    if set_aside is None:
        failed = F.raise_error(F.lit("line break in CSV text"))
        write(rows.withColumns({c: F.when(broken, failed.cast("string")).otherwise(F.col(c)) for c in texts[:1]}))
        return 0
    n = counted(rows, [F.count_if(broken).alias("broken")], lambda seen: write(seen.where(~broken)))["broken"]
    if n:
        rows.where(broken).write.mode("overwrite").parquet(set_aside)
    return n


def write_parquet(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def counted(rows: DataFrame, counts: list[Column], write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write rows and return aggregates over them, taken in the same pass."""
    seen = Observation()
    write(rows.observe(seen, *counts))
    return seen.get


def _replace_days(dated: DataFrame, path: str, days: Days | None) -> None:
    """Write rows by ``date``: a whole new table, or with ``days`` only the folders of these.

    A folder of such a day that gets no rows is removed.
    """
    writer = dated.write.mode("overwrite").partitionBy("date")
    if days is None:
        return writer.parquet(path)
    spark = dated.sparkSession
    written = Observation()
    marked = dated.observe(written, F.collect_set(F.col("date").cast("string")).alias("dates"))
    writer = marked.write.mode("overwrite").partitionBy("date").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    for day in stored_days(spark, path):
        if day in days and day.isoformat() not in written.get["dates"]:
            remove_folder(spark, f"{path}/date={day}")


def write_report_by_date(report: DataFrame, path: str, days: Days | None = None) -> dict[str, int]:
    """Parquet partitioned by the UTC date of window_start, sorted within files.

    Rows are shuffled by date, where adaptive execution splits a date with much
    data over several tasks and puts small dates together. With ``days`` the
    folders of these days are replaced and all others stay. Returns the counts of
    ``alert_summary``, taken while writing.
    """
    dated = report.withColumn("date", day_of(F.unix_seconds("window_start"))).hint("rebalance", "date")
    return counted(
        dated.sortWithinPartitions("date", "server_id", "window_start"),
        summary_counts(),
        lambda rows: _replace_days(rows, path, days),
    )


def write_snapshot_by_date(snapshot: DataFrame, path: str, days: Days | None = None) -> None:
    """Parquet partitioned by the UTC date of ``ts_sec``, sorted by server and time within files.

    With ``days`` the folders of these days are replaced and all others stay.
    """
    dated = snapshot.withColumn("date", day_of(F.col("ts_sec")))
    spread = dated.hint("rebalance", "date").sortWithinPartitions("date", "server_id", "ts_sec")
    _replace_days(spread.drop("ts_sec"), path, days)


def write_topics(records: DataFrame, servers: str) -> None:
    """Send rows (topic, value) to their topics, without keys."""
    (
        records.select("topic", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .save()
    )


def write_topic_files(records: DataFrame, root: str) -> None:
    """Rows (topic, value) as JSON lines, one directory per topic under ``root``."""
    records.select("topic", "value").write.mode("overwrite").partitionBy("topic").text(root)


def write_split(flagged: DataFrame, path: str) -> None:
    """Good and bad rows in one pass: directories problem=none and problem=<reason>."""
    (
        flagged.withColumn("problem", F.coalesce("problem", F.lit("none")))
        .write.mode("overwrite")
        .partitionBy("problem")
        .parquet(path)
    )
