"""Streams before the reports: wide rows to topic records, and records by problem."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.operators.decode import flag_problems, with_second
from vigil.schemas import dataset_columns
from vigil.sources.storage import exists
from vigil.streaming.batches import replace_batch, run_available, start


def stream_dataset_csv(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Wide CSV files as a stream of text rows, ``max_files`` per batch.

    Headers must name the dataset's columns in order, since a stream's columns
    are fixed before its files are there; a file with another header is refused.
    """
    reader = spark.readStream.option("header", True).option("enforceSchema", False).option("escape", '"')
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(", ".join(f"{c} string" for c in dataset_columns())).csv(path).na.fill("")


def write_topic_stream(records: DataFrame, root: str, checkpoint: str) -> StreamingQuery:
    """Append rows (topic, value) as JSON lines, one folder per topic under ``root``, then stop.

    The sink's own log below ``root`` lists the files of finished batches. A
    batch that is repeated after a failure is not written twice; files of one
    that failed are not in the log, and readers of ``root`` leave them out.
    """
    writer = (
        records.select("topic", "value")
        .writeStream.format("text")
        .partitionBy("topic")
        .option("path", root)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    return start(writer, records, None)


def read_topic_stream(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """Records (topic, value) that ``write_topic_stream`` has finished; of one topic, its folder alone is read."""
    rows = spark.read.schema("value string, topic string").text(root)
    return rows if topic is None else rows.where(F.col("topic") == topic)


def write_split_stream(rows: DataFrame, timestamps: str, path: str, checkpoint: str) -> StreamingQuery:
    """Decoded rows of a stream by problem: folders problem=none and problem=<reason>, then by batch.

    Each record is decoded once and lands in one folder; good and bad rows of a
    batch are replaced together if it is repeated. How many rows of each problem
    came is told by ``problem_counts``.
    """
    flagged = flag_problems(with_second(rows, timestamps))

    def write(batch: DataFrame, number: int) -> None:
        replace_batch(batch.withColumn("problem", F.coalesce("problem", F.lit("none"))), path, number, ["problem"])

    return run_available(flagged.observe("problems", *_counts()), checkpoint, write)


PROBLEMS = ("undecodable", "no server", "bad timestamp")


def _counts():
    named = [F.count_if(F.col("problem") == p).alias(p) for p in PROBLEMS]
    return [F.count_if(F.col("problem").isNull()).alias("none"), *named]


def problem_counts(query: StreamingQuery) -> dict[str, int]:
    """Wait for a query of ``write_split_stream`` to stop; rows of each problem it has seen."""
    seen: dict[int, dict[str, int]] = {}
    running = True
    while running:
        running = not query.awaitTermination(5)
        for progress in query.recentProgress:
            counts = progress["observedMetrics"].get("problems")
            if counts:
                seen[progress["batchId"]] = counts.asDict() if hasattr(counts, "asDict") else dict(counts)
    return {name: sum(c[name] for c in seen.values()) for name in ("none", *PROBLEMS)}


def read_split(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that ``write_split_stream`` has written, with ``problem`` and ``batch``."""
    whole = f"{schema}, ts_sec long, problem string, batch long"
    return spark.read.schema(whole).parquet(path) if exists(spark, path) else spark.createDataFrame([], whole)
