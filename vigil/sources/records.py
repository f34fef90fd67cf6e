"""JSON records: one text value per row, from topics or from files.

A topic needs Spark's Kafka connector at submit time
(``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Column with the ingest position of a topic record, used to choose among copies.
TOPIC_ORDER = ["position"]
_PARTITION_NUMBERS = 1 << 32


def ingest_position(partition: Column, offset: Column) -> Column:
    """Offset, then partition, as one number: unique within a topic, whatever their size.

    A single fixed-width column keeps the choice of the first copy a hash aggregate.
    """
    return (
        offset.cast("decimal(20,0)") * F.lit(_PARTITION_NUMBERS).cast("decimal(10,0)") + partition.cast("decimal(10,0)")
    ).cast("decimal(38,0)")


def _topic_rows(loaded: DataFrame) -> DataFrame:
    position = ingest_position(F.col("partition"), F.col("offset")).alias("position")
    return loaded.select("value", position)


def read_topic(
    spark: SparkSession, servers: str, topic: str, min_partitions: int | None = None
) -> DataFrame:
    """All records of a topic, from the earliest to the latest at read time.

    ``min_partitions`` splits a topic of few partitions into more tasks.
    """
    reader = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return _topic_rows(reader.load())


def stream_topic(
    spark: SparkSession, servers: str, topic: str, max_records: int | None = None
) -> DataFrame:
    """A topic as a stream from the earliest record, ``max_records`` per batch."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records:
        reader = reader.option("maxOffsetsPerTrigger", max_records)
    return _topic_rows(reader.load())


def topic_directory(root: str, topic: str) -> str:
    """Where ``sinks.write_topic_files`` puts a topic's records."""
    return f"{root.rstrip('/')}/topic={topic}"


def read_record_files(spark: SparkSession, path: str) -> DataFrame:
    """Records from files with one JSON object per line. They carry no ingest position."""
    return spark.read.text(path).select("value")


def stream_record_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select(F.col("value"))
