"""Writing a stream batch by batch, so that a batch that is repeated replaces itself."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

_PARTITIONS = "spark.sql.shuffle.partitions"


def replace_batch(rows: DataFrame, path: str, batch: int, by: list[str]) -> None:
    """Write a batch's rows to Parquet folders by some columns, then by batch.

    Only the folders of this batch are replaced, so doing it again after a
    failure leaves one copy.
    """
    numbered = rows.withColumn("batch", F.lit(batch).cast("long"))
    writer = numbered.write.mode("overwrite").partitionBy(*by, "batch").option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def run_available(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    state_partitions: int | None = None,
    output: str = "append",
) -> StreamingQuery:
    """Hand all batches there are to ``handle``, then stop. Run again to continue.

    A batch that failed is handed over again with the same number and rows. The
    first run fixes how many partitions state has: ``state_partitions``, or else
    the session's shuffle partitions.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).outputMode(output)
    return start(writer.trigger(availableNow=True), stream, state_partitions)


def start(writer, stream: DataFrame, state_partitions: int | None) -> StreamingQuery:
    """Start a writer whose query takes its own number of state partitions."""
    if state_partitions is None:
        return writer.start()
    conf = stream.sparkSession.conf
    usual = conf.get(_PARTITIONS)
    conf.set(_PARTITIONS, state_partitions)
    try:
        # A query takes its copy of the settings when it starts.
        return writer.start()
    finally:
        conf.set(_PARTITIONS, usual)
