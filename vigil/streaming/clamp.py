"""The clamp in a stream whose first sample is not known beforehand.

Windows close in order of time, so the first batch that closes any holds the
earliest window of all, and with it the first sample. Its second is kept beside
the checkpoint before that batch is written, and holds for all later batches and
runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil.config import SlidingWindow
from vigil.operators.windows import first_start_of
from vigil.sources.days import day_of
from vigil.sources.storage import exists
from vigil.streaming.batches import replace_batch, run_available

#: Column with the epoch second of a window's first sample (``stream_report(first_second=True)``).
FIRST_SECOND = "first_second"


def origin_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-origin"


def stored_origin(spark: SparkSession, checkpoint: str) -> int | None:
    """The first sample's second as an earlier batch has found it; None before."""
    folder = origin_folder(checkpoint)
    if not exists(spark, f"{folder}/_SUCCESS"):
        return None
    return spark.read.schema("origin long").parquet(folder).first()[0]


def write_clamped(
    report: DataFrame,
    path: str,
    checkpoint: str,
    window: SlidingWindow,
    state_partitions: int | None = None,
    finish: Callable[[DataFrame], DataFrame] = lambda windows: windows,
) -> StreamingQuery:
    """Append complete windows to Parquet by date, without those that start before the clamp's bound; then stop.

    ``report`` comes from ``stream_report`` with ``first_second``. ``finish`` is
    called in each batch, so what it reads, such as a table of thresholds, is
    read anew. Run again with the same folders to continue where it stopped.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        origin = window.origin if window.origin is not None else stored_origin(spark, checkpoint)
        if origin is None:
            batch = batch.persist()
            origin = batch.agg(F.min(FIRST_SECOND)).first()[0]
            if origin is None:
                batch.unpersist()
                return
            found = spark.createDataFrame([(origin,)], "origin long").coalesce(1)
            found.write.mode("overwrite").parquet(origin_folder(checkpoint))
        start = F.unix_seconds("window_start")
        kept = finish(batch.where(start >= first_start_of(origin, window)).drop(FIRST_SECOND))
        replace_batch(kept.withColumn("date", day_of(start)), path, number, ["date"])
        batch.unpersist()

    return run_available(report, checkpoint, write, state_partitions)
