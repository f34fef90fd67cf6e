"""Corrections for samples that come after a stream has closed their windows.

Beside the report a second query keeps all samples, by date and batch. Samples
that may be too late for the report touch the windows they lie in. A touched
window is made anew from the kept samples, in this batch and in each later one
that brings samples of it, and replaces the stream's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from vigil import fixed_values as fixed
from vigil.config import AlertRule, SlidingWindow
from vigil.operators.join import KEYS, LEFT, RIGHT, first_of_sides
from vigil.operators.report import finish_statistics, label_timestamps, with_alert
from vigil.operators.windows import aggregate_windows, assign_windows
from vigil.plans.reports import POSITION
from vigil.sources.days import Days, day_of, days_to_reach
from vigil.sources.storage import exists
from vigil.streaming.batches import replace_batch, run_available

_WINDOW = ["server_id", "window_start"]
_TOUCHED = "server_id string, window_start long, date date, batch long"
_SAMPLE = "server_id string, ts_sec long, value float, position decimal(38,0), is_left boolean, date date, batch long"


def _slots(start: str, length: int, size: int):
    """Numbers of the spans of ``size`` seconds that ``length`` seconds from ``start`` on lie in."""
    first = F.floor(F.col(start) / size)
    return F.explode(F.sequence(first, F.floor((F.col(start) + (length - 1)) / size)))


def correct_late(
    left: DataFrame,
    right: DataFrame,
    rule: AlertRule,
    window: SlidingWindow,
    folder: str,
    checkpoint: str,
    delay_seconds: int,
    thresholds: Mapping[str, float] = fixed.THRESHOLDS,
    in_step: bool = False,
) -> StreamingQuery:
    """Keep the samples of two streams from ``stream_samples`` below ``folder`` and correct touched windows; then stop.

    A sample may be too late if it is not younger than ``delay_seconds``, the report's
    delay, before the latest of either side up to its batch. That holds for each
    sample the report drops, whatever its batches. If the caller knows that the
    report has had the same batches (``in_step``: the same files under the same
    limits), only those up to the batch before count, as in the report, so that
    a batch of many hours on time touches nothing. Writing is by batch, so a
    batch that is repeated replaces itself. A batch reads the days around its
    samples and touched windows only, and joins by the servers and times touched.
    With a clamp the origin has to be known.
    """
    if window.clamp and window.origin is None:
        raise ValueError("corrections need the window's origin, or no clamp")
    sides = [
        side.select("server_id", F.unix_seconds("ts").alias("ts_sec"), F.col(metric).alias("value"), F.col(POSITION).cast("decimal(38,0)"), F.lit(is_left).alias("is_left"))
        for side, metric, is_left in ((left, rule.left, True), (right, rule.right, False))
    ]
    samples, horizons, marks, corrections = (f"{folder}/{n}" for n in ("samples", "horizon", "touched", "corrections"))

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = Observation()
        keyed = batch.dropna(subset=KEYS).observe(seen, F.min("ts_sec").alias("first"), F.max("ts_sec").alias("last"))
        replace_batch(keyed.withColumn("date", day_of(F.col("ts_sec"))), samples, number, ["date"])
        before, horizon = _horizons(spark, seen.get["last"], horizons, number)
        if seen.get["last"] is None:
            return
        horizon = before if in_step else horizon
        bound = None if horizon is None else horizon - delay_seconds
        some_late = bound is not None and seen.get["first"] <= bound
        if not some_late and not exists(spark, marks):
            return
        # the folders of this batch alone are listed
        own = spark.read.schema(_SAMPLE).option("basePath", samples).parquet(f"{samples}/date=*/batch={number}")
        touched = assign_windows(own.where(F.col("ts_sec") <= bound), window).select(*_WINDOW)
        if number and exists(spark, marks):
            own_days = Days.of(r.date for r in own.select("date").distinct().collect())
            near = own_days.reach(before=days_to_reach(window.size - 1)).holds(F.col("date"))
            known = spark.read.schema(_TOUCHED).parquet(marks).where((F.col("batch") < number) & near)
            again = assign_windows(own, window).select(*_WINDOW).join(known, _WINDOW, "left_semi")
            touched = touched.unionByName(again)
        replace_batch(touched.distinct().withColumn("date", day_of(F.col("window_start"))), marks, number, ["date"])
        if not exists(spark, marks):
            return
        touched = spark.read.schema(_TOUCHED).parquet(marks).where(F.col("batch") == number)
        days = [r.date for r in touched.select("date").distinct().collect()]
        if days:
            fixed_windows = _windows(spark, samples, touched, days, number, rule, window, thresholds)
            replace_batch(fixed_windows.withColumn("date", day_of(F.unix_seconds("window_start"))), corrections, number, ["date"])

    return run_available(sides[0].unionByName(sides[1]), checkpoint, handle)


def _horizons(spark: SparkSession, own: int | None, folder: str, number: int) -> tuple[int | None, int | None]:
    """The latest second before a batch and up to it, whose own latest is ``own``; the second is kept by batch."""
    before = spark.read.schema("latest long").parquet(f"{folder}/batch={number - 1}").first()[0] if number else None
    horizon = max((s for s in (before, own) if s is not None), default=None)
    latest = spark.range(1).coalesce(1).select(F.lit(horizon).cast("long").alias("latest"))
    latest.write.mode("overwrite").parquet(f"{folder}/batch={number}")
    return before, horizon


def _windows(
    spark: SparkSession,
    samples: str,
    touched: DataFrame,
    days: list,
    number: int,
    rule: AlertRule,
    window: SlidingWindow,
    thresholds: Mapping[str, float],
) -> DataFrame:
    """The touched windows from all samples up to a batch."""
    near = Days.of(days).reach(after=days_to_reach(window.size - 1)).holds(F.col("date"))
    kept = spark.read.schema(_SAMPLE).parquet(samples).where((F.col("batch") <= number) & near)
    slots = touched.select("server_id", _slots("window_start", window.size, window.size).alias("slot")).distinct()
    kept = kept.withColumn("slot", F.floor(F.col("ts_sec") / window.size)).join(slots.hint("shuffle_hash"), ["server_id", "slot"], "left_semi")
    is_left = F.col("is_left")
    metrics = [F.when(is_left, F.col("value")).alias(rule.left), F.when(~is_left, F.col("value")).alias(rule.right)]
    side = F.when(is_left, LEFT).otherwise(RIGHT).cast("tinyint").alias("side")
    # a second lies in one slot, so the shuffle of the join serves the aggregate, too
    keys = ["server_id", "slot", "ts_sec"]
    joined = first_of_sides(kept.select(*keys, POSITION, *metrics, side), keys, [rule.left], [rule.right], [POSITION])
    windows = aggregate_windows(joined, window, [rule.left, rule.right])
    windows = finish_statistics(windows, rule).join(touched, _WINDOW, "left_semi")
    return with_alert(label_timestamps(windows), rule, thresholds)


def corrected(closed: DataFrame, corrections: DataFrame) -> DataFrame:
    """A stream's closed windows with those corrected in place of the stream's own.

    ``closed`` has the report's columns, ``corrections`` these and ``batch``; the
    last batch's counts. Windows after the last closed one are still the stream's.
    """
    last = closed.agg(F.max("window_start").alias("last")).scalar()
    columns = [c for c in closed.columns if c not in _WINDOW]
    latest = (
        corrections.where(F.col("window_start") <= last)
        .groupBy(*_WINDOW)
        .agg(F.max_by(F.struct(*columns), "batch").alias("row"))
        .select(*_WINDOW, "row.*")
        .select(*closed.columns)
    )
    return closed.join(latest.select(*_WINDOW), _WINDOW, "left_anti").select(*closed.columns).unionByName(latest)


def read_corrections(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """Corrections below a folder, with the columns of ``like`` and ``batch``; none if there are none yet."""
    schema = StructType([*like.schema.fields, StructField("batch", LongType())])
    path = f"{folder}/corrections"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
