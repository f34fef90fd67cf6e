"""The window reports as incremental jobs.

Samples are kept once per server and second, joined and aggregated as event
time passes; a window is written when the watermark has passed its end. Without
a known origin windows before the first sample stay, and ``streaming.clamp``
drops them as they are written.
"""

from __future__ import annotations

from collections.abc import Mapping

from math import gcd

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from vigil import fixed_values as fixed
from vigil.config import AlertRule, SlidingWindow
from vigil.functions.timestamps import parsed_once
from vigil.operators.dedupe import sample_position
from vigil.operators.join import both_sides, first_of_sides, sums_of
from vigil.operators.report import finish_statistics, with_alert
from vigil.operators.windows import combined_sums, first_start
from vigil.plans.reports import POSITION
from vigil.streaming.batches import start

_KEYS = ["server_id", "ts"]


def stream_samples(rows: DataFrame, metric: str, timestamps: str, order: str | None = None) -> DataFrame:
    """Decoded stream rows as (server_id, ts, metric, position), ts cut to the second.

    Position is the order column, else what the batch plans use without one.
    """
    place = F.col(order) if order else sample_position(F.unix_micros("parsed"), metric)
    second = F.date_trunc("second", "parsed").alias("ts")
    return parsed_once(rows, timestamps).select("server_id", second, metric, place.alias(POSITION))


def unique_samples(samples: DataFrame, metric: str, delay: str) -> DataFrame:
    """One sample per server and second: that of the lowest position, as in batch,
    chosen when the watermark has passed the second."""
    return _marked(samples, delay).groupBy(*_KEYS).agg(F.min_by(metric, POSITION).alias(metric))


def _marked(samples: DataFrame, delay: str) -> DataFrame:
    return samples.dropna(subset=_KEYS).withWatermark("ts", delay)


def _merged_samples(left: DataFrame, right: DataFrame, rule: AlertRule, delay: str) -> DataFrame:
    """``unique_samples`` of both sides, joined, by one aggregate."""
    sides = both_sides(_marked(left, delay), _marked(right, delay), _KEYS)
    return first_of_sides(sides, _KEYS, [rule.left], [rule.right], [POSITION])


def stream_report(
    left: DataFrame,
    right: DataFrame,
    rule: AlertRule,
    window: SlidingWindow = SlidingWindow(),
    thresholds: Mapping[str, float] | None = fixed.THRESHOLDS,
    delay: str = "1 minute",
    first_second: bool = False,
    merged: bool = False,
) -> DataFrame:
    """Streaming report on two sample streams from ``stream_samples``.

    Samples are summed by pane, the longest step that divides window and slide,
    and panes by window, so a sample goes through one shuffle once.
    ``first_second`` adds the epoch second of each window's first sample;
    without ``thresholds`` windows have no alert yet. ``merged`` keeps both sides
    in one state, a fraction of those of two sides and their join; the windows
    are the same, but ``late_rows`` counts late rows of both sides of a second as one.
    """
    if window.slide > window.size:
        raise ValueError("streaming windows must not have gaps between them")
    if merged:
        joined = _merged_samples(left, right, rule, delay)
    else:
        joined = unique_samples(left, rule.left, delay).join(unique_samples(right, rule.right, delay), _KEYS)
    pane = gcd(window.size, window.slide)
    panes = joined.groupBy(
        "server_id", F.window("ts", f"{pane} seconds", startTime=f"{window.offset % pane} seconds").alias("pane")
    ).agg(*sums_of(rule.left), *sums_of(rule.right), F.min("ts").alias("first_ts"))
    spans = F.window(
        F.window_time("pane"), f"{window.size} seconds", f"{window.slide} seconds", f"{window.offset % window.slide} seconds"
    )
    windows = (
        panes.groupBy("server_id", spans.alias("span"))
        .agg(*combined_sums([rule.left, rule.right]), F.unix_seconds(F.min("first_ts")).alias("first_second"))
        .withColumns({"window_start": F.col("span.start"), "window_end": F.col("span.end")})
    )
    windows = finish_statistics(windows, rule, ["first_second"] if first_second else [])
    if window.clamp and window.origin is not None:
        bound = F.timestamp_seconds(first_start(F.lit(window.origin), window))
        windows = windows.where(F.col("window_start") >= bound)
    return windows if thresholds is None else with_alert(windows, rule, thresholds)


def late_rows(query: StreamingQuery) -> int:
    """Wait for a query to stop; how many rows came after the watermark had passed them.

    Progress is read while the query runs, since Spark keeps the last reports only.
    """
    dropped: dict[int, int] = {}
    running = True
    while running:
        running = not query.awaitTermination(5)
        for progress in query.recentProgress:
            dropped[progress["batchId"]] = sum(s["numRowsDroppedByWatermark"] for s in progress["stateOperators"])
    return sum(dropped.values())


def with_tail(closed: DataFrame, batch: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """A stream's closed windows and, from the batch report, those still open when it stopped.

    Windows close in order of time, so the open ones start after the last closed one.
    ``written`` are the windows as the stream has written them, where ``closed`` is
    made of these: the last of both is the same, and is found without making ``closed`` twice.
    """
    last = (closed if written is None else written).agg(F.max("window_start").alias("last")).scalar()
    return closed.unionByName(batch.where(last.isNull() | (F.col("window_start") > last)))


def write_available(
    report: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Append all windows that are complete to Parquet by date, then stop.

    Run again with the same folders to continue where it stopped. The first run
    fixes how many partitions the state has: ``state_partitions``, or else the
    session's shuffle partitions. Each batch visits all of them, so about one
    per core serves best.
    """
    writer = (
        report.withColumn("date", F.to_date("window_start"))
        .writeStream.format("parquet")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    return start(writer, report, state_partitions)
