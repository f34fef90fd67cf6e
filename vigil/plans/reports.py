"""Window reports with alerts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from vigil import fixed_values as fixed
from vigil.config import CPU_MEM, NET_DISK, AlertRule, SlidingWindow
from vigil.functions.timestamps import parsed_once
from vigil.operators.dedupe import sample_position
from vigil.operators.join import KEYS, merge_copies, merge_first
from vigil.operators.report import (
    collapse_time_of_day,
    finish_statistics,
    label_timestamps,
    versioned,
    with_alert,
)
from vigil.operators.windows import aggregate_windows
from vigil.sources.days import Days, day_of

Thresholds = Mapping[str, float] | DataFrame


#: Column with a sample's place among repeats where the rows have no ingest position.
POSITION = "position"


def samples(rows: DataFrame, metric: str, timestamps: str, order: list[str] | None = None) -> DataFrame:
    """Decoded or snapshot rows as (server_id, ts_sec, metric, order columns).

    Without order columns, ``position`` puts the earliest of a second first.
    """
    place = [F.col(o) for o in order or []]
    place = place or [sample_position(F.unix_micros("parsed"), metric).alias(POSITION)]
    second = F.unix_seconds("parsed").alias("ts_sec")
    return parsed_once(rows, timestamps).select("server_id", second, metric, *place)


def window_statistics(
    left: DataFrame,
    right: DataFrame,
    rule: AlertRule,
    window: SlidingWindow = SlidingWindow(),
    order: list[str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Averages and maxima per server and window, over samples both sides have.

    Window bounds are epoch seconds.
    """
    if rule.duplicates == "first":
        joined = merge_first(
            left.select(*KEYS, rule.left, *(order or [])),
            right.select(*KEYS, rule.right, *(order or [])),
            order,
        )
    elif rule.duplicates == "multiply":
        joined = merge_copies(left.select(*KEYS, rule.left), right.select(*KEYS, rule.right), exact=True)
    else:
        raise ValueError(f"unknown treatment of duplicates: {rule.duplicates}")
    windows = aggregate_windows(
        joined, window, [rule.left, rule.right], summed=rule.duplicates == "multiply", ranges=ranges
    )
    return finish_statistics(windows, rule, ["range"] if ranges else [])


def report(
    left: DataFrame,
    right: DataFrame,
    rule: AlertRule,
    window: SlidingWindow = SlidingWindow(),
    thresholds: Thresholds = fixed.THRESHOLDS,
    order: list[str] | None = None,
    labels: str = "timestamp",
    duplicates: str | None = None,
    zone: str | None = None,
    days: Days | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Window statistics with alert text.

    ``duplicates`` replaces the rule's treatment of repeated samples: raw records
    instead of snapshots are reported right with "first".

    ``labels`` is "timestamp", "epoch" (seconds) or "time_of_day" (HH:mm:ss
    text, one row per server and label, on the clock of ``zone`` or else the
    session's). ``days`` keeps windows that start on these days (UTC).
    ``ranges`` gives the report in so many partitions and in total order by server
    and window start; their bounds come from counts in the same plan, where
    ``sort_report`` has Spark run the last stage once more to find them.
    """
    if duplicates:
        rule = replace(rule, duplicates=duplicates)
    if ranges and labels == "time_of_day":
        raise ValueError("ranges are in the order of windows, not of times of day")
    windows = window_statistics(left, right, rule, window, order, ranges)
    if days is not None:
        windows = windows.where(days.holds(day_of(F.col("window_start"))))
    if labels == "time_of_day" and versioned(thresholds):
        # the labels no longer say which version holds
        return collapse_time_of_day(with_alert(windows, rule, thresholds), window.size, zone)
    if labels == "time_of_day":
        windows = collapse_time_of_day(windows, window.size, zone)
    elif labels == "timestamp":
        windows = label_timestamps(windows)
    elif labels != "epoch":
        raise ValueError(f"unknown labels: {labels}")
    judged = with_alert(windows, rule, thresholds)
    if not ranges:
        return judged
    placed = judged.repartitionById(ranges, F.col("range"))
    return placed.sortWithinPartitions("server_id", "window_start").drop("range")


def cpu_mem_report(cpu: DataFrame, mem: DataFrame, order: list[str] | None = None, **settings) -> DataFrame:
    """Report on CPU and memory rows (ts, server_id, metric, order columns).

    ``settings`` are those of ``report``.
    """
    return _family_report(cpu, mem, CPU_MEM, order, settings)


def net_disk_report(net: DataFrame, disk: DataFrame, order: list[str] | None = None, **settings) -> DataFrame:
    """Report on network and disk rows; repeated samples multiply, as in a plain join."""
    return _family_report(net, disk, NET_DISK, order, settings)


def _family_report(left, right, rule, order, settings):
    return report(
        samples(left, rule.left, rule.timestamps, order),
        samples(right, rule.right, rule.timestamps, order),
        rule,
        order=order or [POSITION],
        **settings,
    )
