"""Reports of some days, from snapshots written by date.

A window belongs to the day its start lies on and may reach into the next. So a
report of some days reads these and as many after as a window reaches, and keeps
the windows that start on the days asked for; a changed day of a snapshot touches
windows from as many days before. The clamp needs the first sample of all days,
which is looked for from the earliest day on.
"""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from vigil import fixed_values as fixed
from vigil.config import AlertRule, SlidingWindow
from vigil.operators.join import merge_first
from vigil.operators.windows import first_start_of
from vigil.plans.reports import POSITION, Thresholds, report, samples
from vigil.sources.days import Days, days_to_reach, stored_days
from vigil.sources.sinks import write_report_by_date
from vigil.sources.storage import exists
from vigil.sources.tables import read_snapshot_parquet

_ORIGIN = "_origin"


def _sides(
    spark: SparkSession, rule: AlertRule, paths: tuple[str, str], families: tuple[str, str], days: Days | None
) -> list[DataFrame]:
    return [
        samples(read_snapshot_parquet(spark, path, family, days=days), metric, rule.timestamps)
        for path, family, metric in zip(paths, families, (rule.left, rule.right))
    ]


def snapshot_origin(
    spark: SparkSession, rule: AlertRule, paths: tuple[str, str], families: tuple[str, str]
) -> int | None:
    """Second of the first sample that both snapshots have; None if there is none.

    Only days that both have can hold it. They are searched from the first on,
    twice as many at a time, so that usually one day is read.
    """
    both = sorted(set.intersection(*(set(stored_days(spark, p)) for p in paths)))
    begin, n = 0, 1
    while begin < len(both):
        left, right = _sides(spark, rule, paths, families, Days.of(both[begin : begin + n]))
        first = merge_first(left, right, [POSITION]).agg(F.min("ts_sec")).first()[0]
        if first is not None:
            return first
        begin, n = begin + n, 2 * n
    return None


def report_of_days(
    spark: SparkSession,
    rule: AlertRule,
    paths: tuple[str, str],
    families: tuple[str, str],
    days: Days,
    window: SlidingWindow = SlidingWindow(),
    thresholds: Thresholds = fixed.THRESHOLDS,
    **settings,
) -> DataFrame:
    """The windows of a whole report that start on some days (UTC).

    ``paths`` are Parquet snapshots written by date; ``settings`` are those of
    ``plans.reports.report``. Without ``window.origin`` it is looked up.
    """
    if window.clamp and window.origin is None:
        # without any sample there are no windows to clamp
        window = replace(window, origin=snapshot_origin(spark, rule, paths, families) or 0)
    needed = days.reach(after=days_to_reach(window.size - 1))
    left, right = _sides(spark, rule, paths, families, needed)
    return report(left, right, rule, window, thresholds, [POSITION], days=days, **settings)


def report_each_day(
    spark: SparkSession,
    rule: AlertRule,
    paths: tuple[str, str],
    families: tuple[str, str],
    out: str,
    days: Iterable[date],
    window: SlidingWindow = SlidingWindow(),
    thresholds: Thresholds = fixed.THRESHOLDS,
    at_once: int = 4,
    **settings,
) -> dict[date, dict[str, int]]:
    """Report each day alone into its folder of a report written by date; the counts of each.

    A day's jobs are small beside a cluster, so ``at_once`` days are under way
    together. The origin is looked up once for all of them.
    """
    days = list(days)
    if window.clamp and window.origin is None:
        window = replace(window, origin=snapshot_origin(spark, rule, paths, families) or 0)

    def report_day(day: date) -> dict[str, int]:
        alone = Days.of([day])
        result = report_of_days(spark, rule, paths, families, alone, window, thresholds, **settings)
        return write_report_by_date(result, out, days=alone)

    with ThreadPoolExecutor(at_once) as pool:
        # each day in a copy of the session's local properties, which its jobs write to
        running = {day: pool.submit(inheritable_thread_target(spark)(report_day), day) for day in days}
        return {day: counts.result() for day, counts in running.items()}


def touched_days(changed: Iterable[date], window: SlidingWindow) -> Days:
    """Days of a report that samples of the changed days can be part of."""
    return Days.of(changed).reach(before=days_to_reach(window.size - 1))


def refresh_report(
    spark: SparkSession,
    rule: AlertRule,
    paths: tuple[str, str],
    families: tuple[str, str],
    out: str,
    changed: Iterable[date],
    window: SlidingWindow = SlidingWindow(),
    thresholds: Thresholds = fixed.THRESHOLDS,
    **settings,
) -> dict[str, int]:
    """Bring a report written by date up to date after some days of its snapshots have changed.

    Days whose windows the changed samples reach are reported anew and their
    folders replaced; files of other days stay. If the first sample has moved,
    the days between the old and the new bound of the clamp are among them. The
    first sample is kept with the report; a report that lacks it is made whole.
    Returns the counts of the days written.
    """
    changed = [d for d in changed if d is not None]
    days = touched_days(changed, window)
    known: list[int | None] = []
    if window.clamp and window.origin is None:
        if exists(spark, f"{out}/{_ORIGIN}"):
            known = [spark.read.schema("origin long").parquet(f"{out}/{_ORIGIN}").first()[0]]
        window = replace(window, origin=snapshot_origin(spark, rule, paths, families))
        if not known:
            days = Days.between(None, None)
        elif known[0] != window.origin:
            bounds = [_utc(first_start_of(o, window)) for o in (*known, window.origin) if o is not None]
            days = Days(days.ranges + ((min(bounds), max(bounds)),)) if bounds else Days.between(None, None)
    result = report_of_days(spark, rule, paths, families, days, window, thresholds, **settings)
    counts = write_report_by_date(result, out, days=days)
    if window.clamp:
        origin = spark.createDataFrame([(window.origin,)], "origin long")
        origin.coalesce(1).write.mode("overwrite").parquet(f"{out}/{_ORIGIN}")
    return counts


def _utc(second: int) -> date:
    return date.fromordinal(date(1970, 1, 1).toordinal() + second // 86400)
