"""From window statistics to a finished report."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from vigil import fixed_values as fixed
from vigil.config import AlertRule
from vigil.functions.alerts import alert_text
from vigil.functions.timestamps import second_of_day, time_of_day
from vigil.operators.windows import mean_and_max
from vigil.sources.thresholds import VALID_FROM


def versioned(thresholds: Mapping[str, float] | DataFrame) -> bool:
    """Whether thresholds are a table of versions (``sources.thresholds.read_threshold_versions``)."""
    return isinstance(thresholds, DataFrame) and VALID_FROM in thresholds.columns


def threshold(thresholds: Mapping[str, float] | DataFrame, name: str) -> Column:
    """A threshold as a literal, or as a scalar subquery on a one-row table."""
    if isinstance(thresholds, DataFrame):
        if name not in thresholds.columns:
            return F.lit(fixed.MISSING_THRESHOLD)
        return thresholds.select(name).scalar()
    return F.lit(float(thresholds.get(name, fixed.MISSING_THRESHOLD)))


def with_valid_thresholds(windows: DataFrame, versions: DataFrame, names: list[str]) -> DataFrame:
    """Add ``valid``, the thresholds of the last version from which on windows ending at ``window_end`` are judged.

    Null before the first version. The versions are one value, a sorted array,
    so that windows are not joined with them. window_end is a timestamp or an
    epoch second.
    """
    window_end = F.col("window_end")
    if dict(windows.dtypes)["window_end"] == "timestamp":
        window_end = F.unix_seconds(window_end)
    row = F.struct(F.col(VALID_FROM), *(n for n in names if n in versions.columns))
    sorted_versions = versions.agg(F.array_sort(F.collect_list(row)).alias("versions")).scalar()
    known = windows.withColumn("versions", sorted_versions)
    known = known.withColumn("versions", F.filter("versions", lambda v: v[VALID_FROM] <= window_end))
    return known.withColumn("valid", F.get("versions", F.size("versions") - 1)).drop("versions")


def with_alert(windows: DataFrame, rule: AlertRule, thresholds: Mapping[str, float] | DataFrame) -> DataFrame:
    """Add ``alert``; versions of thresholds are those valid at the end of each window."""
    names = [rule.left_threshold, rule.right_threshold]
    if versioned(thresholds):
        windows = with_valid_thresholds(windows, thresholds, names)
        missing = F.lit(fixed.MISSING_THRESHOLD)
        limits = [F.coalesce(F.col(f"valid.{n}"), missing) if n in thresholds.columns else missing for n in names]
    else:
        limits = [threshold(thresholds, n) for n in names]
    judged = windows.withColumn(
        "alert",
        alert_text(
            F.col(f"{rule.compares}_{rule.left_name}"),
            F.col(f"{rule.compares}_{rule.right_name}"),
            *limits,
            rule.texts,
            rule.needs_both,
        ),
    )
    return judged.drop("valid") if versioned(thresholds) else judged


def finish_statistics(windows: DataFrame, rule: AlertRule, carry: list[str] | None = None) -> DataFrame:
    """Averages and maxima in report order, from the sums of ``aggregate_windows``; ``carry`` keeps further columns."""
    exact = f"{rule.left}_rest" in windows.columns
    left, left_max = mean_and_max(rule.left, rule.left_name, exact)
    right, right_max = mean_and_max(rule.right, rule.right_name, exact)
    return windows.select("server_id", "window_start", "window_end", left, right, left_max, right_max, *(carry or []))


def collapse_time_of_day(windows: DataFrame, size: int, zone: str | None = None) -> DataFrame:
    """HH:mm:ss labels, and one row per server and label: the earliest window's.

    Windows of different days share a label, so a report over several days
    loses windows this way; it exists for reports that carry no date. Rows are
    grouped by the number behind the label, which is made for kept rows only.
    """
    names = [c for c in windows.columns if c not in ("server_id", "window_start", "window_end")]
    kept = [F.min_by(n, "window_start").alias(n) for n in names]
    return (
        windows.groupBy("server_id", second_of_day(F.col("window_start"), zone).alias("second_of_day"))
        .agg(F.min("window_start").alias("first_start"), *kept)
        .select(
            "server_id",
            time_of_day(F.col("first_start"), zone).alias("window_start"),
            time_of_day(F.col("first_start") + F.lit(size), zone).alias("window_end"),
            *names,
        )
    )


def label_timestamps(windows: DataFrame) -> DataFrame:
    """Window bounds as timestamps instead of epoch seconds."""
    return windows.withColumns(
        {c: F.timestamp_seconds(c) for c in ("window_start", "window_end")}
    )


def sort_report(report: DataFrame) -> DataFrame:
    """Total order by server and window start. The range shuffle splits a busy server.

    Finding the ranges runs the stage below once more; ``plans.reports.report``
    with ``ranges`` counts them in the plan, and writing by date needs none.
    """
    return report.orderBy("server_id", "window_start")


def alert_rows(report: DataFrame) -> DataFrame:
    return report.where(F.col("alert") != fixed.NO_ALERT)


def summary_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("alert") != fixed.NO_ALERT).alias("alert_rows"),
    ]


def alert_summary(report: DataFrame) -> DataFrame:
    """One row: all windows, and those with an alert, counted in one pass.

    Sinks count while they write; this is for a report that is not written.
    """
    return report.agg(*summary_counts())
