"""The jobs from the command line.

    python -m vigil fan-out  --dataset wide.csv --out topics
    python -m vigil snapshot cpu --records topics --out cpu --bad cpu_bad
    python -m vigil snapshot cpu --records topics --out cpu --incremental
    python -m vigil report   cpu_mem --left cpu --right mem --thresholds limits.txt --out report
    python -m vigil report   cpu_mem --left cpu --right mem --out report --changed 2024-01-02
    python -m vigil stream   cpu_mem --records topics --out report --checkpoint state

``--servers host:port`` in place of ``--records`` or ``fan-out --out`` uses
Kafka topics. Under spark-submit, pass ``vigil/__main__.py`` and the package
with ``--py-files``.
"""

from __future__ import annotations

import argparse
import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from vigil import fixed_values as fixed
from vigil.config import CPU_MEM, NET_DISK, SlidingWindow
from vigil.operators.decode import flag_problems, with_second
from vigil.operators.fanout import fan_out
from vigil.operators.report import sort_report, summary_counts, with_alert
from vigil.plans.days import refresh_report, report_of_days
from vigil.plans.incremental import refresh_snapshot
from vigil.plans.reports import cpu_mem_report, net_disk_report
from vigil.plans.snapshots import decode_family, raw_snapshot
from vigil.sources import records, sinks, tables
from vigil.sources.days import Days
from vigil.sources.thresholds import read_threshold_versions, read_thresholds
from vigil.streaming.clamp import write_clamped
from vigil.streaming.late import correct_late
from vigil.streaming.records import problem_counts, stream_dataset_csv, write_split_stream, write_topic_stream
from vigil.streaming.reports import late_rows, stream_report, stream_samples, write_available

REPORTS = {"cpu_mem": (CPU_MEM, "cpu", "mem"), "net_disk": (NET_DISK, "net", "disk")}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="vigil", description="Server telemetry reports")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("fan-out", help="wide CSV to one JSON record per metric family")
    job.add_argument("--dataset", required=True)
    job.add_argument("--default-date", default=fixed.DEFAULT_DATE)
    job.add_argument("--checkpoint", help="read a folder of files as a stream, going on after the last run's; needs --out")
    place = job.add_mutually_exclusive_group(required=True)
    place.add_argument("--out")
    place.add_argument("--servers")

    job = jobs.add_parser("snapshot", help="records of a family to a table without repeats")
    job.add_argument("family", choices=fixed.FAMILY_METRICS)
    _record_source(job)
    job.add_argument("--min-partitions", type=int, help="least number of read tasks per topic")
    job.add_argument("--out", required=True)
    job.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    job.add_argument("--keep-undecodable", action="store_true")
    job.add_argument("--bad", help="where to put all rows by problem: none, or why they can not reach a report")
    _set_aside(job)
    job.add_argument("--incremental", action="store_true", help="read files of --records no earlier run has read, into Parquet")

    job = jobs.add_parser("quarantine", help="records of a family as a stream, stored by problem")
    job.add_argument("family", choices=fixed.FAMILY_METRICS)
    _record_source(job)
    job.add_argument("--per-batch", type=int, help="most records (topics) or files read per batch")
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)

    job = jobs.add_parser("report", help="two snapshots to a window report with alerts")
    job.add_argument("report", choices=REPORTS)
    job.add_argument("--left", required=True)
    job.add_argument("--right", required=True)
    job.add_argument("--format", choices=["csv", "parquet"], default="parquet")
    _thresholds(job)
    job.add_argument("--time-of-day", action="store_true", help="HH:mm:ss labels; days collapse")
    _window(job)
    job.add_argument("--from-date", help="first day of windows to report, from Parquet snapshots")
    job.add_argument("--to-date", help="last day of windows to report, from Parquet snapshots")
    job.add_argument("--changed", nargs="+", help="days of the snapshots that have changed: bring --out up to date")
    job.add_argument("--zone", help="time zone of HH:mm:ss labels")
    job.add_argument("--no-clamp", dest="clamp", action="store_false")
    job.add_argument("--out", required=True)
    job.add_argument("--out-format", choices=["csv", "parquet"], default="parquet")
    job.add_argument("--ranges", type=int, help="write a sorted CSV report in so many ranges, counted while it is made")
    _set_aside(job)

    job = jobs.add_parser("stream", help="records to a report, continuing from the last run")
    job.add_argument("report", choices=REPORTS)
    _record_source(job)
    _thresholds(job)
    _window(job)
    job.add_argument("--delay", type=_delay, default="1 minute", help="how late samples may be")
    job.add_argument("--corrections", help="where to keep samples and correct windows of later ones; needs --origin")
    job.add_argument("--per-batch", type=int, help="most records (topics) or files read per batch")
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--state-partitions", type=int, help="fixed by the first run")

    args = parser.parse_args(argv)
    _check(parser, args)
    return args


def _check(parser: argparse.ArgumentParser, args: argparse.Namespace) -> None:
    if args.job == "fan-out" and args.checkpoint and not args.out:
        parser.error("--checkpoint needs --out")
    if args.job == "snapshot" and args.incremental and (args.servers or args.format != "parquet" or args.bad or args.keep_undecodable):
        parser.error("--incremental reads --records into Parquet, without --bad or --keep-undecodable")
    if args.job == "report":
        by_day = args.from_date or args.to_date or args.changed
        if by_day and args.format != "parquet":
            parser.error("days can be told apart in Parquet snapshots only")
        if args.ranges and (args.out_format != "csv" or args.time_of_day):
            parser.error("--ranges is for reports in CSV with whole timestamps")
        if args.changed and (args.out_format != "parquet" or args.time_of_day or args.from_date or args.to_date):
            parser.error("--changed brings a whole report in Parquet up to date")
    if args.job == "stream" and args.corrections and args.origin is None:
        parser.error("--corrections needs --origin")


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _seconds(delay: str) -> int:
    number, unit = delay.split()
    return int(number) * _UNITS[unit.removesuffix("s")]


def _delay(text: str) -> str:
    """A number of seconds, minutes, hours or days."""
    try:
        _seconds(text)
    except (ValueError, KeyError):
        raise argparse.ArgumentTypeError(f"not a delay such as '1 minute': {text}") from None
    return text


def _record_source(job: argparse.ArgumentParser) -> None:
    place = job.add_mutually_exclusive_group(required=True)
    place.add_argument("--records", help="folder written by fan-out")
    place.add_argument("--servers")


def _set_aside(job: argparse.ArgumentParser) -> None:
    job.add_argument("--set-aside", help="where rows go that CSV can not hold; without it they fail the job")


def _thresholds(job: argparse.ArgumentParser) -> None:
    place = job.add_mutually_exclusive_group()
    place.add_argument("--thresholds", help="file of name: number lines")
    place.add_argument("--threshold-versions", help="folder of valid_from=<epoch second> folders with such a file each")


def _window(job: argparse.ArgumentParser) -> None:
    job.add_argument("--window", type=int, default=fixed.WINDOW_SECONDS)
    job.add_argument("--slide", type=int, default=fixed.SLIDE_SECONDS)
    job.add_argument("--offset", type=int, default=fixed.OFFSET_SECONDS)
    job.add_argument("--origin", type=int, help="epoch second of the first sample, if known")


def _limits(spark: SparkSession, args: argparse.Namespace):
    """The thresholds as they are now."""
    if args.threshold_versions:
        return read_threshold_versions(spark, args.threshold_versions)
    return read_thresholds(spark, args.thresholds) if args.thresholds else fixed.THRESHOLDS


def run_fan_out(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.checkpoint:
        rows = fan_out(stream_dataset_csv(spark, args.dataset), args.default_date)
        return write_topic_stream(rows, args.out, args.checkpoint).awaitTermination()
    rows = fan_out(tables.read_dataset_csv(spark, args.dataset), args.default_date)
    if args.servers:
        sinks.write_topics(rows, args.servers)
    else:
        sinks.write_topic_files(rows, args.out)


def _timestamps(family: str) -> str:
    return next(rule for rule, *families in REPORTS.values() if family in families).timestamps


def run_snapshot(spark: SparkSession, args: argparse.Namespace) -> dict[str, object] | None:
    topic = fixed.TOPICS[args.family]
    timestamps = _timestamps(args.family)
    if args.incremental:
        folder = records.topic_directory(args.records, topic)
        return refresh_snapshot(spark, folder, args.out, args.family, timestamps)
    order = records.TOPIC_ORDER if args.servers else None
    if args.servers:
        source = records.read_topic(spark, args.servers, topic, args.min_partitions)
    else:
        source = records.read_record_files(spark, records.topic_directory(args.records, topic))
    rows = decode_family(source, args.family, order)
    if args.bad:
        # one read: the rows are stored good and bad, and the snapshot is made from those
        sinks.write_split(flag_problems(with_second(rows, timestamps)), args.bad)
        rows = spark.read.parquet(args.bad).drop("problem", "ts_sec")
    snapshot = raw_snapshot(rows, args.family, order, args.keep_undecodable, ordered=args.format == "csv")
    if args.format == "csv":
        return {"set_aside": sinks.write_csv(snapshot, args.out, args.set_aside)}
    sinks.write_snapshot_by_date(with_second(snapshot, timestamps), args.out)
    return None


def run_quarantine(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    rows = decode_family(_record_stream(spark, args, args.family), args.family)
    return problem_counts(write_split_stream(rows, _timestamps(args.family), args.out, args.checkpoint))


def run_report(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    rule, *families = REPORTS[args.report]
    window = SlidingWindow(args.window, args.slide, args.offset, args.clamp, args.origin)
    paths = (args.left, args.right)
    limits = _limits(spark, args)
    if args.changed:
        changed = [date.fromisoformat(d) for d in args.changed]
        return refresh_report(spark, rule, paths, tuple(families), args.out, changed, window, limits)
    settings = {"labels": "time_of_day" if args.time_of_day else "timestamp", "zone": args.zone, "ranges": args.ranges}
    days = Days.between(args.from_date, args.to_date) if args.from_date or args.to_date else None
    if days is not None:
        result = report_of_days(spark, rule, paths, tuple(families), days, window, limits, **settings)
    else:
        read = tables.read_snapshot_csv if args.format == "csv" else tables.read_snapshot_parquet
        left, right = (read(spark, p, f) for p, f in zip(paths, families))
        make = cpu_mem_report if args.report == "cpu_mem" else net_disk_report
        result = make(left, right, window=window, thresholds=limits, **settings)
    if args.out_format == "parquet" and not args.time_of_day:
        return sinks.write_report_by_date(result, args.out, days)
    in_order = result if args.ranges else sort_report(result)
    if args.out_format == "parquet":
        return sinks.counted(in_order, summary_counts(), lambda rows: sinks.write_parquet(rows, args.out))
    aside: list[int] = []
    counts = sinks.counted(
        in_order, summary_counts(), lambda rows: aside.append(sinks.write_csv(rows, args.out, args.set_aside))
    )
    return counts | ({"set_aside": aside[0]} if args.set_aside else {})


def _record_stream(spark: SparkSession, args: argparse.Namespace, family: str) -> DataFrame:
    topic = fixed.TOPICS[family]
    if args.servers:
        return records.stream_topic(spark, args.servers, topic, args.per_batch)
    return records.stream_record_files(spark, records.topic_directory(args.records, topic), args.per_batch)


def run_stream(spark: SparkSession, args: argparse.Namespace) -> dict[str, int]:
    rule, *families = REPORTS[args.report]
    order = records.TOPIC_ORDER if args.servers else None
    window = SlidingWindow(args.window, args.slide, args.offset, origin=args.origin)

    def sides() -> list[DataFrame]:
        return [
            stream_samples(
                decode_family(_record_stream(spark, args, family), family, order),
                metric,
                rule.timestamps,
                order[0] if order else None,
            )
            for family, metric in zip(families, (rule.left, rule.right))
        ]

    if args.origin is not None and not args.threshold_versions:
        limits = read_thresholds(spark, args.thresholds).first().asDict() if args.thresholds else fixed.THRESHOLDS
        result = stream_report(*sides(), rule, window, limits, args.delay)
        query = write_available(result, args.out, args.checkpoint, args.state_partitions)
    else:
        # what is not known when the query starts is found, or read anew, in each batch
        windows = stream_report(*sides(), rule, window, None, args.delay, first_second=True)
        judge = lambda rows: with_alert(rows, rule, _limits(spark, args))
        query = write_clamped(windows, args.out, args.checkpoint, window, args.state_partitions, judge)
    counts = {"late_rows": late_rows(query)}
    if args.corrections:
        folder, seconds = f"{args.checkpoint.rstrip('/')}-late", _seconds(args.delay)
        correct_late(*sides(), rule, window, args.corrections, folder, seconds, _limits(spark, args)).awaitTermination()
    return counts


RUN = {
    "fan-out": run_fan_out,
    "snapshot": run_snapshot,
    "quarantine": run_quarantine,
    "report": run_report,
    "stream": run_stream,
}


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = (
        SparkSession.builder.appName(f"vigil {args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    print(json.dumps({"job": args.job, **(RUN[args.job](spark, args) or {})}))


if __name__ == "__main__":
    main()
