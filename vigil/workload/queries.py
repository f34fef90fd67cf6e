"""One query per operator, each over the whole telemetry."""

from __future__ import annotations

import datetime
import tempfile
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vigil.config import CPU_MEM, NET_DISK, SlidingWindow
from vigil.fixed_values import FAMILY_METRICS, THRESHOLDS, TOPICS
from vigil.functions.alerts import alert_text
from vigil.functions.numbers import parse_number
from vigil.functions.timestamps import epoch_second, with_default_date
from vigil.operators import windows as W
from vigil.operators.decode import decode_records, flag_problems, round_metrics, with_second
from vigil.operators.dedupe import first_per_key
from vigil.operators.fanout import fan_out
from vigil.operators.join import KEYS, join_families, merge_copies, merge_first
from vigil.operators.report import alert_rows, alert_summary, sort_report, with_alert
from vigil.plans.days import refresh_report, report_each_day, report_of_days
from vigil.plans.incremental import refresh_snapshot
from vigil.plans.reports import POSITION, cpu_mem_report, net_disk_report, report, samples, window_statistics
from vigil.plans.snapshots import decode_family, raw_snapshot
from vigil.schemas import family_schema
from vigil.sources.days import Days, day_of, stored_days
from vigil.sources.records import read_record_files, stream_record_files, topic_directory
from vigil.sources.sinks import CSV_TEXT, write_csv, write_parquet, write_report_by_date, write_snapshot_by_date, write_topic_files
from vigil.sources.storage import SETTING, exists, is_folder, job_folder
from vigil.sources.tables import read_csv, read_dataset_csv, read_snapshot_csv, read_snapshot_parquet
from vigil.sources.thresholds import read_threshold_versions, read_thresholds, threshold_table as thresholds_from_lines
from vigil.streaming.clamp import FIRST_SECOND, write_clamped
from vigil.streaming.late import correct_late, corrected, read_corrections
from vigil.streaming.records import (
    problem_counts,
    read_split,
    read_topic_stream,
    stream_dataset_csv,
    write_split_stream,
    write_topic_stream,
)
from vigil.streaming.reports import late_rows, stream_report, stream_samples, unique_samples, with_tail, write_available
from vigil.workload import telemetry as tel

ORDER = ["event_id"]


def _run_folder(spark: SparkSession, name: str) -> str:
    """A run's folder. These queries are their own caller, so they name one in a local session that has none."""
    master = spark.conf.get("spark.master", "")
    if not spark.conf.get(SETTING, None) and (master == "local" or master.startswith("local[")):
        spark.conf.set(SETTING, tempfile.mkdtemp(prefix="vigil-"))
    return job_folder(spark, name)


def _samples(spark, sf_dir, *families, days=1):
    return [tel.family_samples(spark, sf_dir, f, days) for f in families]


def _unique(spark, sf_dir, family, *metrics):
    rows = tel.family_samples(spark, sf_dir, family)
    return first_per_key(rows.select(*KEYS, *(metrics or FAMILY_METRICS[family]), *ORDER), KEYS, ORDER)


def _joined(spark, sf_dir):
    cpu, mem = _samples(spark, sf_dir, "cpu", "mem")
    return merge_first(cpu, mem, ORDER)


def _cpu_mem(spark, sf_dir, **settings):
    cpu, mem = _samples(spark, sf_dir, "cpu", "mem")
    return report(cpu, mem, CPU_MEM, order=ORDER, labels="epoch", **settings)


def _net_disk(spark, sf_dir, **settings):
    net, disk = _samples(spark, sf_dir, "net", "disk")
    return report(net, disk, NET_DISK, order=ORDER, labels="epoch", duplicates="first", **settings)


# Sources, decoding, fan-out


def _decoded_topics(records: DataFrame) -> DataFrame:
    """Records of all topics in one frame, absent metrics null."""
    schema = family_schema("cpu")
    for family in ("mem", "net", "disk"):
        for metric in FAMILY_METRICS[family]:
            schema = schema.add(metric, "float")
    return decode_records(records, schema, carry=["topic"])


def fanout_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decoded_topics(fan_out(tel.dataset(spark, sf_dir)))


def fanout_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    broken = tel.dataset(spark, sf_dir).withColumns(
        {
            "ts": F.when(i % 31 != 0, F.col("ts")),
            "cpu_pct": F.when(i % 13 == 0, "").when(i % 23 == 0, " 5 ").otherwise(F.col("cpu_pct")),
            "mem_pct": F.when(i % 17 != 0, F.col("mem_pct")),
            "net_in": F.when(i % 11 == 0, "oops").when(i % 19 == 0, "1e3").otherwise(F.col("net_in")),
            "net_out": F.when(i % 37 == 0, "1.5f").otherwise(F.col("net_out")),
            "disk_io": F.when(i % 29 == 0, "x").when(i % 7 == 0, "1_0").otherwise(F.col("disk_io")),
        }
    )
    return _decoded_topics(fan_out(broken))


def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    text = (
        F.when(i % 6 == 0, F.concat(F.lit(" "), cents, F.lit(" ")))
        .when(i % 6 == 1, F.concat(F.lit("-"), cents, F.lit("e1")))
        .when(i % 6 == 2, F.concat(cents, F.lit("_0")))
        .when(i % 6 == 3, F.concat(cents, F.lit("d")))
        .when(i % 6 == 4, F.concat(F.lit("0x"), cents))
        .otherwise(F.concat(F.lit("."), cents))
    )
    return tel.events(spark, sf_dir).select("event_id", parse_number(text).alias("number"))


def ts_default_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tel.dataset(spark, sf_dir)
    return rows.select("event_id", with_default_date(F.col("ts")).alias("ts"))


def decode_topic_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = tel.family_records(spark, sf_dir, "cpu", carry=["props"])
    cpu = decode_family(records, "cpu", ["props", *ORDER])
    keys = cpu.select("*", F.col("props").cast("binary").alias("value"))
    return decode_records(keys, T.StructType().add("k", T.LongType()), ["ts", "server_id", "cpu_pct", *ORDER])


def _malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    text = F.col("value")
    return tel.family_records(spark, sf_dir, "cpu").withColumn(
        "value",
        F.when(i % 17 == 0, F.left(text, F.lit(10)))
        .when(i % 17 == 1, F.concat(F.lit("["), text, F.lit("]")))
        .when(i % 17 == 2, F.lit(None))
        .when(i % 17 == 3, F.replace(text, F.lit('"server_id"'), F.lit('"host"')))
        .when(i % 17 == 4, F.replace(text, F.lit('"ts":"'), F.lit('"ts":"at ')))
        .when(i % 17 == 5, F.replace(text, F.lit('"cpu_pct":'), F.lit('"cpu_pct":"high","was":')))
        .otherwise(text),
    )


def decode_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode_family(_malformed(spark, sf_dir), "cpu", ORDER)
    flagged = flag_problems(with_second(rows, "lenient"))
    return flagged.select("event_id", "server_id", "ts_sec", "cpu_pct", "problem")


def round_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tel.events(spark, sf_dir).select("event_id", (F.col("value") / 7).cast("float").alias("metric"))
    return round_metrics(rows, ["metric"])


def threshold_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    cents = F.round(F.col("value") * 100).cast("bigint").cast("string")
    lines = tel.events(spark, sf_dir).select(
        i.alias("position"),
        F.when(i % 10 == 0, F.concat(F.lit("# "), cents))
        .otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit("_threshold : "), cents, F.lit(" ")))
        .alias("line"),
    )
    names = [f"{e}_threshold" for e in ("click", "error", "purchase", "signup", "view", "absent")]
    return thresholds_from_lines(lines, names)


# Cleaning


def raw_snapshot_cpu(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshot(tel.family_rows(spark, sf_dir, "cpu"), "cpu", ORDER)


def raw_snapshot_mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshot(tel.family_rows(spark, sf_dir, "mem", whole=True), "mem", ORDER)


def raw_snapshot_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshot(tel.family_rows(spark, sf_dir, "net"), "net", ORDER)


def raw_snapshot_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_snapshot(tel.family_rows(spark, sf_dir, "disk", whole=True), "disk", ORDER)


def truncate_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = tel.events(spark, sf_dir).select("event_id", F.col("ts").cast("string").alias("ts"))
    return with_second(rows, "lenient").select("event_id", "ts_sec")


def parse_strict_vs_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    at = tel.event_second()
    plain = tel.second_text(at)
    text = (
        F.when(i % 7 == 0, plain)
        .when(i % 7 == 1, F.concat(plain, F.lit(".7")))
        .when(i % 7 == 2, F.replace(plain, F.lit(" "), F.lit("T")))
        .when(i % 7 == 3, F.concat(plain, F.lit("Z")))
        .when(i % 7 == 4, F.left(plain, F.lit(10)))
        .when(i % 7 == 5, F.right(plain, F.lit(8)))
        .otherwise(F.concat(F.lit("at "), plain))
    )
    return tel.events(spark, sf_dir).select(
        "event_id", epoch_second(text, "strict").alias("strict"), epoch_second(text, "lenient").alias("lenient")
    )


def dedupe_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unique(spark, sf_dir, "cpu")


def dedupe_without_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_per_key(tel.family_samples(spark, sf_dir, "net").drop("event_id"), KEYS)


# Joins


def join_cpu_mem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined(spark, sf_dir)


def join_net_disk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_families(_unique(spark, sf_dir, "net"), _unique(spark, sf_dir, "disk"))


def join_dup_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    net, disk = _samples(spark, sf_dir, "net", "disk")
    return merge_copies(net.drop("event_id"), disk.drop("event_id"))


# Windows


def window_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = W.origin(_joined(spark, sf_dir))
    return first.select("ts_sec", W.first_start(F.col("ts_sec"), SlidingWindow()).alias("first_start"))


def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.assign_windows(_joined(spark, sf_dir), SlidingWindow())


def _window_counts(spark, sf_dir, window):
    windows = W.aggregate_windows(_joined(spark, sf_dir), window, ["cpu_pct"])
    return windows.select("server_id", "window_start", "window_end", F.col("cpu_pct_count").alias("samples"))


def window_unclamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, SlidingWindow(clamp=False))


def window_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, SlidingWindow())


def window_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, SlidingWindow(offset=3))


def window_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, SlidingWindow(size=25, slide=10, offset=4))


def window_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _window_counts(spark, sf_dir, SlidingWindow(size=10, slide=30))


def cpu_mem_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cpu, mem = _samples(spark, sf_dir, "cpu", "mem")
    return window_statistics(cpu, mem, CPU_MEM, order=ORDER)


def net_disk_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    net, disk = _samples(spark, sf_dir, "net", "disk")
    return window_statistics(net, disk, replace(NET_DISK, duplicates="first"), order=ORDER)


# Alerts and reports


def cpu_mem_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cpu_mem(spark, sf_dir)


def net_disk_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _net_disk(spark, sf_dir)


def net_disk_alerts_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    net, disk = _samples(spark, sf_dir, "net", "disk")
    return report(net, disk, NET_DISK, labels="epoch")


def _epoch(frame: DataFrame) -> DataFrame:
    return frame.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")})


def cpu_mem_from_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records to alerts in one plan."""
    cpu, mem = (
        decode_family(tel.family_records(spark, sf_dir, f), f, ORDER) for f in ("cpu", "mem")
    )
    return _epoch(cpu_mem_report(cpu, mem, ORDER))


def net_disk_from_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for network and disk, repeats dropped in the join."""
    net, disk = (
        decode_family(tel.family_records(spark, sf_dir, f), f, ORDER) for f in ("net", "disk")
    )
    return _epoch(net_disk_report(net, disk, ORDER, duplicates="first"))


def net_disk_from_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written and read back, then reported on as they are."""
    folder = _run_folder(spark, "net-disk-snapshots")
    for family in ("net", "disk"):
        write_parquet(raw_snapshot(tel.family_rows(spark, sf_dir, family), family, ORDER), f"{folder}/{family}")
    net, disk = (read_snapshot_parquet(spark, f"{folder}/{f}", f) for f in ("net", "disk"))
    return _epoch(net_disk_report(net, disk))


def _metric_pair(spark, sf_dir):
    """Values around thresholds 87.97 and 83.18 with nulls mixed in."""
    i = F.col("event_id")
    cpu = tel.family_samples(spark, sf_dir, "cpu")
    return cpu.select(
        "event_id",
        F.when(i % 3 != 0, F.col("cpu_pct").cast("double")).alias("left_value"),
        F.when(i % 5 != 0, (F.col("cpu_pct") / 2 + 45).cast("double")).alias("right_value"),
    )


def _both_rules(pairs, left_name, right_name):
    limits = F.lit(THRESHOLDS[left_name]), F.lit(THRESHOLDS[right_name])
    left, right = F.col("left_value"), F.col("right_value")
    return pairs.select(
        "event_id",
        "left_value",
        "right_value",
        alert_text(left, right, *limits, CPU_MEM.texts, needs_both=True).alias("needs_both"),
        alert_text(left, right, *limits, NET_DISK.texts, needs_both=False).alias("either"),
    )


def alert_null_semantics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both_rules(_metric_pair(spark, sf_dir), "cpu_threshold", "mem_threshold")


def alert_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    net = tel.family_samples(spark, sf_dir, "net")
    near = [F.lit(THRESHOLDS[n]) for n in ("net_in_threshold", "disk_io_threshold")]
    pairs = net.select(
        "event_id",
        F.when(i % 4 == 0, near[0]).otherwise(F.col("net_in")).cast("float").alias("left_value"),
        F.when(i % 3 == 0, near[1]).otherwise(F.col("net_out")).cast("float").alias("right_value"),
    )
    return _both_rules(pairs, "net_in_threshold", "disk_io_threshold")


def alert_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alert_rows(_cpu_mem(spark, sf_dir))


def alert_summary_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cpu_mem = alert_summary(_cpu_mem(spark, sf_dir)).withColumn("report", F.lit("cpu_mem"))
    net_disk = alert_summary(_net_disk(spark, sf_dir)).withColumn("report", F.lit("net_disk"))
    return cpu_mem.unionByName(net_disk)


def alerts_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds from lines, one per event; memory has none and gets the default."""
    i = F.col("event_id")
    lines = tel.events(spark, sf_dir).select(
        i.alias("position"),
        F.concat(F.lit("cpu_threshold: "), (70 + i % 20).cast("string")).alias("line"),
    )
    cpu, mem = _samples(spark, sf_dir, "cpu", "mem")
    return report(cpu, mem, CPU_MEM, thresholds=thresholds_from_lines(lines), order=ORDER, labels="epoch")


def report_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sort_report(_net_disk(spark, sf_dir))


def report_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of three days in total order, by ranges from counts in the plan."""
    return report(*_three_days(spark, sf_dir), CPU_MEM, order=ORDER, labels="epoch", ranges=4)


def _three_days(spark, sf_dir):
    return _samples(spark, sf_dir, "cpu", "mem", days=3)


def multi_day_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_three_days(spark, sf_dir), CPU_MEM, order=ORDER, labels="epoch")


def tod_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(*_three_days(spark, sf_dir), CPU_MEM, order=ORDER, labels="time_of_day")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _run_folder(spark, "csv-round-trip")
    result = sort_report(_cpu_mem(spark, sf_dir))
    write_csv(result, folder)
    return read_csv(spark, folder, result.schema)


# Streaming


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as a stream, be it a folder of files or a file, which a stream reads by its folder and name."""
    path = f"{sf_dir}/events.parquet"
    if is_folder(spark, path):
        return spark.readStream.schema(tel.EVENTS).parquet(path)
    return spark.readStream.schema(tel.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def _streamed(spark: SparkSession, sides: list[DataFrame], batch: DataFrame, name: str) -> DataFrame:
    """The CPU and memory report of two streams, with the windows still open at the end from the batch plan."""
    folder = _run_folder(spark, name)
    alerts = stream_report(
        *sides, CPU_MEM, SlidingWindow(origin=tel.FIRST_SECOND), delay=f"{tel.STREAM_DELAY_SECONDS} seconds"
    )
    cores = spark.sparkContext.defaultParallelism
    late_rows(write_available(alerts, f"{folder}/report", f"{folder}/checkpoint", cores))
    closed = spark.read.schema(alerts.schema).parquet(f"{folder}/report").select(*alerts.columns)
    return with_tail(_epoch(closed), batch)


def stream_cpu_mem_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = [
        stream_samples(tel.rows_of(_event_stream(spark, sf_dir), f), FAMILY_METRICS[f][0], "lenient", "event_id")
        for f in ("cpu", "mem")
    ]
    return _streamed(spark, sides, _cpu_mem(spark, sf_dir), "stream-cpu-mem")


def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeats without an ingest position, stream and batch by the same rule."""
    families = ("cpu", "mem")
    sides = [
        stream_samples(tel.subsecond_rows(_event_stream(spark, sf_dir), f), FAMILY_METRICS[f][0], "lenient")
        for f in families
    ]
    rows = [tel.subsecond_rows(tel.events(spark, sf_dir), f) for f in families]
    return _streamed(spark, sides, _epoch(cpu_mem_report(*rows)), "stream-repeats")


# Repeats, odd keys and files


def dedupe_subsecond(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a second's samples the earliest, of equal ones the largest."""
    rows = samples(tel.subsecond_rows(tel.events(spark, sf_dir), "cpu"), "cpu_pct", "lenient")
    return first_per_key(rows, KEYS, [POSITION])


def join_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows over samples some of which have no server or no second."""
    i = F.col("event_id")
    broken = {
        "server_id": F.when(i % 7 != 0, F.col("server_id")),
        "ts_sec": F.when(i % 11 != 0, F.col("ts_sec")),
    }
    cpu, mem = (s.withColumns(broken) for s in _samples(spark, sf_dir, "cpu", "mem"))
    return report(cpu, mem, CPU_MEM, order=ORDER, labels="epoch")


def csv_odd_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot by CSV whose servers have quotes, commas, backslashes and blanks."""
    folder = _run_folder(spark, "csv-odd-text")
    names = F.array(*[F.lit(n) for n in tel.ODD_SERVERS])
    rows = tel.family_rows(spark, sf_dir, "cpu").withColumn("server_id", F.get(names, F.col("event_id") % len(tel.ODD_SERVERS)))
    write_csv(raw_snapshot(rows, "cpu", ORDER), folder)
    return read_snapshot_csv(spark, folder, "cpu")


def tod_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels on the clock of another zone than the session's."""
    return report(*_three_days(spark, sf_dir), CPU_MEM, order=ORDER, labels="time_of_day", zone="Asia/Kolkata")


def pipeline_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide CSV, fan-out, topic files, snapshots, threshold file and report by date, each written and read."""
    folder = _run_folder(spark, "pipeline-files")
    wide = tel.dataset(spark, sf_dir).withColumn("ts", tel.second_text(tel.event_second())).drop("event_id")
    write_csv(wide, f"{folder}/wide")
    write_topic_files(fan_out(read_dataset_csv(spark, f"{folder}/wide")), f"{folder}/topics")
    limits = "\n".join(f"{name}: {value}" for name, value in THRESHOLDS.items())
    spark.range(1).select(F.lit(limits).alias("value")).coalesce(1).write.text(f"{folder}/limits")
    for family in ("cpu", "mem"):
        records = read_record_files(spark, topic_directory(f"{folder}/topics", TOPICS[family]))
        snapshot = raw_snapshot(decode_family(records, family), family, ordered=False)
        write_snapshot_by_date(with_second(snapshot, CPU_MEM.timestamps), f"{folder}/{family}")
    cpu, mem = (read_snapshot_parquet(spark, f"{folder}/{f}", f) for f in ("cpu", "mem"))
    result = cpu_mem_report(cpu, mem, thresholds=read_thresholds(spark, f"{folder}/limits"))
    write_report_by_date(result, f"{folder}/report")
    return _epoch(spark.read.schema(result.schema).parquet(f"{folder}/report").select(*result.columns))


def exact_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network and disk of two servers in few seconds, so that each window averages very many pairs."""
    few = {"server_id": F.concat(F.lit("srv-"), F.col("event_id") % 2), "ts_sec": tel.few_seconds()}
    net, disk = (s.withColumns(few).drop("event_id") for s in _samples(spark, sf_dir, "net", "disk"))
    return report(net, disk, NET_DISK, labels="epoch")


# Days, increments and long streams


def _three_day_rows(spark, sf_dir, family):
    """Decoded rows on three days, with event_id."""
    rows = tel.family_samples(spark, sf_dir, family, 3)
    return rows.select(tel.second_text(F.col("ts_sec")).alias("ts"), "server_id", *FAMILY_METRICS[family], *ORDER)


def _store_days(spark, sf_dir, folder, kept=None, days=None):
    """CPU and memory snapshots by date, of all rows or those a condition keeps, of all days or some."""
    families = ("cpu", "mem")
    for family in families:
        rows = _three_day_rows(spark, sf_dir, family)
        snapshot = with_second(raw_snapshot(rows if kept is None else rows.where(kept), family, ORDER, ordered=False), "lenient")
        if days is not None:
            snapshot = snapshot.where(days.holds(day_of(F.col("ts_sec"))))
        write_snapshot_by_date(snapshot, f"{folder}/{family}", days)
    return tuple(f"{folder}/{f}" for f in families), families


def _read_report(spark, path, like):
    return _epoch(spark.read.schema(like.schema).parquet(path).select(*like.columns))


def report_day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of three days' snapshots reported alone, into one folder."""
    folder = _run_folder(spark, "day-range")
    paths, families = _store_days(spark, sf_dir, folder)
    days = stored_days(spark, paths[0])
    report_each_day(spark, CPU_MEM, paths, families, f"{folder}/report", days)
    like = report_of_days(spark, CPU_MEM, paths, families, Days.of(days[:1]))
    return _closed(spark, f"{folder}/report", like)


def report_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report made before some rows of one day came, refreshed after."""
    folder = _run_folder(spark, "refresh")
    day = datetime.date(2024, 1, 3)
    late = (F.left("ts", F.lit(10)) == day.isoformat()) & (F.col("event_id") % 5 == 1)
    paths, families = _store_days(spark, sf_dir, folder, kept=~late)
    refresh_report(spark, CPU_MEM, paths, families, f"{folder}/report", [])
    _store_days(spark, sf_dir, folder, days=Days.of([day]))
    refresh_report(spark, CPU_MEM, paths, families, f"{folder}/report", [day])
    like = report_of_days(spark, CPU_MEM, paths, families, Days.of([day]))
    return _read_report(spark, f"{folder}/report", like)


def snapshot_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot from record files in two halves: the second run reads the second half only."""
    folder = _run_folder(spark, "incremental")
    records = tel.family_records(spark, sf_dir, "net")
    for half in range(2):
        records.where(F.col("event_id") % 2 == half).select("value").write.text(f"{folder}/records/half={half}")
        refresh_snapshot(spark, f"{folder}/records", f"{folder}/net", "net", NET_DISK.timestamps)
    return read_snapshot_parquet(spark, f"{folder}/net", "net")


def _large(rows: DataFrame) -> DataFrame:
    """CPU rows some of whose values are beyond all bounds."""
    i = F.col("event_id")
    value = (
        F.when(i % 97 == 0, float("nan"))
        .when(i % 89 == 0, float("inf"))
        .when(i % 83 == 0, float("-inf"))
        .when(i % 4 == 0, 2e10)
        .when(i % 4 == 1, 9e10)
        .when(i % 4 == 2, -3e38)
        .otherwise(F.col("cpu_pct"))
    )
    return rows.withColumn("cpu_pct", value.cast("float"))


def _kinds(unique: DataFrame) -> DataFrame:
    """Not-a-number and infinities by name, other values as numbers."""
    value = F.col("cpu_pct")
    odd = F.isnan(value) | (F.abs(value) == float("inf"))
    return unique.select(
        *KEYS, F.when(odd, value.cast("string")).alias("odd"), F.when(~odd, value.cast("double")).alias("number")
    )


def dedupe_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest value of each second, whatever its size."""
    rows = _large(tel.family_rows(spark, sf_dir, "cpu"))
    return _kinds(first_per_key(samples(rows, "cpu_pct", "lenient"), KEYS, [POSITION]))


def stream_dedupe_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in a stream; seconds still open at its end come from the batch."""
    folder = _run_folder(spark, "stream-large")
    rows = _large(tel.rows_of(_event_stream(spark, sf_dir), "cpu"))
    unique = unique_samples(stream_samples(rows, "cpu_pct", "lenient"), "cpu_pct", "10 seconds")
    unique = unique.select("server_id", F.unix_seconds("ts").alias("ts_sec"), "cpu_pct", F.col("ts").alias("window_start"))
    cores = spark.sparkContext.defaultParallelism
    write_available(unique, f"{folder}/unique", f"{folder}/state", cores).awaitTermination()
    closed = spark.read.schema(unique.schema).parquet(f"{folder}/unique").select(*KEYS, "cpu_pct")
    last = closed.agg(F.max("ts_sec")).scalar()
    batch = first_per_key(samples(_large(tel.family_rows(spark, sf_dir, "cpu")), "cpu_pct", "lenient"), KEYS, [POSITION])
    return _kinds(closed.unionByName(batch.where(last.isNull() | (F.col("ts_sec") > last))))


def _drops(spark, sf_dir, folder, *conditions):
    """The events in several writes to one folder, one after each request; then the stream of the folder."""
    for condition in conditions:
        tel.events(spark, sf_dir).where(condition).write.mode("append").parquet(f"{folder}/events")
        yield spark.readStream.schema(tel.EVENTS).parquet(f"{folder}/events")


#: Events of a stream's batch per core. Its seconds stay in the state, in memory, until the next batch has closed them.
_BATCH_EVENTS = 400_000


def _slices(rows: DataFrame, most: int) -> list[Column]:
    """Conditions that cut events into equal ranges of ids, of up to about ``most``."""
    count = -(-rows.count() // most)
    if count < 2:
        return [F.lit(True)]
    places = F.percentile_approx("event_id", [n / count for n in range(1, count)])
    bounds = [None, *sorted(set(rows.agg(places).first()[0])), None]
    i = F.col("event_id")
    return [
        (F.lit(True) if first is None else i > first) & (F.lit(True) if last is None else i <= last)
        for first, last in zip(bounds, bounds[1:])
    ]


def _drops_in_batches(spark, sf_dir, folder, *conditions):
    """As ``_drops``, of any number of events: files are in order of time, and the stream takes so many at once as it has written of a slice."""
    files = spark.sparkContext.defaultParallelism
    for condition in conditions:
        rows = tel.events(spark, sf_dir).where(condition)
        for part in _slices(rows, files * _BATCH_EVENTS):
            rows.where(part).repartitionByRange(files, "event_id").write.mode("append").parquet(f"{folder}/events")
        yield spark.readStream.schema(tel.EVENTS).option("maxFilesPerTrigger", files).parquet(f"{folder}/events")


def _stream_sides(events: DataFrame) -> list[DataFrame]:
    return [
        stream_samples(tel.rows_of(events, f), FAMILY_METRICS[f][0], "lenient", "event_id") for f in ("cpu", "mem")
    ]


def _halfway(spark, sf_dir) -> int:
    return (tel.events(spark, sf_dir).agg(F.max("event_id")).first()[0] or 0) // 2


def stream_clamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that finds its first sample itself, stopped half way and run again."""
    folder = _run_folder(spark, "stream-clamped")
    cores = spark.sparkContext.defaultParallelism
    half = _halfway(spark, sf_dir)
    for events in _drops(spark, sf_dir, folder, F.col("event_id") < half, F.col("event_id") >= half):
        alerts = stream_report(*_stream_sides(events), CPU_MEM, delay=f"{tel.STREAM_DELAY_SECONDS} seconds", first_second=True)
        query = write_clamped(alerts, f"{folder}/report", f"{folder}/state", SlidingWindow(), cores)
        query.awaitTermination()
    return with_tail(_closed(spark, f"{folder}/report", alerts.drop(FIRST_SECOND)), _cpu_mem(spark, sf_dir))


def _closed(spark, path, like):
    if not exists(spark, path):
        return _epoch(spark.createDataFrame([], like.schema))
    return _read_report(spark, path, like)


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every twentieth event comes long after its windows are closed; their windows are corrected."""
    folder = _run_folder(spark, "stream-late")
    cores = spark.sparkContext.defaultParallelism
    late = F.col("event_id") % 20 == 3
    window = SlidingWindow(origin=tel.FIRST_SECOND)
    for events in _drops_in_batches(spark, sf_dir, folder, ~late, late):
        alerts = stream_report(
            *_stream_sides(events), CPU_MEM, window, delay=f"{tel.STREAM_DELAY_SECONDS} seconds", merged=True
        )
        write_available(alerts, f"{folder}/report", f"{folder}/state", cores).awaitTermination()
        late_folders = (f"{folder}/late", f"{folder}/late-state")
        # both queries have had the same files under the same limit, none came between them
        correct_late(
            *_stream_sides(events), CPU_MEM, window, *late_folders, tel.STREAM_DELAY_SECONDS, in_step=True
        ).awaitTermination()
    closed = spark.read.schema(alerts.schema).parquet(f"{folder}/report").select(*alerts.columns)
    whole = corrected(closed, read_corrections(spark, f"{folder}/late", closed))
    return with_tail(_epoch(whole), _cpu_mem(spark, sf_dir), _epoch(closed))


def stream_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds that change half way, in a file that comes after the stream has begun."""
    folder = _run_folder(spark, "stream-thresholds")
    cores = spark.sparkContext.defaultParallelism
    half = _halfway(spark, sf_dir)
    window = SlidingWindow(origin=tel.FIRST_SECOND)
    changes = [(tel.FIRST_SECOND, THRESHOLDS), (tel.FIRST_SECOND + half // 2, tel.LATER_THRESHOLDS)]
    limits = lambda: read_threshold_versions(spark, f"{folder}/limits")
    drops = _drops(spark, sf_dir, folder, F.col("event_id") < half, F.col("event_id") >= half)
    for events, (since, values) in zip(drops, changes):
        text = "\n".join(f"{name}: {value}" for name, value in values.items())
        spark.range(1).select(F.lit(text).alias("value")).coalesce(1).write.text(f"{folder}/limits/valid_from={since}")
        windows = stream_report(
            *_stream_sides(events), CPU_MEM, window, None, f"{tel.STREAM_DELAY_SECONDS} seconds", first_second=True
        )
        write_clamped(
            windows, f"{folder}/report", f"{folder}/state", window, cores, lambda rows: with_alert(rows, CPU_MEM, limits())
        ).awaitTermination()
    batch = _cpu_mem(spark, sf_dir, thresholds=limits())
    return with_tail(_closed(spark, f"{folder}/report", with_alert(windows.drop(FIRST_SECOND), CPU_MEM, THRESHOLDS)), batch)


def stream_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide CSV files in three drops to topic folders, the stream run after each."""
    folder = _run_folder(spark, "stream-fanout")
    wide = tel.dataset(spark, sf_dir)
    for n in range(3):
        rows = wide.where(F.col("event_id") % 3 == n).drop("event_id")
        rows.write.mode("append").options(header=True, **CSV_TEXT).csv(f"{folder}/wide")
        records = fan_out(stream_dataset_csv(spark, f"{folder}/wide"))
        write_topic_stream(records, f"{folder}/topics", f"{folder}/state").awaitTermination()
    return _decoded_topics(read_topic_stream(spark, f"{folder}/topics"))


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all kinds in two drops, split by problem as they come."""
    folder = _run_folder(spark, "stream-quarantine")
    records = _malformed(spark, sf_dir)
    for n in range(2):
        half = records.where(F.col("event_id") % 2 == n)
        half.select(F.coalesce("value", F.lit("")).alias("value")).write.mode("append").text(f"{folder}/records")
        rows = decode_family(stream_record_files(spark, f"{folder}/records"), "cpu")
        problem_counts(write_split_stream(rows, "lenient", f"{folder}/split", f"{folder}/state"))
    split = read_split(spark, f"{folder}/split", "ts string, server_id string, cpu_pct float")
    return split.select("ts", "server_id", "cpu_pct", "problem")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__.removesuffix("_query"): f
    for f in (
        fanout_topics,
        fanout_bad_rows,
        parse_numbers,
        ts_default_date,
        decode_topic_json,
        decode_malformed,
        round_metrics_query,
        threshold_table,
        raw_snapshot_cpu,
        raw_snapshot_mem,
        raw_snapshot_net,
        raw_snapshot_disk,
        truncate_seconds,
        parse_strict_vs_lenient,
        dedupe_second,
        dedupe_without_order,
        join_cpu_mem,
        join_net_disk,
        join_dup_fanout,
        window_origin,
        window_assign,
        window_unclamped,
        window_clamp,
        window_offset,
        window_uneven,
        window_gap,
        cpu_mem_windows,
        net_disk_windows,
        cpu_mem_alerts,
        net_disk_alerts,
        net_disk_alerts_dup,
        cpu_mem_from_records,
        net_disk_from_records,
        net_disk_from_snapshots,
        alert_null_semantics,
        alert_boundary,
        alert_rows_query,
        alert_summary_query,
        alerts_from_table,
        report_sorted,
        multi_day_windows,
        tod_collapse,
        csv_round_trip,
        stream_cpu_mem_alerts,
        stream_repeats,
        dedupe_subsecond,
        join_null_keys,
        csv_odd_text,
        tod_zone,
        pipeline_files,
        exact_average,
        report_ordered,
        report_day_range,
        report_refresh,
        snapshot_incremental,
        dedupe_large,
        stream_dedupe_large,
        stream_clamped,
        stream_late,
        stream_thresholds,
        stream_fanout,
        stream_quarantine,
    )
}
