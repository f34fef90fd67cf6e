"""The command line jobs, from a wide CSV to reports."""

from datetime import datetime, timezone

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.__main__ import RUN, arguments

FIRST = 1761004790  # 2025-10-20 23:59:50 UTC


@pytest.fixture(scope="module")
def place(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("jobs")
    lines = ["ts,server_id,cpu_pct,mem_pct,net_in,net_out,disk_io"]
    for s in range(100):
        second = datetime.fromtimestamp(FIRST + s, timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        lines += [f"{second},srv-{v},{85 + s % 10},{80 + v * 5},{s * 100},1,{3000 - s * 10}" for v in range(2)]
    lines += ["23:59:50,srv-9,oops,1,1,1,1", "soon,srv-8,1,1,1,1,1", lines[1]]
    (folder / "wide.csv").write_text("\n".join(lines) + "\n")
    (folder / "limits").write_text("cpu_threshold: 88\nmem_threshold: 82\nnet_in_threshold: 9000\ndisk_io_threshold: 2900\n")
    job(spark, folder, "fan-out", "--dataset", "@wide.csv", "--out", "@topics")
    for family in ("cpu", "mem", "net", "disk"):
        for kind in ("csv", "parquet"):
            job(spark, folder, "snapshot", family, "--records", "@topics", "--out", f"@{family}.{kind}", "--format", kind, "--bad", f"@{family}.bad")
    return folder


def job(spark, folder, *words):
    args = arguments([f"{folder}/{w[1:]}" if w.startswith("@") else w for w in words])
    return RUN[args.job](spark, args)


def test_snapshots_and_bad_rows(spark, place):
    assert spark.read.parquet(f"{place}/cpu.parquet").count() == 201
    stored = spark.read.parquet(f"{place}/cpu.bad")
    assert rows(stored.where("problem <> 'none'").select("ts", "problem")) == [("soon", "bad timestamp")]
    assert stored.where("problem = 'none'").count() == 201  # one line is there twice
    assert spark.read.parquet(f"{place}/mem.parquet").where("server_id = 'srv-9'").count() == 0


@pytest.mark.parametrize("report,left,right", [("cpu_mem", "cpu", "mem"), ("net_disk", "net", "disk")])
def test_reports(spark, place, report, left, right):
    results = {}
    for kind in ("csv", "parquet"):
        words = ["report", report, "--left", f"@{left}.{kind}", "--right", f"@{right}.{kind}", "--format", kind, "--thresholds", "@limits"]
        counts = job(spark, place, *words, "--out", f"@{report}.from_{kind}")
        stored = spark.read.parquet(f"{place}/{report}.from_{kind}")
        assert counts == {"total_rows": stored.count(), "alert_rows": stored.where("alert <> ''").count()}
        assert counts["total_rows"] == 20 and 0 < counts["alert_rows"]
        results[kind] = rows(stored)
    assert results["csv"] == results["parquet"]
    labelled = job(spark, place, *words, "--out", f"@{report}.labels", "--out-format", "csv", "--time-of-day")
    assert labelled == counts
    lines = spark.read.option("header", True).csv(f"{place}/{report}.labels").collect()
    assert {"23:59:50", "00:00:00"} <= {r.window_start for r in lines} and len(lines) == 20


LIMITS = ["--thresholds", "@limits"]


def report_words(place, *more):
    return ["report", "cpu_mem", "--left", "@cpu.parquet", "--right", "@mem.parquet", *LIMITS, *more]


def test_reports_of_days(spark, place):
    job(spark, place, *report_words(place, "--out", "@whole"))
    whole = rows(spark.read.parquet(f"{place}/whole"))
    assert len({r[-1] for r in whole}) == 2
    first = job(spark, place, *report_words(place, "--to-date", "2025-10-20", "--out", "@by_day"))
    kept = rows(spark.read.parquet(f"{place}/by_day"))
    second = job(spark, place, *report_words(place, "--from-date", "2025-10-21", "--out", "@by_day"))
    assert rows(spark.read.parquet(f"{place}/by_day")) == whole and 0 < len(kept) < len(whole)
    assert first["total_rows"] + second["total_rows"] == len(whole)
    # other labels and formats
    words = report_words(place, "--time-of-day", "--out-format", "csv", "--from-date", "2025-10-21")
    assert job(spark, place, *words, "--out", "@labels_of_day")["total_rows"] == second["total_rows"]


def test_sorted_csv_in_ranges(spark, place):
    job(spark, place, *report_words(place, "--out-format", "csv", "--out", "@plain"))
    job(spark, place, *report_words(place, "--out-format", "csv", "--ranges", "3", "--out", "@ranges"))
    lines = [[line for p in sorted((place / n).glob("*.csv")) for line in p.read_text().splitlines()[1:]] for n in ("plain", "ranges")]
    assert lines[0] == lines[1] == sorted(lines[0]) and len(lines[0]) == 20
    with pytest.raises(SystemExit):
        arguments("report cpu_mem --left a --right b --ranges 3 --out c".split())


def test_report_after_changed_days(spark, place):
    job(spark, place, *report_words(place, "--changed", "2025-10-21", "--out", "@changed"))
    job(spark, place, *report_words(place, "--out", "@whole2"))
    whole = rows(spark.read.parquet(f"{place}/whole2"))
    assert rows(spark.read.parquet(f"{place}/changed")) == whole
    job(spark, place, *report_words(place, "--changed", "2025-10-20", "--out", "@changed"))
    assert rows(spark.read.parquet(f"{place}/changed")) == whole


def test_incremental_snapshot(spark, place):
    words = ["snapshot", "cpu", "--records", "@topics", "--out", "@cpu.incremental", "--incremental"]
    first = job(spark, place, *words)
    assert first["new_files"] > 0 and first["days"] == [None, "2025-10-20", "2025-10-21"]
    assert rows(spark.read.parquet(f"{place}/cpu.incremental")) == rows(spark.read.parquet(f"{place}/cpu.parquet"))
    assert job(spark, place, *words) == {"new_files": 0, "days": []}


def test_streams_of_records(spark, place):
    (place / "drops").mkdir()
    (place / "drops" / "a.csv").write_text((place / "wide.csv").read_text())
    words = ["fan-out", "--dataset", "@drops", "--out", "@topic_stream", "--checkpoint", "@topic_state"]
    for _ in range(2):
        job(spark, place, *words)
    sent = spark.read.schema("value string, topic string").text(f"{place}/topic_stream")
    assert rows(sent) == rows(spark.read.schema("value string, topic string").text(f"{place}/topics"))
    words = ["quarantine", "cpu", "--records", "@topics", "--out", "@split", "--checkpoint", "@split_state"]
    counts = job(spark, place, *words)
    assert (counts["none"], counts["bad timestamp"], counts["undecodable"]) == (201, 1, 0)
    assert spark.read.parquet(f"{place}/split").count() == 202


def test_stream_without_origin_and_with_versions(spark, place):
    for since, limits in ((0, (place / "limits").read_text()), (FIRST + 40, "cpu_threshold: 10\nmem_threshold: 10\n")):
        (place / f"versions/valid_from={since}").mkdir(parents=True)
        (place / f"versions/valid_from={since}/limits.txt").write_text(limits)
    versions = ["--threshold-versions", "@versions"]
    words = ["stream", "cpu_mem", "--records", "@topics", "--delay", "10 seconds", "--per-batch", "2", *versions]
    job(spark, place, *words, "--out", "@stream2", "--checkpoint", "@state2")
    job(spark, place, "report", "cpu_mem", "--left", "@cpu.parquet", "--right", "@mem.parquet", *versions, "--out", "@batch2")
    batch = spark.read.parquet(f"{place}/batch2").where(F.unix_seconds("window_end") <= FIRST + 99 - 10)
    assert rows(spark.read.parquet(f"{place}/stream2").drop("batch")) == rows(batch) and batch.count() == 12
    assert {r.alert for r in batch.where(F.unix_seconds("window_end") >= FIRST + 40).collect()} == {"High CPU + Memory stress"}
    late = ["--origin", str(FIRST), "--corrections", "@late"]
    job(spark, place, *words, *late, "--out", "@stream3", "--checkpoint", "@state3")
    assert spark.read.parquet(f"{place}/late/samples").count() > 0


@pytest.mark.parametrize(
    "words",
    [
        "snapshot cpu --servers x --out y --incremental",
        "snapshot cpu --records x --out y --incremental --format csv",
        "report cpu_mem --left a --right b --format csv --from-date 2025-10-20 --out c",
        "report cpu_mem --left a --right b --changed 2025-10-20 --time-of-day --out c",
        "stream cpu_mem --records x --out y --checkpoint z --corrections w",
        "stream cpu_mem --records x --out y --checkpoint z --delay soon",
        "fan-out --dataset x --servers y --checkpoint z",
    ],
)
def test_options_that_do_not_go_together(words):
    with pytest.raises(SystemExit):
        arguments(words.split())


def test_stream_agrees_with_the_report(spark, place):
    words = ["--records", "@topics", "--origin", str(FIRST), "--delay", "10 seconds", "--thresholds", "@limits", "--per-batch", "2"]
    job(spark, place, "stream", "cpu_mem", *words, "--out", "@stream", "--checkpoint", "@state")
    job(spark, place, "report", "cpu_mem", "--left", "@cpu.parquet", "--right", "@mem.parquet", "--thresholds", "@limits", "--out", "@batch")
    batch = spark.read.parquet(f"{place}/batch").where(F.unix_seconds("window_end") <= FIRST + 99 - 10)
    assert rows(spark.read.parquet(f"{place}/stream")) == rows(batch) and batch.count() == 12
