"""Reports of some days, refreshed days, and snapshots from new files only."""

import glob
import os
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.config import CPU_MEM, NET_DISK, SlidingWindow
from vigil.operators.decode import with_second
from vigil.plans import days as days_module, incremental
from vigil.plans.days import refresh_report, report_each_day, report_of_days, snapshot_origin, touched_days
from vigil.plans.incremental import refresh_snapshot
from vigil.plans.reports import cpu_mem_report
from vigil.plans.snapshots import decode_family, raw_snapshot
from vigil.sources import sinks, tables
from vigil.sources.days import Days, stored_days
from vigil.sources.ledger import FileLedger

FAMILIES = ("cpu", "mem")
MIDNIGHT = 1704153600  # 2024-01-02 00:00:00


def text(second):
    return F.date_format(F.timestamp_seconds(second), "yyyy-MM-dd HH:mm:ss")


def family(spark, name, seconds, server="a"):
    rows = [(s, server, float((s * 7) % 40 + 60)) for s in seconds]
    frame = spark.createDataFrame(rows, f"second long, server_id string, {name}_pct float")
    return frame.select(text(F.col("second")).alias("ts"), "server_id", f"{name}_pct")


def store(spark, folder, seconds, days=None):
    paths = tuple(f"{folder}/{f}" for f in FAMILIES)
    for f, path in zip(FAMILIES, paths):
        sinks.write_snapshot_by_date(with_second(family(spark, f, seconds), "lenient"), path, days)
    return paths


def whole(spark, paths, window=SlidingWindow()):
    sides = (tables.read_snapshot_parquet(spark, p, f) for p, f in zip(paths, FAMILIES))
    return rows(cpu_mem_report(*sides, window=window))


def files_of(folder):
    return {os.path.relpath(p, folder) for p in glob.glob(f"{folder}/date=*/*.parquet")}


def test_days():
    d = [date(2024, 1, n) for n in range(1, 9)]
    some = Days.of([d[4], d[0], d[1], None, d[1]])
    assert some == Days(((d[0], d[1]), (d[4], d[4])), True)
    assert [x in some for x in d] == [True, True, False, False, True, False, False, False]
    wider = some.reach(before=1, after=2)
    assert d[3] in wider and d[6] in wider and d[7] not in wider
    assert date(1999, 1, 1) in Days.between(None, "2024-01-01") and d[1] not in Days.between(None, "2024-01-01")
    assert touched_days([d[3]], SlidingWindow()) == Days(((d[2], d[3]),))
    assert touched_days([d[3]], SlidingWindow(size=1, slide=1)) == Days(((d[3], d[3]),))


def test_days_select_rows(spark):
    frame = spark.createDataFrame([(date(2024, 1, 1),), (date(2024, 1, 2),), (None,)], "date date")
    for days, n in ((Days(()), 0), (Days.between(None, None), 2), (Days.of([None]), 1), (Days.of([date(2024, 1, 2), None]), 2)):
        assert frame.where(days.holds(F.col("date"))).count() == n


@pytest.mark.parametrize(
    "window",
    [SlidingWindow(), SlidingWindow(clamp=False), SlidingWindow(offset=3), SlidingWindow(size=90000, slide=3600), SlidingWindow(size=25, slide=10, offset=4)],
)
def test_each_day_alone_equals_the_whole(spark, tmp_path, window):
    step = 900 if window.size > 86400 else 1
    near = [s for m in (MIDNIGHT, MIDNIGHT + 86400) for s in range(m - 40 * step, m + 40 * step, step)]
    paths = store(spark, tmp_path, near)
    parts = []
    for day in (date(2023, 12, 31), *(date(2024, 1, n) for n in range(1, 6))):
        parts += rows(report_of_days(spark, CPU_MEM, paths, FAMILIES, Days.of([day]), window))
    assert sorted(parts) == whole(spark, paths, window) and len(parts) > 10
    halves = [rows(report_of_days(spark, CPU_MEM, paths, FAMILIES, Days.between(*ends), window)) for ends in ((None, "2024-01-02"), ("2024-01-03", None))]
    assert sorted(halves[0] + halves[1]) == whole(spark, paths, window)


def test_days_at_once_equal_the_whole_and_cost_few_jobs(spark, tmp_path, monkeypatch):
    """Each day is reported alone, the origin and the folders looked up without a job a day."""
    seconds = [s for d in range(6) for s in range(MIDNIGHT + d * 86400 - 20, MIDNIGHT + d * 86400 + 20, 2)]
    paths = store(spark, tmp_path, seconds)
    looked = []
    lookup = days_module.snapshot_origin
    monkeypatch.setattr(days_module, "snapshot_origin", lambda *a: looked.append(a) or lookup(*a))
    days = stored_days(spark, paths[0])
    counts = report_each_day(spark, CPU_MEM, paths, FAMILIES, f"{tmp_path}/report", days, at_once=3)
    stored = spark.read.parquet(f"{tmp_path}/report")
    assert rows(stored.drop("date")) == whole(spark, paths) and len(looked) == 1
    assert {d: c["total_rows"] for d, c in counts.items()} == {r.date: r["count"] for r in stored.groupBy("date").count().collect()}
    assert len(days) == len(counts) == 7


def test_reading_some_days_opens_their_folders_only(spark, tmp_path):
    paths = store(spark, tmp_path, range(MIDNIGHT - 2 * 86400, MIDNIGHT + 2 * 86400, 7200))
    (tmp_path / "cpu" / "date=2024-01-03" / "bad.parquet").write_text("no parquet")
    some = tables.read_snapshot_parquet(spark, paths[0], "cpu", Days.between("2023-12-31", "2024-01-01"))
    assert some.count() == 24 and all("/date=2024-01-0" not in f or "/date=2024-01-01" in f for f in some.inputFiles())
    assert tables.read_snapshot_parquet(spark, paths[0], "cpu", Days.of([date(2025, 1, 1)])).count() == 0


def test_origin_is_that_of_all_days(spark, tmp_path):
    paths = store(spark, tmp_path, range(MIDNIGHT - 5, MIDNIGHT + 200000, 5000))
    assert snapshot_origin(spark, CPU_MEM, paths, FAMILIES) == MIDNIGHT - 5
    # the first days have no sample in common
    sinks.write_snapshot_by_date(with_second(family(spark, "mem", [MIDNIGHT - 4, MIDNIGHT + 1, MIDNIGHT + 2 * 86400]), "lenient"), paths[1])
    sinks.write_snapshot_by_date(with_second(family(spark, "cpu", [MIDNIGHT - 5, MIDNIGHT + 2, MIDNIGHT + 2 * 86400]), "lenient"), paths[0])
    assert snapshot_origin(spark, CPU_MEM, paths, FAMILIES) == MIDNIGHT + 2 * 86400
    assert snapshot_origin(spark, CPU_MEM, (paths[0], f"{tmp_path}/none"), FAMILIES) is None
    assert report_of_days(spark, CPU_MEM, (paths[0], paths[0]), ("cpu", "mem"), Days.of([])).count() == 0


def test_refresh_replaces_touched_days_only(spark, tmp_path):
    early, late = [s for s in range(MIDNIGHT - 100, MIDNIGHT + 3 * 86400, 37)], [MIDNIGHT + 2 * 86400 + 1 + n for n in range(60)]
    paths = store(spark, tmp_path / "snapshots", early)
    out = str(tmp_path / "report")
    first = refresh_report(spark, CPU_MEM, paths, FAMILIES, out, [])  # not made before: whole
    assert first["total_rows"] == len(whole(spark, paths))
    before = files_of(out)
    store(spark, tmp_path / "snapshots", sorted({*early, *late}))
    counts = refresh_report(spark, CPU_MEM, paths, FAMILIES, out, [date(2024, 1, 4)])
    stored = rows(spark.read.parquet(out).drop("date"))
    assert stored == whole(spark, paths)
    kept = {f for f in before if f.startswith(("date=2024-01-01", "date=2024-01-02"))}
    assert kept and kept <= files_of(out) and not (before - kept) & files_of(out)
    assert counts["total_rows"] == spark.read.parquet(out).where("date >= '2024-01-03'").count()


def test_refresh_moves_the_clamp(spark, tmp_path):
    later = list(range(MIDNIGHT + 86400 + 5, MIDNIGHT + 86400 + 100))
    paths = store(spark, tmp_path / "snapshots", later)
    out = str(tmp_path / "report")
    refresh_report(spark, CPU_MEM, paths, FAMILIES, out, [])
    assert rows(spark.read.parquet(out).drop("date")) == whole(spark, paths)
    store(spark, tmp_path / "snapshots", [MIDNIGHT + 7, MIDNIGHT + 86400 + 3, *later])
    refresh_report(spark, CPU_MEM, paths, FAMILIES, out, [date(2024, 1, 2)])
    assert rows(spark.read.parquet(out).drop("date")) == whole(spark, paths)
    # and back: windows before the new bound leave, also whole days of them
    store(spark, tmp_path / "snapshots", later)
    refresh_report(spark, CPU_MEM, paths, FAMILIES, out, [date(2024, 1, 2), date(2024, 1, 3)])
    assert rows(spark.read.parquet(out).drop("date")) == whole(spark, paths)
    assert stored_days(spark, out) == [date(2024, 1, 3)]


def records(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write("\n".join(f'{{"ts":"{ts}","server_id":"{v}","cpu_pct":{x}}}' for ts, v, x in lines) + "\n")


HALVES = [
    [("2024-01-01 10:00:00", "a", 1.5), ("2024-01-01 10:00:00", "a", 2.5), ("2024-01-02 10:00:00", "a", 3.5), ("soon", "b", 1.0)],
    [("2024-01-02 10:00:00", "a", 9.5), ("2024-01-02 10:00:01", "a", 4.5), ("2024-01-03 10:00:00", "b", 5.5), ("soon", "b", 2.0)],
]


def one_run(spark, folder):
    rows_ = decode_family(spark.read.text(folder).select("value"), "cpu")
    return rows(raw_snapshot(rows_, "cpu", ordered=False))


def test_snapshot_from_new_files(spark, tmp_path, monkeypatch):
    source, out = str(tmp_path / "records"), str(tmp_path / "out")
    read = []
    decode = incremental.decode_family

    def spy(records, family, *more):
        read.append(sorted(os.path.basename(f) for f in records.inputFiles()))
        return decode(records, family, *more)

    monkeypatch.setattr(incremental, "decode_family", spy)
    records(source, "one.json", HALVES[0])
    assert refresh_snapshot(spark, source, out, "cpu", "lenient") == {"new_files": 1, "days": [None, "2024-01-01", "2024-01-02"]}
    before = files_of(out)
    records(source, "two.json", HALVES[1])
    assert refresh_snapshot(spark, source, out, "cpu", "lenient") == {"new_files": 1, "days": [None, "2024-01-02", "2024-01-03"]}
    assert rows(tables.read_snapshot_parquet(spark, out, "cpu")) == one_run(spark, source)
    assert read == [["one.json"], ["two.json"]]
    assert {f for f in before if "2024-01-01" in f} <= files_of(out)
    assert refresh_snapshot(spark, source, out, "cpu", "lenient") == {"new_files": 0, "days": []}
    notes = FileLedger(spark, f"{out}/_ledger")
    assert notes.last_run() == 2 and notes.files().count() == 2
    assert os.listdir(f"{out}/_ledger/files") == ["run=2"] and os.listdir(f"{out}/_ledger/days") == []


def test_snapshot_after_failures(spark, tmp_path, monkeypatch):
    source, out = str(tmp_path / "records"), str(tmp_path / "out")
    records(source, "one.json", HALVES[0])
    refresh_snapshot(spark, source, out, "cpu", "lenient")
    records(source, "two.json", HALVES[1])

    def fails(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:  # after the days were written
        patch.setattr(FileLedger, "commit", fails)
        with pytest.raises(RuntimeError):
            refresh_snapshot(spark, source, out, "cpu", "lenient")
    notes = FileLedger(spark, f"{out}/_ledger")
    assert notes.last_run() == 1 and set(notes.interrupted_days()) == {None, date(2024, 1, 2), date(2024, 1, 3)}
    # a day was lost while it was replaced
    storage_day = glob.glob(f"{out}/date=2024-01-02/*.parquet")
    for path in storage_day:
        os.remove(path)
    assert refresh_snapshot(spark, source, out, "cpu", "lenient")["new_files"] == 1
    assert rows(tables.read_snapshot_parquet(spark, out, "cpu")) == one_run(spark, source)
    assert notes.interrupted_days() == [] and notes.last_run() == 3 and notes.files().count() == 2
    # a commit that ended half way does not count
    records(source, "three.json", [("2024-01-05 10:00:00", "c", 1.0)])
    refresh_snapshot(spark, source, out, "cpu", "lenient")
    os.remove(f"{out}/_ledger/files/run=4/_SUCCESS")
    assert notes.last_run() == 0 and refresh_snapshot(spark, source, out, "cpu", "lenient")["new_files"] == 3
    assert rows(tables.read_snapshot_parquet(spark, out, "cpu")) == one_run(spark, source) and notes.last_run() == 5


def test_snapshot_from_no_files(spark, tmp_path):
    os.makedirs(tmp_path / "records")
    assert refresh_snapshot(spark, str(tmp_path / "records"), str(tmp_path / "out"), "cpu", "lenient") == {"new_files": 0, "days": []}
    records(tmp_path / "records", "empty.json", [])
    assert refresh_snapshot(spark, str(tmp_path / "records"), str(tmp_path / "out"), "cpu", "lenient") == {"new_files": 1, "days": []}
    assert refresh_snapshot(spark, str(tmp_path / "records"), str(tmp_path / "out"), "cpu", "lenient") == {"new_files": 0, "days": []}


def test_net_disk_days(spark, tmp_path):
    """Repeats multiply alike by day and in the whole."""
    paths = (f"{tmp_path}/net", f"{tmp_path}/disk")
    seconds = [MIDNIGHT - 20 + n // 2 for n in range(80)]
    net = spark.createDataFrame([(s, "a", float(s % 50), 1.0) for s in seconds], "second long, server_id string, net_in float, net_out float")
    disk = spark.createDataFrame([(s, "a", float(s % 30)) for s in seconds], "second long, server_id string, disk_io float")
    for frame, path in ((net, paths[0]), (disk, paths[1])):
        stamped = frame.withColumn("ts", text(F.col("second"))).drop("second")
        sinks.write_snapshot_by_date(with_second(stamped.select("ts", *[c for c in stamped.columns if c != "ts"]), "strict"), path)
    days = [Days.of([date(2024, 1, n)]) for n in (1, 2)]
    parts = [r for d in days for r in rows(report_of_days(spark, NET_DISK, paths, ("net", "disk"), d))]
    assert sorted(parts) == rows(report_of_days(spark, NET_DISK, paths, ("net", "disk"), Days.between(None, None))) and len(parts) == 4
