"""Streams beyond the plain report: clamp, late samples, records to topics, records by problem."""

import json
import os
import shutil
from glob import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streaming import DELAY, FIRST, batch, epoch, metrics, record, write_files

from vigil.config import CPU_MEM, SlidingWindow
from vigil.operators.decode import flag_problems, with_second
from vigil.operators.fanout import fan_out
from vigil.plans.snapshots import decode_family
from vigil.sources import tables
from vigil.sources.records import stream_record_files
from vigil.streaming.clamp import stored_origin, write_clamped
from vigil.streaming.late import correct_late, corrected, read_corrections
from vigil.streaming.records import (
    problem_counts,
    read_split,
    read_topic_stream,
    stream_dataset_csv,
    write_split_stream,
    write_topic_stream,
)
from vigil.streaming.reports import stream_report, stream_samples, with_tail, write_available
from vigil.workload import queries

FAMILIES = ("cpu", "mem")


def sides(spark, folder, per_batch=1):
    return [
        stream_samples(decode_family(stream_record_files(spark, str(folder / f), max_files=per_batch), f), f"{f}_pct", "lenient")
        for f in FAMILIES
    ]


def clamped(spark, folder, window=SlidingWindow()):
    alerts = stream_report(*sides(spark, folder), CPU_MEM, window, delay=f"{DELAY} seconds", first_second=True)
    write_clamped(alerts, str(folder / "out"), str(folder / "checkpoint"), window, 2).awaitTermination()


def stored(spark, folder):
    return rows(epoch(spark.read.parquet(str(folder / "out")).drop("date", "batch")))


def closed_by(frame, second):
    return rows(frame.where(F.col("window_end") <= FIRST + second - DELAY))


def test_clamp_finds_the_first_sample(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(7, 60), range(60, 120)])
    clamped(spark, tmp_path)
    assert stored(spark, tmp_path) == closed_by(batch(spark, tmp_path), 119) and stored(spark, tmp_path)
    assert stored_origin(spark, str(tmp_path / "checkpoint")) == FIRST + 7
    for f in FAMILIES:  # a later run knows it
        write_files(tmp_path, f, [range(120, 200)])
    clamped(spark, tmp_path)
    assert stored(spark, tmp_path) == closed_by(batch(spark, tmp_path), 199)


def test_clamp_when_nothing_closes_at_first(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(3, 9)])
    clamped(spark, tmp_path)
    assert stored_origin(spark, str(tmp_path / "checkpoint")) is None and not (tmp_path / "out").exists()
    for f in FAMILIES:
        write_files(tmp_path, f, [range(9, 100)])
    clamped(spark, tmp_path)
    assert stored(spark, tmp_path) == closed_by(batch(spark, tmp_path), 99)


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(5, 60), range(60, 120)])
    clamped(spark, tmp_path)
    before = stored(spark, tmp_path)
    last = max(int(os.path.basename(p)) for p in glob(f"{tmp_path}/checkpoint/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):  # as if the run had ended before it noted its last batch
        if os.path.exists(path := f"{tmp_path}/checkpoint/commits/{name}"):
            os.remove(path)
    clamped(spark, tmp_path)
    assert stored(spark, tmp_path) == before


def test_clamp_equals_batch_with_offset(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(8, 150)])
    window = SlidingWindow(size=25, slide=10, offset=4)
    clamped(spark, tmp_path, window)
    from vigil.plans.reports import report

    frames = [with_second(decode_family(spark.read.text(str(tmp_path / f)), f), "lenient") for f in FAMILIES]
    whole = report(*frames, CPU_MEM, window, labels="epoch")
    assert stored(spark, tmp_path) == closed_by(whole, 149) and stored(spark, tmp_path)


# Late samples


def run_both(spark, folder, window=SlidingWindow(origin=FIRST)):
    alerts = stream_report(*sides(spark, folder), CPU_MEM, window, delay=f"{DELAY} seconds")
    write_available(alerts, str(folder / "report"), str(folder / "state"), 2).awaitTermination()
    correct_late(*sides(spark, folder), CPU_MEM, window, str(folder / "late"), str(folder / "late-state"), DELAY).awaitTermination()


def now(spark, folder):
    plain = spark.read.parquet(str(folder / "report")).drop("date")
    whole = corrected(plain, read_corrections(spark, str(folder / "late"), plain))
    return rows(with_tail(epoch(whole), batch(spark, folder))), plain


def late_file(folder, family, name, seconds, server, values=None):
    lines = [record(s, server, **(values or metrics(s, 0)[family == "mem"])) for s in seconds]
    (folder / family / name).write_text("\n".join(lines))


def test_late_samples_equal_batch(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(0, 60), range(60, 120), range(120, 180)])
    run_both(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))
    for f in FAMILIES:
        late_file(tmp_path, f, "a.json", range(20, 25), "srv-0", {f"{f}_pct": 99.5})  # larger: kept of its second
        late_file(tmp_path, f, "b.json", range(30, 35), "srv-new")
    late_file(tmp_path, "cpu", "c.json", range(40, 45), "one-sided")
    run_both(spark, tmp_path)
    found, plain = now(spark, tmp_path)
    assert found == rows(batch(spark, tmp_path)) and found != rows(epoch(plain))
    assert spark.read.parquet(f"{tmp_path}/late/corrections").count() > 0
    for f in FAMILIES:  # again into a corrected window, the other side of one-sided, and on time
        late_file(tmp_path, f, "d.json", range(22, 24), "srv-0", {f"{f}_pct": 99.9})
        write_files(tmp_path, f, [range(180, 260)])
    late_file(tmp_path, "mem", "e.json", range(40, 45), "one-sided")
    run_both(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


def test_late_windows_still_open(spark, tmp_path):
    """Samples come in any order; a window corrected while it is open takes what comes on time, too."""
    spans = [range(100, 130), range(60, 100), range(0, 60), range(130, 170), range(125, 135), range(170, 230)]
    for f in FAMILIES:
        write_files(tmp_path, f, spans)
        run_both(spark, tmp_path) if f == "mem" else None
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


def test_a_repeated_late_batch_replaces_itself(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(0, 60), range(60, 120), range(10, 20)])
    run_both(spark, tmp_path)
    before = rows(spark.read.parquet(f"{tmp_path}/late/corrections"))
    samples = spark.read.parquet(f"{tmp_path}/late/samples").count()
    last = max(int(os.path.basename(p)) for p in glob(f"{tmp_path}/late-state/commits/[0-9]*"))
    for name in (f"{last}", f".{last}.crc"):
        if os.path.exists(path := f"{tmp_path}/late-state/commits/{name}"):
            os.remove(path)
    run_both(spark, tmp_path)
    assert rows(spark.read.parquet(f"{tmp_path}/late/corrections")) == before
    assert spark.read.parquet(f"{tmp_path}/late/samples").count() == samples
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


def run_in_step(spark, folder):
    """The report with one state for both sides, and corrections that have had the same batches."""
    window = SlidingWindow(origin=FIRST)
    alerts = stream_report(*sides(spark, folder), CPU_MEM, window, delay=f"{DELAY} seconds", merged=True)
    write_available(alerts, str(folder / "report"), str(folder / "state"), 2).awaitTermination()
    places = (str(folder / "late"), str(folder / "late-state"))
    correct_late(*sides(spark, folder), CPU_MEM, window, *places, DELAY, in_step=True).awaitTermination()


def test_in_step_only_what_comes_late_is_corrected(spark, tmp_path):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(0, 60), range(60, 120), range(120, 180)])
        for n, path in enumerate(sorted(glob(f"{tmp_path}/{f}/*.json"))):
            os.utime(path, (FIRST + n, FIRST + n))  # written within a millisecond they would come in any order
    run_in_step(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))
    assert not (tmp_path / "late" / "corrections").exists()  # each batch is older than its own last second, but on time
    for f in FAMILIES:
        late_file(tmp_path, f, "a.json", range(20, 25), "srv-0", {f"{f}_pct": 99.5})
        late_file(tmp_path, f, "b.json", [100], "srv-new")
    late_file(tmp_path, "cpu", "c.json", range(40, 45), "one-sided")
    run_in_step(spark, tmp_path)
    found, plain = now(spark, tmp_path)
    assert found == rows(batch(spark, tmp_path)) and found != rows(epoch(plain))
    for f in FAMILIES:  # some on time, some not
        write_files(tmp_path, f, [range(180, 260), range(150, 175)])
    late_file(tmp_path, "mem", "e.json", range(40, 45), "one-sided")
    run_in_step(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


@pytest.mark.parametrize("run", [run_both, run_in_step])
def test_a_batch_without_samples_corrects_nothing(spark, tmp_path, run):
    for f in FAMILIES:
        (tmp_path / f).mkdir()
        (tmp_path / f / "0.json").write_text("garbage")
    run(spark, tmp_path)
    assert not (tmp_path / "late" / "corrections").exists()
    for f in FAMILIES:
        write_files(tmp_path, f, [range(0, 100), range(10, 15)])
        (tmp_path / f / "z.json").write_text("garbage")
    run(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


@pytest.mark.parametrize("run", [run_both, run_in_step])
def test_a_sample_at_the_watermark_is_corrected(spark, tmp_path, run):
    for f in FAMILIES:
        write_files(tmp_path, f, [range(0, 121)])
    run(spark, tmp_path)
    for f in FAMILIES:  # as old as the delay, so the report drops it; its windows close later
        late_file(tmp_path, f, "a.json", [120 - DELAY], "srv-new")
    run(spark, tmp_path)
    for f in FAMILIES:
        write_files(tmp_path, f, [range(121, 200)])
    run(spark, tmp_path)
    assert now(spark, tmp_path)[0] == rows(batch(spark, tmp_path))


def test_late_query_in_several_batches(spark, tmp_path, monkeypatch):
    """Ids in no order and with gaps: batches are bounded, and what is on time in them is not late."""
    monkeypatch.setattr(queries, "_BATCH_EVENTS", 50, raising=False)
    i = F.when(F.col("id") < 700, F.col("id")).otherwise(F.col("id") + 5000)
    events = spark.range(1400).select(
        i.alias("event_id"),
        F.lit(None).cast("timestamp_ntz").alias("ts"),
        (F.col("id") * 7 % 11).alias("user_id"),
        F.when(F.col("id") % 9 == 0, "error").otherwise("view").alias("event_type"),
        (F.col("id") * 31 % 977 / 10).alias("value"),
        F.lit("").alias("props"),
    )
    events.repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    found = queries.stream_late(spark, str(tmp_path))
    assert rows(found) == rows(queries._cpu_mem(spark, str(tmp_path)).select(found.columns)) and found.count() > 300
    folder = max(glob(f"{spark.conf.get('spark.checkpoint.dir')}/stream-late-*"), key=os.path.getmtime)
    batches = sorted(glob(f"{folder}/late-state/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    assert len(batches) >= 5
    corrected_in = {os.path.basename(p) for p in glob(f"{folder}/late/corrections/*/batch=*")}
    assert corrected_in and corrected_in <= {f"batch={len(batches) - 1}"}  # the late drop alone


def test_corrections_need_the_origin(spark, tmp_path):
    with pytest.raises(ValueError):
        correct_late(None, None, CPU_MEM, SlidingWindow(), "x", "y", 1)


# Wide rows to topics

HEADER = "ts,server_id,cpu_pct,mem_pct,net_in,net_out,disk_io"


def drop(folder, name, seconds, header=HEADER):
    folder.mkdir(exist_ok=True)
    lines = [f"2024-01-01 10:00:{s:02d},srv-{s % 3},{60 + s},{50 + s},{s},1.5,{'x' if s % 7 == 3 else s}" for s in seconds]
    (folder / name).write_text("\n".join([header, *lines]) + "\n")


def send(spark, folder):
    write_topic_stream(fan_out(stream_dataset_csv(spark, str(folder / "in"), 1)), str(folder / "topics"), str(folder / "state")).awaitTermination()


def test_fan_out_stream_over_drops(spark, tmp_path):
    for n in range(3):
        drop(tmp_path / "in", f"{n}.csv", range(n * 20, n * 20 + 20))
        send(spark, tmp_path)
    expected = rows(fan_out(tables.read_dataset_csv(spark, str(tmp_path / "in"))).select("value", "topic"))
    assert rows(read_topic_stream(spark, str(tmp_path / "topics"))) == expected and len(expected) > 200
    disk = read_topic_stream(spark, str(tmp_path / "topics"), "topic-disk")
    assert rows(disk) == [r for r in expected if r[1] == "topic-disk"]


def test_a_killed_fan_out_repeats_nothing(spark, tmp_path):
    drop(tmp_path / "in", "0.csv", range(20))
    drop(tmp_path / "in", "1.csv", range(20, 40))
    send(spark, tmp_path)
    before = rows(read_topic_stream(spark, str(tmp_path / "topics")))
    for path in (tmp_path / "state" / "commits").glob("*1*"):  # written, but not noted as done
        path.unlink()
    send(spark, tmp_path)
    assert rows(read_topic_stream(spark, str(tmp_path / "topics"))) == before
    # files of a batch that never finished are not in the sink's log, so they are not read
    some = next(iter(sorted((tmp_path / "topics" / "topic=topic-cpu").glob("*.txt"))))
    shutil.copy(some, some.with_name("part-left-over.txt"))
    assert rows(read_topic_stream(spark, str(tmp_path / "topics"))) == before


def test_fan_out_stream_refuses_other_headers(spark, tmp_path):
    drop(tmp_path / "in", "0.csv", range(20), HEADER.replace("cpu_pct,mem_pct", "mem_pct,cpu_pct"))
    with pytest.raises(Exception):
        send(spark, tmp_path)


# Records by problem


def split(spark, folder):
    rows_ = decode_family(stream_record_files(spark, str(folder / "in"), max_files=1), "cpu")
    return problem_counts(write_split_stream(rows_, "lenient", str(folder / "out"), str(folder / "state")))


def test_quarantine_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = [
        [record(s, "a", cpu_pct=1.5) for s in range(20)] + ["garbage", '{"ts":"soon","server_id":"a"}'],
        ['{"ts":"2024-01-01 10:00:00"}', json.dumps({"ts": "2024-01-01 10:00:00", "server_id": "b"}), "", "[]"],
    ]
    for i, lines in enumerate(files):
        (tmp_path / "in" / f"{i}.json").write_text("\n".join(lines))
    counts = split(spark, tmp_path)
    assert counts == {"none": 21, "undecodable": 3, "no server": 1, "bad timestamp": 1}
    schema = "ts string, server_id string, cpu_pct float"
    stored = read_split(spark, str(tmp_path / "out"), schema)
    whole = flag_problems(with_second(decode_family(spark.read.text(str(tmp_path / "in")), "cpu"), "lenient"))
    expected = rows(whole.withColumn("problem", F.coalesce("problem", F.lit("none"))))
    assert rows(stored.drop("batch")) == expected
    assert {os.path.basename(p) for p in glob(f"{tmp_path}/out/problem=*")} == {f"problem={p}" for p in ("none", "undecodable", "no server", "bad timestamp")}
    for path in (tmp_path / "state" / "commits").glob("*1*"):
        path.unlink()
    split(spark, tmp_path)
    assert rows(read_split(spark, str(tmp_path / "out"), schema).drop("batch")) == expected
    assert read_split(spark, str(tmp_path / "none"), schema).count() == 0
