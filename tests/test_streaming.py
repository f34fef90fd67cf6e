from dataclasses import replace

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.config import CPU_MEM, NET_DISK, SlidingWindow
from vigil.operators.decode import with_second
from vigil.plans.reports import cpu_mem_report, report
from vigil.plans.snapshots import decode_family
from vigil.sources.records import stream_record_files
from vigil.streaming.reports import late_rows, stream_report, stream_samples, with_tail, write_available
from vigil.workload.queries import QUERIES

FIRST = 1704150000
DELAY = 20


def record(second, server, **metrics):
    fields = "".join(f',"{m}":{v}' for m, v in metrics.items())
    ts = f'2024-01-01 23:{second // 60:02d}:{second % 60:02d}'
    return f'{{"ts":"{ts}","server_id":"{server}"{fields}}}'


def metrics(second, server):
    return {"cpu_pct": 60 + second * 7 % 40}, {"mem_pct": 60 + (second * 11 + server) % 40}


def write_files(folder, family, spans):
    """One file per span of seconds; file times decide the order they are read in."""
    (folder / family).mkdir(parents=True, exist_ok=True)
    for i, span in enumerate(spans):
        lines = [
            record(s, f"srv-{v}", **metrics(s, v)[family == "mem"]) for s in span for v in range(2)
        ]
        (folder / family / f"{i}-{span[0]}.json").write_text("\n".join(lines + ["garbage", lines[0], '{"ts":"soon","server_id":"srv-0"}']))


def stream(spark, folder, rule=CPU_MEM, window=SlidingWindow(origin=FIRST), families=("cpu", "mem")):
    sides = [
        stream_samples(
            decode_family(stream_record_files(spark, str(folder / f), max_files=1), f), metric, rule.timestamps
        )
        for f, metric in zip(families, (rule.left, rule.right))
    ]
    alerts = stream_report(*sides, rule, window, delay=f"{DELAY} seconds")
    write_available(alerts, str(folder / "out"), str(folder / "checkpoint")).awaitTermination()


def stored(spark, folder):
    return rows(epoch(spark.read.parquet(str(folder / "out")).drop("date")))


def epoch(frame):
    return frame.withColumns({c: F.unix_seconds(c) for c in ("window_start", "window_end")})


def batch(spark, folder, rule=CPU_MEM, families=("cpu", "mem")):
    sides = [
        with_second(decode_family(spark.read.text(str(folder / f)), f), rule.timestamps) for f in families
    ]
    return report(*sides, replace(rule, duplicates="first"), labels="epoch")


def test_stream_equals_batch_and_continues(spark, tmp_path):
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 60), range(60, 120)])
    stream(spark, tmp_path)
    first = stored(spark, tmp_path)
    closed = batch(spark, tmp_path).where(F.col("window_end") <= FIRST + 119 - DELAY)
    assert first == rows(closed) and len(first) > 10
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(120, 180)])
    stream(spark, tmp_path)
    second = stored(spark, tmp_path)
    closed = batch(spark, tmp_path).where(F.col("window_end") <= FIRST + 179 - DELAY)
    assert second == rows(closed) and len(second) > len(first)


def test_without_origin_early_windows_stay(spark, tmp_path):
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(5, 100)])
    stream(spark, tmp_path, window=SlidingWindow())
    starts = {r[1] - FIRST for r in stored(spark, tmp_path)}
    assert min(starts) == -20


def test_ingest_order_decides_among_repeats(spark, tmp_path):
    """The sample with the lowest position wins, whichever row comes first in the file."""
    schema = "ts string, server_id string, cpu_pct float, mem_pct float, pos bigint"
    text = lambda s: f"2024-01-01 23:{s // 60:02d}:{s % 60:02d}"
    values = [(text(s), "s", float(v), 1.0, 9 - v) for s in range(0, 120) for v in range(3)]
    spark.createDataFrame(values, schema).write.parquet(str(tmp_path / "in"))
    source = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    alerts = stream_report(
        stream_samples(source(), "cpu_pct", "lenient", "pos"),
        stream_samples(source(), "mem_pct", "lenient", "pos"),
        CPU_MEM,
        delay=f"{DELAY} seconds",
    )
    write_available(alerts, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    stored_rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert stored_rows and {r.avg_cpu for r in stored_rows} == {2.0}


def test_state_partitions_are_set_for_the_query_alone(spark, tmp_path):
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 60)])
    sides = [
        stream_samples(decode_family(stream_record_files(spark, str(tmp_path / f)), f), f"{f}_pct", "lenient")
        for f in ("cpu", "mem")
    ]
    query = write_available(
        stream_report(*sides, CPU_MEM, delay=f"{DELAY} seconds"), str(tmp_path / "out"), str(tmp_path / "checkpoint"), 2
    )
    query.awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == usual
    assert {s["numShufflePartitions"] for p in query.recentProgress for s in p["stateOperators"]} == {2}
    assert spark.read.parquet(str(tmp_path / "out")).count() > 0


def test_other_rule(spark, tmp_path):
    for family, text in (("net", {"net_in": 6000, "net_out": 1}), ("disk", {"disk_io": 1})):
        (tmp_path / family).mkdir()
        (tmp_path / family / "0.json").write_text("\n".join(record(s, "s", **text) for s in range(120)))
    stream(spark, tmp_path, NET_DISK, families=("net", "disk"))
    found = stored(spark, tmp_path)
    assert found and {r[-1] for r in found} == {NET_DISK.texts[1]}


def test_gaps_are_refused(spark, tmp_path):
    write_files(tmp_path, "cpu", [range(2)])
    side = stream_samples(decode_family(stream_record_files(spark, str(tmp_path / "cpu")), "cpu"), "cpu_pct", "lenient")
    with pytest.raises(ValueError):
        stream_report(side, side, CPU_MEM, SlidingWindow(size=10, slide=30))


def test_repeats_are_chosen_as_in_batch(spark, tmp_path):
    """Each second has 95.0 and 10.0, in either order; both say there is a spike."""
    for family, values in (("cpu", (95.0, 10.0)), ("mem", (10.0, 10.0))):
        (tmp_path / family).mkdir()
        for i in range(2):
            lines = [record(s, "s", **{f"{family}_pct": v}) for s in range(i * 60, i * 60 + 60) for v in (values if s % 2 else values[::-1])]
            (tmp_path / family / f"{i}.json").write_text("\n".join(lines))
    stream(spark, tmp_path)
    sides = [decode_family(spark.read.text(str(tmp_path / f)), f) for f in ("cpu", "mem")]
    expected = epoch(cpu_mem_report(*sides)).where(F.col("window_end") <= FIRST + 119 - DELAY)
    assert stored(spark, tmp_path) == rows(expected)
    assert {r[-1] for r in stored(spark, tmp_path)} == {CPU_MEM.texts[1]}


def test_uneven_windows_equal_batch(spark, tmp_path):
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 150)])
    stream(spark, tmp_path, window=SlidingWindow(size=60, slide=7, origin=FIRST))
    sides = [with_second(decode_family(spark.read.text(str(tmp_path / f)), f), "lenient") for f in ("cpu", "mem")]
    whole = report(*sides, replace(CPU_MEM, duplicates="first"), SlidingWindow(size=60, slide=7), labels="epoch")
    found = stored(spark, tmp_path)
    assert found == rows(whole.where(F.col("window_end") <= FIRST + 149 - DELAY)) and len(found) > 5


def test_tail_and_late_rows(spark, tmp_path):
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 60), range(60, 120)])
    stream(spark, tmp_path)
    closed = epoch(spark.read.parquet(str(tmp_path / "out")).drop("date"))
    assert rows(with_tail(closed, batch(spark, tmp_path))) == rows(batch(spark, tmp_path))
    assert rows(with_tail(closed.limit(0), batch(spark, tmp_path))) == rows(batch(spark, tmp_path))
    for family in ("cpu", "mem"):
        (tmp_path / family / "late.json").write_text("\n".join(record(s, "srv-7", **{f"{family}_pct": 1.0}) for s in range(5)))
    sides = [
        stream_samples(decode_family(stream_record_files(spark, str(tmp_path / f), max_files=1), f), f"{f}_pct", "lenient")
        for f in ("cpu", "mem")
    ]
    alerts = stream_report(*sides, CPU_MEM, SlidingWindow(origin=FIRST), delay=f"{DELAY} seconds")
    assert late_rows(write_available(alerts, str(tmp_path / "out"), str(tmp_path / "checkpoint"))) == 10


def test_text_is_parsed_once(spark, tmp_path):
    """Not in a filter below the watermark, too."""
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 30)])
    sides = [
        stream_samples(decode_family(stream_record_files(spark, str(tmp_path / f)), f), f"{f}_pct", "lenient")
        for f in ("cpu", "mem")
    ]
    query = write_available(stream_report(*sides, CPU_MEM, delay="1 hour"), str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    assert query._jsq.explainInternal(False).count("RLIKE") == 2  # once a side


def test_samples_are_not_multiplied_before_the_first_shuffle(spark, tmp_path):
    for family in ("cpu", "mem"):
        write_files(tmp_path, family, [range(0, 30)])
    sides = [
        stream_samples(decode_family(stream_record_files(spark, str(tmp_path / f)), f), f"{f}_pct", "lenient")
        for f in ("cpu", "mem")
    ]
    query = write_available(stream_report(*sides, CPU_MEM, delay="1 second"), str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    plan = query._jsq.explainInternal(False)
    first_shuffle = plan.rindex("Exchange")
    assert "Expand" not in plan[first_shuffle:]


@pytest.mark.parametrize("events", ["event_id >= 0", "event_id < 100", "false"])
def test_streaming_query_over_a_folder_of_files(spark, tmp_path, events):
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet").where(events)
    table.repartition(3).write.parquet(str(tmp_path / "events.parquet"))
    found = QUERIES["stream_cpu_mem_alerts"](spark, str(tmp_path))
    assert rows(found) == rows(QUERIES["cpu_mem_alerts"](spark, str(tmp_path)))
