import glob

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from vigil.fixed_values import FAMILY_METRICS, THRESHOLDS
from vigil.operators.decode import flag_problems, with_second
from vigil.operators.fanout import fan_out
from vigil.plans.snapshots import decode_family
from vigil.schemas import dataset_columns, family_schema
from vigil.sources import records, sinks, storage, tables
from vigil.sources.days import Days
from vigil.sources.thresholds import read_thresholds


def written(path):
    parts = sorted(glob.glob(f"{path}/*.csv"))
    return "".join(open(p).read() for p in parts)


def test_schemas():
    assert family_schema("net").names == ["ts", "server_id", "net_in", "net_out"]
    assert all(isinstance(f.dataType, FloatType) for f in family_schema("net")[2:])
    assert dataset_columns() == ["ts", "server_id", "cpu_pct", "mem_pct", "net_in", "net_out", "disk_io"]


def test_csv_text_of_nulls_and_empty_text(spark, tmp_path):
    frame = spark.createDataFrame(
        [("s1", "", 1.5, None), ("s2", "CPU spike suspected", 87.97, ""), (None, "x", float("nan"), "a,b")],
        "a string, b string, c float, e string",
    ).coalesce(1)
    path = str(tmp_path / "out")
    sinks.write_csv(frame, path)
    assert written(path) == 'a,b,c,e\ns1,"",1.5,\ns2,CPU spike suspected,87.97,""\n,x,NaN,"a,b"\n'
    back = tables.read_csv(spark, path, frame.schema).orderBy("a").collect()
    assert [r.b for r in back] == ["x", None, "CPU spike suspected"]
    assert [r.e for r in back] == ["a,b", None, None]


def test_sorted_frame_is_written_in_order(spark, tmp_path):
    path = str(tmp_path / "sorted")
    frame = spark.range(500).selectExpr("lpad(hash(id), 12, '0') k").repartition(4).orderBy("k")
    sinks.write_csv(frame, path)
    lines = [l for l in written(path).splitlines() if l != "k"]
    assert len(lines) == 500 and lines == sorted(lines)


def test_empty_frame_leaves_a_header(spark, tmp_path):
    path = str(tmp_path / "empty")
    sinks.write_csv(spark.createDataFrame([], family_schema("cpu")), path)
    assert written(path) == "ts,server_id,cpu_pct\n"
    assert tables.read_snapshot_csv(spark, path, "cpu").count() == 0


def test_bad_float_is_null_and_wrong_header_is_refused(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text("ts,server_id,cpu_pct\nt,s,oops\nt,s,1.5\n")
    assert [r.cpu_pct for r in tables.read_snapshot_csv(spark, str(good), "cpu").collect()] == [None, 1.5]
    swapped = tmp_path / "swapped.csv"
    swapped.write_text("server_id,ts,cpu_pct\ns,t,1.5\n")
    with pytest.raises(Exception, match="header"):
        tables.read_snapshot_csv(spark, str(swapped), "cpu").collect()


def test_snapshot_parquet(spark, tmp_path):
    path = str(tmp_path / "snap")
    frame = spark.createDataFrame([("t", "s", 1.5, 2.5)], family_schema("net"))
    sinks.write_parquet(frame, path)
    assert rows(tables.read_snapshot_parquet(spark, path, "net")) == [("t", "s", 1.5, 2.5)]


def test_thresholds(spark, tmp_path):
    path = tmp_path / "limits"
    path.write_text("\n".join(f"{k}: {v}" for k, v in THRESHOLDS.items()))
    assert read_thresholds(spark, str(path)).first().asDict() == THRESHOLDS
    path.write_text("# limits\r\n cpu_threshold : 5 \nother: 7\ncpu_threshold:6e0\n")
    row = read_thresholds(spark, str(path)).first()
    assert (row.cpu_threshold, row.mem_threshold) == (6.0, 99999.0)


@pytest.mark.parametrize("line", ["unused: high", "cpu_threshold:", "cpu_threshold: 1: 2"])
def test_bad_threshold_line_fails(spark, tmp_path, line):
    path = tmp_path / "limits"
    path.write_text(f"cpu_threshold: 5\n{line}\ncpu_threshold: 6\n")
    with pytest.raises(Exception, match="1 bad threshold line"):
        read_thresholds(spark, str(path)).collect()


DATASET = """server_id,ts,cpu_pct,mem_pct,net_in,net_out,disk_io
a,10:00:00,1,2,3,4,5
b,2025-10-21 10:00:00,1.5,x,3,4,5
c,10:00:01,1,2,3,,5
d,10:00:02,1,2,3,4
,10:00:03,1,2,3,4,nan
e,,1,2,3,4,5
"""


def sent(frame):
    found = {}
    for r in frame.collect():
        found.setdefault(r.topic, []).append(r.value)
    return found


def test_fan_out_from_csv(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text(DATASET)
    dataset = tables.read_dataset_csv(spark, str(path))
    topics = sent(fan_out(dataset))
    assert topics["topic-cpu"][0] == '{"ts":"2025-10-20 10:00:00","server_id":"a","cpu_pct":1.0}'
    assert topics["topic-cpu"][1] == '{"ts":"2025-10-21 10:00:00","server_id":"b","cpu_pct":1.5}'
    assert {t: len(v) for t, v in topics.items()} == {
        "topic-cpu": 6,
        "topic-mem": 5,
        "topic-net": 4,
        "topic-disk": 3,
    }
    assert topics["topic-disk"][1] == '{"ts":"2025-10-20 10:00:03","server_id":"","disk_io":"NaN"}'


def test_fan_out_of_a_dataset_without_a_column(spark):
    frame = spark.createDataFrame([("10:00:00", "a", "1", "2")], "ts string, server_id string, cpu_pct string, mem_pct string")
    assert sorted(sent(fan_out(frame))) == ["topic-cpu", "topic-mem"]
    assert fan_out(frame.drop("server_id")).count() == 0


def test_topic_files_round_trip(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text(DATASET)
    root = str(tmp_path / "topics")
    sinks.write_topic_files(fan_out(tables.read_dataset_csv(spark, str(path))), root)
    for family, count in (("cpu", 6), ("net", 4)):
        values = records.read_record_files(spark, records.topic_directory(root, f"topic-{family}"))
        decoded = decode_family(values, family)
        assert decoded.columns == ["ts", "server_id", *FAMILY_METRICS[family]]
        assert decoded.where(F.col("ts").isNotNull()).count() == count


def test_split_is_written_in_one_pass(spark, tmp_path):
    values = spark.createDataFrame([('{"ts":"2025-10-20 10:00:00","server_id":"s","cpu_pct":1}',), ("x",)], "value string")
    path = str(tmp_path / "split")
    sinks.write_split(flag_problems(with_second(decode_family(values, "cpu"), "lenient")), path)
    assert spark.read.parquet(f"{path}/problem=none").count() == 1
    assert spark.read.parquet(f"{path}/problem=undecodable").count() == 1


def test_report_by_date_prunes(spark, tmp_path):
    path = str(tmp_path / "report")
    report = spark.range(200).selectExpr(
        "concat('s', id % 3) server_id", "timestamp_seconds(1704150000 + id * 1000) window_start", "if(id % 4 = 0, 'x', '') alert"
    )
    assert sinks.write_report_by_date(report, path) == {"total_rows": 200, "alert_rows": 50}
    back = spark.read.parquet(path)
    assert rows(back.select(report.columns)) == rows(report)
    one = back.where("date = date'2024-01-03'")
    assert one.count() == report.where("to_date(window_start) = '2024-01-03'").count()
    assert "PartitionFilters: [isnotnull(date" in one._jdf.queryExecution().executedPlan().toString()


def test_job_folder_is_below_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = storage.job_folder(spark, "x"), storage.job_folder(spark, "x")
    assert one != two and one.startswith(shared) and two.startswith(shared)


def test_topic_positions(spark):
    most = 2**31 - 1, 2**63 - 1
    frame = spark.createDataFrame([(0, 5), (3, 5), (1, 4), (65536, 1 << 47), most], "p int, o bigint")
    at = [int(r[0]) for r in frame.select(records.ingest_position(F.col("p"), F.col("o"))).collect()]
    assert at[2] < at[0] < at[1] < at[3] < at[4] == most[1] * 2**32 + most[0]


class FakeSession:
    """A cluster session that names no shared folder."""

    class conf:
        @staticmethod
        def get(name, default):
            return default

    class sparkContext:
        master = "yarn"


def test_a_cluster_without_shared_folder_is_refused():
    with pytest.raises(ValueError):
        storage.job_folder(FakeSession, "x")


@pytest.mark.parametrize("call", [
    lambda spark: records.read_topic(spark, "host:9092", "topic-cpu", min_partitions=8),
    lambda spark: records.stream_topic(spark, "host:9092", "topic-cpu", max_records=10),
])
def test_topics_need_the_connector(spark, call):
    with pytest.raises(Exception, match="kafka"):
        call(spark)


def test_csv_gives_back_what_it_took(spark, tmp_path):
    names = ['a"b', 'q"x,y', "back\\slash", '"q"', "  lead", "trail  ", "tab\t", "\\", '\\"', ",", "é"]
    frame = spark.createDataFrame([("t", n, float(i)) for i, n in enumerate(names)], "ts string, server_id string, cpu_pct float")
    sinks.write_csv(frame, str(tmp_path / "odd"))
    assert rows(tables.read_snapshot_csv(spark, str(tmp_path / "odd"), "cpu")) == rows(frame)
    with pytest.raises(Exception, match="line break"):
        sinks.write_csv(frame.withColumn("server_id", F.lit("two\nlines")), str(tmp_path / "bad"))


def test_snapshot_by_date_is_pruned(spark, tmp_path):
    frame = spark.createDataFrame(
        [(f"2024-01-0{d} 23:59:5{s}", "s", float(s)) for d in (1, 2, 3) for s in range(5)], "ts string, server_id string, cpu_pct float"
    )
    path = str(tmp_path / "cpu")
    sinks.write_snapshot_by_date(frame.withColumn("ts_sec", F.unix_timestamp("ts")), path)
    assert rows(tables.read_snapshot_parquet(spark, path, "cpu")) == rows(frame)
    day = tables.read_snapshot_parquet(spark, path, "cpu", Days.between("2024-01-02", "2024-01-02"))
    assert rows(day) == rows(frame.where("ts LIKE '2024-01-02%'"))
    assert "PartitionFilters: [isnotnull(date" in day._jdf.queryExecution().executedPlan().toString()


def test_run_folder_is_removed(spark):
    folder = storage.job_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    storage.remove_folder(spark, folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_rows_csv_can_not_hold_are_set_aside(spark, tmp_path):
    values = [("a", 1.0), ("two\nlines", 2.0), (None, 3.0), ("carriage\rreturn", 4.0)]
    frame = spark.createDataFrame(values, "server_id string, x double")
    assert sinks.write_csv(frame, str(tmp_path / "out"), str(tmp_path / "aside")) == 2
    assert rows(spark.read.parquet(str(tmp_path / "aside"))) == [values[3], values[1]]
    assert rows(tables.read_csv(spark, str(tmp_path / "out"), frame.schema)) == [values[2], values[0]]
    assert sinks.write_csv(frame.where("x = 1"), str(tmp_path / "clean"), str(tmp_path / "none")) == 0
    assert not (tmp_path / "none").exists()
    numbers = spark.range(3)
    assert sinks.write_csv(numbers, str(tmp_path / "numbers"), str(tmp_path / "none")) == 0
