import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.operators.decode import decode_records, flag_problems, good_rows, round_metrics, with_second
from vigil.plans.snapshots import decode_family, quarantine, raw_snapshot
from vigil.schemas import family_schema


def decoded(spark, values):
    records = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    frame = decode_records(records, family_schema("cpu"), carry=["i"])
    return [tuple(r)[:3] for r in frame.orderBy("i").collect()]


def test_plain_and_odd_records(spark):
    values = [
        '{"ts":"a","server_id":"s","cpu_pct":1.5}',
        '{"ts":"a","server_id":"s","cpu_pct":"x"}',
        '{"ts":"a","server_id":"s","cpu_pct":"1.5"}',
        '{"ts":"a"}',
        '{"ts":1,"server_id":5,"cpu_pct":3,"extra":[1]}',
    ]
    assert decoded(spark, values) == [
        ("a", "s", 1.5),
        ("a", "s", None),
        ("a", "s", None),
        ("a", None, None),
        ("1", "5", 3.0),
    ]


def test_malformed_records_become_nulls(spark):
    assert decoded(spark, ["garbage", "", None, '[{"ts":"a"}]', '{"ts":"a"']) == [(None, None, None)] * 5


@pytest.mark.parametrize("text", ["NaN", '"NaN"'])
def test_not_a_number(spark, text):
    assert math.isnan(decoded(spark, ['{"ts":"a","server_id":"s","cpu_pct":%s}' % text])[0][2])


@pytest.mark.parametrize("text", ["Infinity", '"Infinity"'])
def test_infinity(spark, text):
    assert decoded(spark, ['{"ts":"a","server_id":"s","cpu_pct":%s}' % text])[0][2] == math.inf


def test_binary_values_decode(spark):
    records = spark.createDataFrame([(bytearray(b'{"ts":"\xc3\xa9","server_id":"s"}'),)], "value binary")
    assert decode_records(records, family_schema("cpu")).first().ts == "é"


def test_metrics_round_and_stay_float(spark):
    frame = round_metrics(spark.sql("select 1.239f m, 2.005f n"), ["m", "n"])
    assert [f.dataType.simpleString() for f in frame.schema] == ["float", "float"]
    assert [round(v, 4) for v in frame.first()] == [1.24, 2.01]


RECORDS = [
    '{"ts":"2025-10-20 10:00:00","server_id":"s","cpu_pct":1.239}',
    '{"ts":"2025-10-20 10:00:00","server_id":"s","cpu_pct":5}',
    '{"ts":"2025-10-20 10:00:00.5","server_id":"s","cpu_pct":2}',
    "garbage",
    "more garbage",
    '{"ts":"2025-10-20 10:00:00","cpu_pct":2}',
    '{"ts":"soon","server_id":"a","cpu_pct":2}',
]


@pytest.fixture
def cpu(spark):
    records = spark.createDataFrame([(i, v) for i, v in enumerate(RECORDS)], "offset bigint, value string")
    return decode_family(records, "cpu", ["offset"])


def test_snapshot_keeps_first_per_text_and_sorts(cpu):
    snapshot = raw_snapshot(cpu, "cpu", ["offset"])
    assert snapshot.columns == ["ts", "server_id", "cpu_pct"]
    assert [(r.server_id, r.ts, round(r.cpu_pct, 2)) for r in snapshot.collect()] == [
        ("a", "soon", 2.0),
        ("s", "2025-10-20 10:00:00", 1.24),
        ("s", "2025-10-20 10:00:00.5", 2.0),
    ]


def test_snapshot_can_keep_undecodable_rows_once(cpu):
    snapshot = raw_snapshot(cpu, "cpu", ["offset"], keep_undecodable=True).collect()
    assert len(snapshot) == 5
    assert tuple(snapshot[0]) == (None, None, None)


def test_bad_rows_are_told_apart(cpu):
    bad = quarantine(cpu, "lenient").groupBy("problem").count()
    assert rows(bad) == [("bad timestamp", 1), ("no server", 1), ("undecodable", 2)]
    assert quarantine(cpu, "strict").where("problem = 'bad timestamp'").count() == 2


def test_good_and_bad_rows_are_all_rows(cpu):
    flagged = flag_problems(with_second(cpu, "lenient"))
    assert good_rows(flagged).count() + quarantine(cpu, "lenient").count() == len(RECORDS)


def test_each_record_is_parsed_once(spark, cpu):
    """Filters on decoded fields must not be pushed into the decoding."""
    plan = cpu.where(F.col("server_id").isNotNull() & F.col("ts").isNotNull())
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1
