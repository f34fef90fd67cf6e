"""Versions of thresholds."""

import pytest
from conftest import rows

from vigil.config import CPU_MEM
from vigil.fixed_values import CPU_MEM_ALERTS, MISSING_THRESHOLD
from vigil.operators.report import with_alert
from vigil.plans.reports import report
from vigil.sources.thresholds import read_threshold_versions

BOTH, LEFT, RIGHT = CPU_MEM_ALERTS


def store(folder, versions):
    for since, text in versions.items():
        (folder / f"valid_from={since}").mkdir(parents=True)
        (folder / f"valid_from={since}" / "limits.txt").write_text(text)
    return str(folder)


def windows(spark, ends):
    return spark.createDataFrame([("s", e - 30, e, 50.0, 50.0) for e in ends], "server_id string, window_start long, window_end long, avg_cpu double, avg_mem double")


def test_versions_by_window_end(spark, tmp_path):
    root = store(tmp_path / "limits", {100: "cpu_threshold: 40\nmem_threshold: 60", 200: "cpu_threshold: 60\r\nmem_threshold: 40\n", 300: "# none\n"})
    versions = read_threshold_versions(spark, root)
    assert [r[:3] for r in rows(versions.select("valid_from", "cpu_threshold", "mem_threshold"))] == [
        (100, 40.0, 60.0), (200, 60.0, 40.0), (300, MISSING_THRESHOLD, MISSING_THRESHOLD)
    ]
    judged = with_alert(windows(spark, [99, 100, 199, 200, 299, 300, 9000]), CPU_MEM, versions)
    assert [r.alert for r in judged.orderBy("window_end").collect()] == ["", LEFT, LEFT, RIGHT, RIGHT, "", ""]
    assert judged.columns == ["server_id", "window_start", "window_end", "avg_cpu", "avg_mem", "alert"]
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_no_version_and_missing_names(spark, tmp_path):
    none = spark.createDataFrame([], "valid_from long, cpu_threshold double, mem_threshold double")
    assert [r.alert for r in with_alert(windows(spark, [5]), CPU_MEM, none).collect()] == [""]
    partly = spark.createDataFrame([(0, 1.0)], "valid_from long, cpu_threshold double")
    assert [r.alert for r in with_alert(windows(spark, [5]), CPU_MEM, partly).collect()] == [LEFT]


def test_a_bad_line_fails_its_version(spark, tmp_path):
    root = store(tmp_path / "limits", {1: "cpu_threshold: 1", 2: "cpu_threshold: high"})
    with pytest.raises(Exception, match="bad threshold line"):
        read_threshold_versions(spark, root).collect()


def test_reports_by_version(spark):
    samples = spark.createDataFrame([("s", second, 50.0, 50.0) for second in range(0, 86460, 7)], "server_id string, ts_sec long, cpu_pct float, mem_pct float")
    sides = samples.drop("mem_pct"), samples.drop("cpu_pct")
    versions = spark.createDataFrame([(0, 40.0, 60.0), (86400, 40.0, 40.0)], "valid_from long, cpu_threshold double, mem_threshold double")
    whole = report(*sides, CPU_MEM, thresholds=versions).collect()
    assert {r.alert for r in whole if r.window_end.timestamp() < 86400} == {LEFT}
    assert {r.alert for r in whole if r.window_end.timestamp() >= 86400} == {BOTH}
    labels = {r.window_start: r.alert for r in report(*sides, CPU_MEM, thresholds=versions, labels="time_of_day").collect()}
    assert labels["00:00:00"] == LEFT and labels["23:59:50"] == BOTH
