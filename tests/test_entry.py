"""Every registered query against its SQL on the smallest tables, and known counts."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as contract
from vigil.workload.oracle import ORACLE
from vigil.workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        connection.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def table(columns, values):
    """Rows as tuples in order of column name, sorted."""
    at = [columns.index(c) for c in sorted(columns)]
    clean = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted(
        (tuple(clean(row[i]) for i in at) for row in values),
        key=lambda row: tuple((v is not None, v if v is not None else 0) for v in row),
    )


TYPES = {"bigint": "BIGINT", "float": "FLOAT", "double": "DOUBLE", "string": "VARCHAR"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema} == dict(
        zip(expected.columns, map(str, expected.types))
    )
    found = table(frame.columns, frame.collect())
    assert found == table(expected.columns, expected.fetchall())
    assert found


def test_contract(spark):
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.items() <= contract.queries().items()
    assert contract.oracle_sql().keys() <= contract.queries().keys()
    assert contract.entry(spark).count() == 250


@pytest.mark.parametrize(
    "name,counts",
    [
        ("cpu_mem_alerts", {"": 196, "High CPU + Memory stress": 3, "CPU spike suspected": 7, "Memory saturation suspected": 44}),
        ("net_disk_alerts", {"": 186, "Network flood + Disk thrash suspected": 6, "Possible DDoS": 26, "Disk thrash suspected": 32}),
    ],
)
def test_alert_counts(spark, name, counts):
    found = QUERIES[name](spark, SF_DIR).groupBy("alert").count().collect()
    assert {r.alert: r["count"] for r in found} == counts


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "stream_cpu_mem_alerts"])
def test_plans_stay_in_the_jvm_and_prune_columns(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan
    for scan in (line for line in plan.splitlines() if "events.parquet" in line):
        read = scan.split("ReadSchema:")[1]
        assert read.count(":") <= 4, read


@pytest.mark.parametrize("missing", ["tiktoken", "zstandard", "vigil.llm", "public_tokenizers"])
def test_queries_without_a_package(missing):
    """Packages only some queries need may be absent."""
    program = (
        "import sys; sys.modules[sys.argv[1]] = None; import __spark_entry__ as e;"
        "assert e.oracle_sql().keys() <= e.queries().keys(); print(len(e.queries()))"
    )
    root = os.path.dirname(contract.__file__)
    found = subprocess.run([sys.executable, "-c", program, missing], cwd=root, capture_output=True, text=True, check=True)
    assert int(found.stdout) >= len(QUERIES)  # nor do those that can do without it
