from itertools import product

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from vigil.config import NET_DISK, SlidingWindow
from vigil.functions.numbers import float_rank
from vigil.operators.dedupe import first_per_key, value_position
from vigil.operators.join import KEYS, join_families, merge_copies, merge_first
from vigil.plans.reports import report, samples


def test_lowest_order_is_kept_whole(spark):
    frame = spark.createDataFrame(
        [("s", 1, 9.0, None, 7), ("s", 1, 1.0, 2.0, 8), ("s", 2, 3.0, 4.0, 9)],
        "server_id string, ts_sec bigint, a float, b float, pos bigint",
    )
    assert rows(first_per_key(frame, KEYS, ["pos"])) == [("s", 1, 9.0, None), ("s", 2, 3.0, 4.0)]


def test_order_of_two_columns(spark):
    frame = spark.createDataFrame(
        [("s", 1, 9.0, 1, 0), ("s", 1, 1.0, 0, 5), ("s", 1, 2.0, 0, 6)],
        "server_id string, ts_sec bigint, a float, partition int, offset bigint",
    )
    assert rows(first_per_key(frame, KEYS, ["partition", "offset"])) == [("s", 1, 1.0)]


def test_without_order_largest_values_nulls_last(spark):
    schema = "server_id string, ts_sec bigint, a float, b float"
    frame = spark.createDataFrame([("s", 1, None, 9.0), ("s", 1, 2.0, 5.0), ("s", 1, 2.0, None), ("s", 1, 1.0, 8.0)], schema)
    assert rows(first_per_key(frame, KEYS)) == [("s", 1, 2.0, 5.0)]
    assert rows(first_per_key(frame.select("server_id", "ts_sec", "a"), KEYS)) == [("s", 1, 2.0)]


def test_any_float_has_its_place(spark):
    values = [float("nan"), float("inf"), 3.4e38, 9e10, 2e10, 2.0**33, 1.5, 1e-40, 0.0, -1e-45, -1.5, -2e10, -3.4e38, float("-inf"), None]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, a float")
    ranked = frame.select("i", value_position(["a"]).alias("place"), float_rank(F.col("a")).alias("rank"))
    assert [r.i for r in ranked.orderBy("place").collect()] == list(range(len(values)))
    ranks = {r.i: r["rank"] for r in ranked.collect()}
    assert ranks[8] == 0 and ranks[9] == -1 and ranks[14] is None
    steps = spark.range(-140, 120).selectExpr("id", "CAST(pow(2.0, id) AS FLOAT) a")
    found = [r[0] for r in steps.select(float_rank(F.col("a"))).collect()]
    assert found == sorted(found) and len(set(found)) == 260
    for chosen, given in ((2e10, [2e10, 9.0]), (9e10, [2e10, 9e10, 5e10]), (float("inf"), [3e38, float("inf")])):
        two = spark.createDataFrame([("s", 1, g, 1.0) for g in given], "server_id string, ts_sec bigint, a float, b float")
        largest = max(given)
        assert first_per_key(two, KEYS).first().a == pytest.approx(largest, rel=1e-6) and chosen == largest


def test_exact_sums_in_any_order(spark):
    """Averages over very many pairs are equal to the bit, however rows are dealt out."""
    n = 20_000
    rows_ = spark.range(n).selectExpr("'s' server_id", "id % 3 ts_sec", "CAST(round((id * 7919) % 560000 / 100.0, 2) AS FLOAT) net_in")
    disk = spark.range(n).selectExpr("'s' server_id", "id % 3 ts_sec", "CAST(round((id * 104729) % 280000 / 100.0, 2) AS FLOAT) disk_io")
    results = set()
    for k in range(1, 21):
        merged = merge_copies(rows_.repartition(k, F.rand(k)), disk.repartition(21 - k, F.rand(k)), exact=True)
        results.add(tuple(tuple(r) for r in sorted(merged.collect())))
    assert len(results) == 1
    found = {r.ts_sec: r for r in merged.collect()}
    for s in range(3):
        net = [round(((i * 7919) % 560000) / 100, 2) for i in range(n) if i % 3 == s]
        other = len([i for i in range(n) if i % 3 == s])
        import numpy as np

        steps = sum(int(float(np.float32(v)) * 2**30) for v in net) * other
        assert int(found[s].net_in_big) == steps and found[s].net_in_sum is None and found[s].net_in_rest is None


def test_exact_sums_beside_odd_values(spark):
    odd = [1.25, float("inf"), None, 2.0**25]
    left = spark.createDataFrame([("s", 1, v) for v in odd], "server_id string, ts_sec bigint, a float")
    right = spark.createDataFrame([("s", 1, 1.0), ("s", 1, float("nan"))], "server_id string, ts_sec bigint, b float")
    row = merge_copies(left, right, exact=True).first()
    assert (row.a_sum, row.a_rest, row.a_count) == (int(1.25 * 2**30) * 2, float("inf"), 6)
    assert row.b_sum == 2**30 * 4 and row.b_rest != row.b_rest and row.a_big is None
    below = spark.createDataFrame([("s", 1, -1.5), ("s", 1, 0.25)], "server_id string, ts_sec bigint, a float")
    row = merge_copies(below, right, exact=True).first()
    assert row.a_sum == int(-1.25 * 2**30) * 2


def test_exact_averages_of_long_windows(spark):
    window = SlidingWindow(size=90_000, slide=90_000, clamp=False)
    sides = [
        spark.range(40_000).selectExpr("'s' server_id", "id ts_sec", f"CAST(id % 1000 AS FLOAT) {m}") for m in ("net_in", "disk_io")
    ]
    row = report(*sides, NET_DISK, window, labels="epoch").first()
    assert (row.avg_net_in, row.avg_disk_io) == (499.5, 499.5)


def test_null_keys_are_one_key(spark):
    frame = spark.createDataFrame([(None, None, 1.0), (None, None, 2.0), ("a", 1, 3.0)], "server_id string, ts_sec bigint, a float")
    assert rows(first_per_key(frame, KEYS)) == [(None, None, 2.0), ("a", 1, 3.0)]


def test_result_does_not_depend_on_partitioning(spark):
    frame = spark.range(2000).selectExpr(
        "concat('s', id % 3) server_id", "id % 50 ts_sec", "cast(hash(id) % 100 as float) a", "cast(hash(id, 1) % 100 as float) b", "id pos"
    )
    for order in (["pos"], None):
        kept = frame if order else frame.drop("pos")
        assert rows(first_per_key(kept.repartition(7), KEYS, order)) == rows(first_per_key(kept.coalesce(1), KEYS, order))


def test_partial_aggregate_before_the_shuffle(spark):
    frame = spark.range(10).selectExpr("'s' server_id", "id ts_sec", "cast(id as float) a", "cast(id as float) b", "id pos")
    plan = first_per_key(frame, KEYS, ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_two_values_without_order_are_not_sorted(spark):
    frame = spark.range(10).selectExpr("'s' server_id", "id ts_sec", "cast(id as float) a", "cast(id as float) b")
    plan = first_per_key(frame, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def test_large_values_without_order_are_chosen_alike(spark):
    frame = spark.range(3000).selectExpr(
        "'s' server_id", "id % 5 ts_sec", "cast(1e30 + (id % 7) * 1e29 as float) a", "cast(-1e30 * (id % 3) as float) b"
    )
    found = {tuple(rows(first_per_key(frame.repartition(n), KEYS))) for n in (1, 4, 9)}
    assert len(found) == 1


def test_join_needs_both_keys(spark):
    cpu = spark.createDataFrame([("s", 1, 1.0), ("s", 2, 2.0), (None, 3, 3.0), ("s", None, 4.0)], "server_id string, ts_sec bigint, a float")
    mem = spark.createDataFrame([("s", 1, 5.0), ("t", 2, 6.0), (None, 3, 7.0), ("s", None, 8.0)], "server_id string, ts_sec bigint, b float")
    for joined in (join_families(cpu, mem), merge_first(cpu, mem)):
        assert joined.columns == ["server_id", "ts_sec", "a", "b"]
        assert rows(joined) == [("s", 1, 1.0, 5.0)]


def test_merge_equals_dedupe_and_join(spark):
    base = spark.range(1500).selectExpr(
        "if(id % 97 = 0, null, concat('s', id % 3)) server_id", "id % 61 ts_sec",
        "if(id % 5 = 0, null, cast(hash(id) % 100 as float)) a", "cast(hash(id, 1) % 9 as float) b",
        "cast(hash(id, 2) % 100 as float) c", "id pos", "id % 4 part",
    )
    for order in (["pos"], ["part", "pos"], None):
        left = base.where("id % 7 < 4").select("server_id", "ts_sec", "a", "b", *(order or []))
        right = base.where("id % 7 > 2 and ts_sec > 9").select("server_id", "ts_sec", "c", *(order or []))
        expected = join_families(first_per_key(left, KEYS, order), first_per_key(right, KEYS, order))
        found = merge_first(left, right, order)
        assert found.columns == expected.columns
        assert rows(found) == rows(expected) and found.count() > 100


SIDE = st.lists(
    st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 2), st.one_of(st.none(), st.integers(-50, 50).map(float))), max_size=12
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(SIDE, SIDE)
def test_copies_equal_all_pairs(spark, left, right):
    l = spark.createDataFrame([(s, t, v) for s, t, v in left], "server_id string, ts_sec bigint, x float")
    r = spark.createDataFrame([(s, t, v) for s, t, v in right], "server_id string, ts_sec bigint, y float")
    pairs = {}
    for (s, t, x), (s2, t2, y) in product(left, right):
        if (s, t) == (s2, t2):
            pairs.setdefault((s, t), []).append((x, y))

    def stats(values):
        known = [v for v in values if v is not None]
        return (sum(known) if known else None, len(known), max(known) if known else None)

    expected = [
        (*key, len(found), *stats([x for x, _ in found]), *stats([y for _, y in found]))
        for key, found in sorted(pairs.items())
    ]
    assert rows(merge_copies(l, r)) == expected


def test_a_place_takes_few_steps(spark):
    """Text is parsed and a float ranked once a sample: not in each branch, and not in a filter below, too."""
    raw = spark.range(3).selectExpr("concat('2024-01-01 00:00:0', id) AS ts", "concat('s', id) AS server_id", "CAST(id AS FLOAT) AS cpu_pct")
    placed = samples(raw, "cpu_pct", "lenient").dropna(subset=["server_id", "ts_sec"])
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and plan.count("LOG2") <= 2
    assert [r.ts_sec for r in placed.orderBy("ts_sec").collect()] == [1704067200, 1704067201, 1704067202]
