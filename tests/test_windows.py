import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from vigil.config import SlidingWindow
from vigil.operators import windows
from vigil.operators.windows import assign_windows, mean_and_max, origin

CONFIGS = [
    (30, 10, 0), (30, 10, 3), (30, 10, 11), (25, 10, 0), (25, 10, 4), (7, 3, 1), (10, 10, 0), (10, 10, 7),
    (1, 1, 0), (60, 7, 5), (10, 30, 0), (10, 30, 4), (1, 5, 2), (4, 5, 0),
]


def brute_force(samples, size, slide, offset, clamp):
    """Windows by trying every start in reach of every sample."""
    if not samples:
        return []
    first = min(t for _, t, _ in samples) // slide * slide
    bound = (first - offset) // slide * slide + offset
    members = {}
    for server, t, value in samples:
        for start in range(t - size + 1, t + 1):
            if (start - offset) % slide == 0 and not (clamp and start < bound):
                members.setdefault((server, start), []).append(value)
    return sorted(
        (server, start, start + size, len(v), max(v)) for (server, start), v in members.items()
    )


def random_samples(seed, first, span):
    rng = random.Random(seed)
    keys = {(f"s{rng.randrange(3)}", first + rng.randrange(span)) for _ in range(300)}
    return [(s, t, float(rng.randrange(100))) for s, t in sorted(keys)]


def frame_of(spark, samples):
    return spark.createDataFrame(samples, "server_id string, ts_sec bigint, x float")


def aggregate_windows(frame, window, *columns):
    result = windows.aggregate_windows(frame, window, ["x"])
    return result.select("server_id", "window_start", "window_end", *(columns or ("x_count", "x_max")))


@pytest.mark.parametrize("size,slide,offset", CONFIGS)
def test_windows_equal_brute_force(spark, size, slide, offset):
    for seed, first in ((size + slide, 1704150000), (offset, -173)):
        samples = random_samples(seed, first, 700)
        for clamp in (True, False):
            window = SlidingWindow(size, slide, offset, clamp=clamp, block=50)
            result = aggregate_windows(frame_of(spark, samples), window)
            assert rows(result) == brute_force(samples, size, slide, offset, clamp), (seed, clamp)


@pytest.mark.parametrize("block", [1, 250, 333, 3600])
def test_block_length_does_not_matter(spark, block):
    samples = random_samples(block, 1704150000, 1500)
    result = aggregate_windows(frame_of(spark, samples), SlidingWindow(block=block))
    assert rows(result) == brute_force(samples, 30, 10, 0, True)


def test_few_samples_go_to_two_blocks(spark):
    frame = spark.range(86400).selectExpr("'s' server_id", "1704150000 + id ts_sec", "0f x")
    for window in (SlidingWindow(), SlidingWindow(size=7200, slide=600)):
        assert windows.spread_blocks(frame, window).count() <= 86400 * 9 / 8 + window.size
    assert windows.spread_blocks(frame, SlidingWindow()).groupBy("block").count().agg({"count": "max"}).first()[0] == 3629


def test_samples_without_a_second_are_in_no_window(spark):
    frame = spark.createDataFrame([("s", None, 1.0), ("s", 5, 1.0)], "server_id string, ts_sec bigint, x float")
    assert {r.ts_sec for r in assign_windows(frame, SlidingWindow()).collect()} == {5}


@pytest.mark.parametrize("size,slide,offset", [c for c in CONFIGS if c[1] <= c[0]])
def test_same_windows_as_the_built_in(spark, size, slide, offset):
    frame = frame_of(spark, random_samples(size, 1704150000, 200))
    span = F.window(F.timestamp_seconds("ts_sec"), f"{size} seconds", f"{slide} seconds", f"{offset % slide} seconds")
    builtin = frame.select("server_id", "ts_sec", F.unix_seconds(span["start"]).alias("s"))
    ours = assign_windows(frame, SlidingWindow(size, slide, offset)).select("server_id", "ts_sec", "window_start")
    assert rows(ours) == rows(builtin)


def test_worked_example_and_clamp(spark):
    ten = 1760954400
    frame = frame_of(spark, [("s", ten + 5, 1.0), ("s", ten + 15, 2.0)])
    result = aggregate_windows(frame, SlidingWindow(), *mean_and_max("x", "x"))
    assert rows(result) == [("s", ten, ten + 30, 1.5, 2.0), ("s", ten + 10, ten + 40, 2.0, 2.0)]
    free = aggregate_windows(frame, SlidingWindow(clamp=False), *mean_and_max("x", "x"))
    assert rows(free)[:2] == [("s", ten - 20, ten + 10, 1.0, 1.0), ("s", ten - 10, ten + 20, 1.5, 2.0)]


def test_clamp_is_by_the_first_sample_of_all_servers(spark):
    frame = frame_of(spark, [("a", 1000, 1.0), ("b", 1100, 1.0)])
    starts = {(r.server_id, r.window_start) for r in aggregate_windows(frame, SlidingWindow()).collect()}
    assert starts == {("a", 1000), ("b", 1080), ("b", 1090), ("b", 1100)}


def test_known_origin(spark):
    samples = random_samples(5, 1704150000, 100)
    window = SlidingWindow(origin=min(t for _, t, _ in samples))
    assert rows(aggregate_windows(frame_of(spark, samples), window)) == brute_force(samples, 30, 10, 0, True)


def test_no_samples_no_windows(spark):
    empty = frame_of(spark, [])
    assert aggregate_windows(empty, SlidingWindow()).count() == 0
    assert [tuple(r) for r in origin(empty).collect()] == [(None,)]


def test_nan_is_the_maximum(spark):
    frame = frame_of(spark, [("s", 0, 1.0), ("s", 1, float("nan")), ("s", 2, None)])
    row = aggregate_windows(frame, SlidingWindow(), *mean_and_max("x", "x")).first()
    assert row.max_x != row.max_x and row.avg_x != row.avg_x


def test_bad_settings_are_refused():
    for bad in ({"size": 0}, {"slide": 0}, {"block": -1}):
        with pytest.raises(ValueError):
            SlidingWindow(**bad)
