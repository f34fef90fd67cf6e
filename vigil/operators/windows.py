"""Sliding windows over joined samples.

Grouping by (server, window) straight away would shuffle every sample once per
window it lies in. Here each sample goes to the block of window starts it can
belong to, one shuffle of about one copy per sample (two only within a window
length of a block edge), and is spread over its windows after that shuffle.
A (server, block) group is bounded: with one row per second it holds at most
block_span + size rows, however busy the server.

Within a block, samples are first summed up by pane, the longest step that
divides both window and slide, so that overlapping windows add up panes instead
of going through each sample again.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, Window, functions as F

from vigil.config import SlidingWindow
from vigil.operators.join import SMALL_SUMS, exact_total, sums_of


def _step_down(second: Column, step: int, offset: int = 0) -> Column:
    """Largest ``offset + n*step`` not above ``second``, in whole numbers."""
    return second - F.pmod(second - F.lit(offset), F.lit(step))


def assign_windows(samples: DataFrame, window: SlidingWindow) -> DataFrame:
    """One row per sample and window [start, start + size) holding it.

    Adds window_start and window_end. Samples between windows, as there are
    when the slide is longer than the window, drop out.
    """
    second = F.col("ts_sec")
    last = _step_down(second, window.slide, window.offset)
    reach = (window.size - 1) // window.slide * window.slide
    starts = F.sequence(last - F.lit(reach), last, F.lit(window.slide))
    assigned = samples.withColumn("window_start", F.explode(starts)).withColumn(
        "window_end", F.col("window_start") + F.lit(window.size)
    )
    if window.size % window.slide:
        assigned = assigned.where(F.col("window_end") > second)
    return assigned


def spread_blocks(samples: DataFrame, window: SlidingWindow) -> DataFrame:
    """Shuffle samples to the blocks of window starts they can belong to."""
    second = F.col("ts_sec")
    blocks = F.sequence(
        _step_down(second - F.lit(window.size - 1), window.block_span),
        _step_down(second, window.block_span),
        F.lit(window.block_span),
    )
    return samples.withColumn("block", F.explode(blocks)).repartition("server_id", "block")


def origin(samples: DataFrame) -> DataFrame:
    """One row with ``ts_sec``, the second of the first sample; null if there is none.

    The minimum is taken over whole rows led by their second. That needs every
    column, so this branch reads the same shuffle as the aggregate next to it;
    a minimum of the second alone would be pruned into a second run of the join.
    """
    rest = [c for c in samples.columns if c != "ts_sec"]
    return samples.agg(F.min(F.struct("ts_sec", *rest)).alias("earliest")).select("earliest.ts_sec")


def clamp_bound(samples: DataFrame, window: SlidingWindow) -> Column | None:
    """Earliest window start to keep: a scalar subquery unless the origin is configured."""
    if not window.clamp:
        return None
    if window.origin is not None:
        return first_start(F.lit(window.origin), window)
    return origin(samples).select(first_start(F.col("ts_sec"), window)).scalar()


def first_start(second: Column, window: SlidingWindow) -> Column:
    """Bound for a first sample at ``second``: its slide step, moved down to a window start."""
    return _step_down(_step_down(second, window.slide), window.slide, window.offset)


def first_start_of(second: int, window: SlidingWindow) -> int:
    """``first_start`` of a known second."""
    start = second // window.slide * window.slide
    return start - (start - window.offset) % window.slide


def number_ranges(spread: DataFrame, n: int) -> DataFrame:
    """(server_id, block, range): blocks in order of server and time, cut into ``n`` ranges of about equal samples.

    Counts come from the shuffle the windows are made of: as in ``origin`` they
    need every column, or it would be pruned into a second run of the join. Of
    them one row per server goes through one task, to add up what lies before
    each server.
    """
    row = F.nullif(F.xxhash64(*spread.columns), F.lit(0).cast("bigint"))  # any row, but for one hash in 2**64
    # the joins ask for a server; asked for here, too, each branch has the same shuffle
    counts = spread.where("server_id IS NOT NULL").groupBy("server_id", "block").agg(F.count(row).alias("samples"))
    by_name = Window.orderBy("server_id")
    servers = counts.groupBy("server_id").agg(F.sum("samples").alias("of_server"))
    servers = servers.select(
        "server_id",
        (F.sum("of_server").over(by_name) - F.col("of_server")).alias("before"),
        F.sum("of_server").over(Window.partitionBy()).alias("all"),
    )
    in_server = Window.partitionBy("server_id").orderBy("block")
    placed = counts.withColumn("before_block", F.sum("samples").over(in_server) - F.col("samples"))
    place = F.floor((F.col("before") + F.col("before_block")) * F.lit(n) / F.col("all"))
    return placed.join(servers, "server_id").select("server_id", "block", place.cast("int").alias("range"))


def aggregate_windows(
    samples: DataFrame, window: SlidingWindow, metrics: list[str], summed: bool = False, ranges: int | None = None
) -> DataFrame:
    """Sum, count and maximum of each metric per server and window.

    ``samples`` has one row per server and second, with the metrics or, when
    ``summed``, with their sums, counts and maxima as ``merge_copies`` gives
    them. The result has server_id, window_start and window_end (epoch seconds)
    and <metric>_sum, _count and _max, with exact sums also _big and _rest. Both
    groupings follow the block shuffle and need no other. ``ranges`` adds the
    number of the window's range in the order of server and start (``number_ranges``).
    """
    exact = summed and f"{metrics[0]}_rest" in samples.columns
    names = [f"{m}_{part}" for m in metrics for part in ("sum", "count", "max", *(["big", "rest"] if exact else []))]
    if exact and window.size > SMALL_SUMS:  # too many longs to add up
        for m in metrics:
            samples = samples.withColumn(f"{m}_big", F.coalesce(f"{m}_big", F.col(f"{m}_sum").cast("decimal(38,0)")))
            samples = samples.withColumn(f"{m}_sum", F.lit(0).cast("bigint"))
    samples = samples.select("server_id", "ts_sec", *(names if summed else metrics))
    spread = spread_blocks(samples, window)
    rows = spread
    pane = gcd(window.size, window.slide)
    if pane > 1:
        start = _step_down(F.col("ts_sec"), pane, window.offset)
        rows = rows.groupBy("server_id", "block", start.alias("ts_sec")).agg(*_sums(metrics, summed, exact))
        summed = True
    windows = (
        assign_windows(rows, window)
        .where(_step_down(F.col("window_start"), window.block_span) == F.col("block"))
        .groupBy("server_id", "block", "window_start")
        .agg(*_sums(metrics, summed, exact))
    )
    bound = clamp_bound(spread, window)
    if bound is not None:
        windows = windows.where(F.col("window_start") >= bound)
    window_end = (F.col("window_start") + F.lit(window.size)).alias("window_end")
    if ranges is None:
        return windows.select("server_id", "window_start", window_end, *names)
    numbered = windows.join(number_ranges(spread, ranges), ["server_id", "block"])
    return numbered.select("server_id", "window_start", window_end, *names, "range")


def _sums(metrics: list[str], summed: bool, exact: bool) -> list[Column]:
    """Sums, counts and maxima of samples, or of such sums again."""
    if not summed:
        return [part for m in metrics for part in sums_of(m)]
    return combined_sums(metrics, exact)


def combined_sums(metrics: list[str], exact: bool = False) -> list[Column]:
    combine = {"sum": F.sum, "count": F.sum, "max": F.max} | ({"big": F.sum, "rest": F.sum} if exact else {})
    return [f(f"{m}_{part}").alias(f"{m}_{part}") for m in metrics for part, f in combine.items()]


def mean_and_max(metric: str, name: str, exact: bool = False) -> list[Column]:
    """Average rounded to two places, and maximum, of a summed-up metric."""
    mean = F.try_divide(exact_total(metric) if exact else F.col(f"{metric}_sum"), f"{metric}_count")
    return [F.round(mean, 2).alias(f"avg_{name}"), F.col(f"{metric}_max").alias(f"max_{name}")]
