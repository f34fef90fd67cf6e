"""Joining two metric families on server and second.

``join_families`` is the plain join, for families without repeats. The merges
take raw samples: both families go through one aggregate on the join key, which
drops repeats and joins in a single shuffle, without sorting either side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.operators.dedupe import first_values

KEYS = ["server_id", "ts_sec"]
LEFT, RIGHT = 1, 2


def join_families(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join of families that hold at most one row per (server, second).

    Rows with a null key drop out.
    """
    return left.join(right, KEYS, "inner")


def both_sides(left: DataFrame, right: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Rows of both sides, told apart by ``side``, without null keys."""
    sides = [
        rows.dropna(subset=keys).withColumn("side", F.lit(side).cast("tinyint"))
        for rows, side in ((left, LEFT), (right, RIGHT))
    ]
    return sides[0].unionByName(sides[1], allowMissingColumns=True)


def _metrics(rows: DataFrame, order: list[str] | None = None) -> list[str]:
    return [c for c in rows.columns if c not in KEYS and c not in (order or [])]


def first_of_sides(
    rows: DataFrame, keys: list[str], left: list[str], right: list[str], order: list[str] | None = None
) -> DataFrame:
    """The first sample of either side per key that both have, of rows as ``both_sides`` gives them."""
    side = F.col("side")
    return (
        rows.groupBy(*keys)
        .agg(
            *first_values(left, order, side == LEFT),
            *first_values(right, order, side == RIGHT),
            F.bit_or("side").alias("sides"),
        )
        .where(F.col("sides") == LEFT | RIGHT)
        .select(*keys, *left, *right)
    )


def merge_first(left: DataFrame, right: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Inner join of each side's first sample per (server, second).

    ``order`` is as in ``first_values``; both sides have its columns.
    """
    return first_of_sides(both_sides(left, right), KEYS, _metrics(left, order), _metrics(right, order), order)


def merge_copies(left: DataFrame, right: DataFrame, exact: bool = False) -> DataFrame:
    """Sums, counts and maxima over all pairs of repeated samples, without making them; sums as ``sums_of`` has them.

    A key held n times on the left and m times on the right joins into n*m
    pairs, in which each left sample occurs m times and each right sample n
    times. So a side's sums and counts are those of its own rows times the
    other side's copies, its maximum stays, and each key needs one row.
    """
    l, r = _metrics(left), _metrics(right)
    copies = {side: F.count_if(F.col("side") == side).alias(f"copies_{side}") for side in (LEFT, RIGHT)}
    merged = (
        both_sides(left, right)
        .groupBy(*KEYS)
        .agg(*copies.values(), *(part for m in l + r for part in sums_of(m, exact)))
        .where((F.col("copies_1") > 0) & (F.col("copies_2") > 0))
    )
    columns = [*KEYS, (F.col("copies_1") * F.col("copies_2")).alias("pairs")]
    for metrics, other in ((l, "copies_2"), (r, "copies_1")):
        for m in metrics:
            columns += exact_sums(m, F.col(other)) if exact else [(F.col(f"{m}_sum") * F.col(other)).alias(f"{m}_sum")]
            columns += [(F.col(f"{m}_count") * F.col(other)).alias(f"{m}_count"), F.col(f"{m}_max")]
    return merged.select(*columns)


#: Steps of one in exact sums. Floats of two decimal places are whole numbers of them.
EXACT_STEPS = 2.0**30
#: Values below are summed exactly.
EXACT_BELOW = 2.0**25
#: Low bits of a number of steps, summed apart from the others: neither sum leaves a long before 2**32 rows of a key.
_LOW_BITS = 24
#: A key's sum of up to this many steps stays a long, of which 2**17 can be added up; a larger one is a decimal.
_SMALL_SUM = 2.0**46
SMALL_SUMS = 1 << 16


def sums_of(metric: str, exact: bool = False) -> list[Column]:
    """Sum, count and maximum of a metric; averages are finished from them later.

    A sum of doubles depends on the order of its terms once it has more than 53
    bits. With ``exact`` it is a whole number of steps, the same in any order, in
    two parts for ``exact_sums``: <metric>_high and _low. Values of EXACT_BELOW
    and more, and those that are no numbers, are summed as doubles beside it, in
    <metric>_rest.
    """
    value = F.col(metric).cast("double")
    others = [F.count(metric).alias(f"{metric}_count"), F.max(metric).alias(f"{metric}_max")]
    if not exact:
        return [F.sum(value).alias(f"{metric}_sum"), *others]
    small = F.abs(value) < EXACT_BELOW
    steps = F.when(small, value * EXACT_STEPS).cast("bigint")
    return [
        F.sum(F.shiftright(steps, _LOW_BITS)).alias(f"{metric}_high"),
        F.sum(steps.bitwiseAND((1 << _LOW_BITS) - 1)).alias(f"{metric}_low"),
        *others,
        F.sum(F.when(~small, value)).alias(f"{metric}_rest"),
    ]


def exact_sums(metric: str, times: Column) -> list[Column]:
    """A key's exact sum so many times: <metric>_sum, a long, or if that is too small, <metric>_big, a decimal; and _rest.

    Decimals are slow to add up, and only keys with very many copies need them.
    """
    high, low = F.col(f"{metric}_high"), F.col(f"{metric}_low")
    is_small = F.abs((high.cast("double") * 2.0**_LOW_BITS + low) * times) < _SMALL_SUM
    whole = high.cast("decimal(19,0)") * F.lit(1 << _LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(19,0)")
    return [
        F.when(is_small, (high * (1 << _LOW_BITS) + low) * times).alias(f"{metric}_sum"),
        F.when(~is_small, whole.cast("decimal(38,0)") * times.cast("decimal(19,0)")).alias(f"{metric}_big"),
        (F.col(f"{metric}_rest") * times).alias(f"{metric}_rest"),
    ]


def exact_total(metric: str) -> Column:
    """The exact sum with what was summed beside it, as a double."""
    zero = F.lit(0).cast("decimal(38,0)")
    steps = F.coalesce(F.col(f"{metric}_sum").cast("decimal(38,0)"), zero) + F.coalesce(f"{metric}_big", zero)
    return steps.cast("double") / EXACT_STEPS + F.coalesce(f"{metric}_rest", F.lit(0.0))
