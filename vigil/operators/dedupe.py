"""One row per key, chosen the same way on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vigil.functions.numbers import HIGHEST_RANK, float_rank

#: More than any place a float can have below.
_PLACES = 10**10


def _place(value: str) -> Column:
    """Place of a float from the largest (NaN) on, nulls last, as decimal(10,0)."""
    return F.coalesce(F.lit(HIGHEST_RANK) - float_rank(F.col(value)), F.lit(2 * HIGHEST_RANK + 1)).cast("decimal(10,0)")


def value_position(values: list[str]) -> Column:
    """A number that is smaller the larger the values are, by the first, then the second; nulls last.

    For up to two metrics, any 32-bit floats: NaN counts as the largest, then
    infinity. Doubles count as their nearest floats; a hash of the row decides
    between those that are the same then, so the choice is the same on every run.
    """
    if len(values) > 2:
        raise ValueError("up to two values")
    position = F.lit(0).cast("decimal(1,0)")
    for v in values:
        position = (position * F.lit(_PLACES).cast("decimal(11,0)") + _place(v)).cast("decimal(20,0)")
    tie = F.pmod(F.xxhash64(*values), F.lit(_PLACES)).cast("decimal(10,0)")
    return (position * F.lit(_PLACES).cast("decimal(11,0)") + tie).cast("decimal(38,0)")


def sample_position(microsecond: Column, value: str) -> Column:
    """Place of a sample among those of its second: the earlier first, of equal ones the larger value."""
    return (microsecond.cast("decimal(20,0)") * F.lit(_PLACES).cast("decimal(11,0)") + _place(value)).cast("decimal(38,0)")


def first_values(values: list[str], order: list[str] | None, present: Column | None = None) -> list[Column]:
    """Aggregates giving ``values`` of the first row, among the rows that are ``present``.

    First is the lowest ``order``: the ingest position, not null and unique
    within a group. Without it, it is the row with the largest values, nulls
    last: of samples that nothing else tells apart, a monitor keeps the peak.
    One fixed-width order column, or up to two values without order, keeps the
    aggregate a hash aggregate.
    """

    def among(column: Column) -> Column:
        return column if present is None else F.when(present, column)

    order = order or []
    if len(order) == 1:
        return [F.min_by(v, among(F.col(order[0]))).alias(v) for v in values]
    if not order and len(values) == 1:
        return [F.max(among(F.col(v))).alias(v) for v in values]
    if not order and len(values) == 2:
        return [F.min_by(v, among(value_position(values))).alias(v) for v in values]
    position = [F.col(o) for o in order]
    for v in values:
        position += [F.col(v).isNull(), F.col(v)]
    first = F.min(among(F.struct(*(p.alias(f"p{i}") for i, p in enumerate(position)))))
    return [first[f"p{len(order) + 2 * i + 1}"].alias(v) for i, v in enumerate(values)]


def first_per_key(rows: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """The first row of each key (see ``first_values``), without the order columns.

    Null keys count as equal. This is a plain aggregate, so copies of a hot key
    are combined before the shuffle.
    """
    values = [c for c in rows.columns if c not in keys and c not in (order or [])]
    if not values:
        return rows.select(*keys).distinct()
    return rows.groupBy(*keys).agg(*first_values(values, order)).select(*keys, *values)
