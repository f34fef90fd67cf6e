"""Number text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Decimal text with optional sign, fraction, exponent and single underscores
# between digits, or infinity or not-a-number; blanks around it are ignored.
_DIGITS = r"\d+(_\d+)*"
_NUMBER = (
    rf"(?i)^\s*[+-]?(({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)\s*$"
)


def parse_number(text: Column) -> Column:
    """Double from number text, null where it is none.

    Java's own suffixes and hexadecimal notation (``1.5f``, ``0x1p3``) are
    refused, underscores between digits (``1_000``) and signed ``nan`` are read.
    """
    # Most text casts as it is; the rest is rewritten only where that fails.
    plain = F.regexp_replace(F.regexp_replace(text, r"[_\s]", ""), r"(?i)^[+-]nan$", "nan")
    number = F.coalesce(text.try_cast("double"), plain.try_cast("double"))
    return F.when(text.rlike(_NUMBER), number)


def round_metric(metric: str, scale: int = 2) -> Column:
    """Half-up rounding that keeps the column's type."""
    return F.round(F.col(metric), scale)


#: Floats from one power of two to the next, and the exponent of the smallest normal one.
_STEPS = 1 << 23
_LEAST_EXPONENT = -126
#: The power of two above all floats.
_BEYOND = 2.0**128
#: More than a logarithm is off by, less than lies between those of two floats.
_HAIR = 1e-9
#: What float_rank gives NaN, one more than infinity.
HIGHEST_RANK = 255 * _STEPS + 1


def float_rank(value: Column) -> Column:
    """A 32-bit float as a whole number that sorts as floats do, null for null.

    The number counts the floats from zero up to the value (down to it, below
    zero). Infinity is the last of them and NaN comes after it, as in sorting;
    both zeros are 0. A double is taken as its nearest float.
    """
    size = F.abs(value.cast("float").cast("double"))
    # infinity is what would follow the largest float; nulls stay
    size = F.when(size < _BEYOND, size).when(size.isNotNull(), F.lit(_BEYOND))
    # the logarithm may be off by a hair next to a power of two; zero has none
    exponent = F.greatest(F.floor(F.log2(size) + _HAIR), F.lit(_LEAST_EXPONENT).cast("bigint"))
    # no branches, so that each part is evaluated once
    steps = (size / F.pow(F.lit(2.0), exponent) * _STEPS).cast("bigint")
    rank = (exponent - _LEAST_EXPONENT) * _STEPS + steps + F.when(F.isnan(value), 1).otherwise(0)
    return rank * F.when(value < 0, -1).otherwise(1)
