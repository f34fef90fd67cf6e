"""Alert text from two measures and their thresholds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vigil import fixed_values as fixed


def alert_text(
    left: Column,
    right: Column,
    left_threshold: Column,
    right_threshold: Column,
    texts: tuple[str, str, str],
    needs_both: bool,
) -> Column:
    """Text for both high, left high or right high; no text otherwise.

    High is strictly above the threshold, compared as double: a float sample
    written like its threshold may lie just above it. NaN is high. A null side
    is not high; with ``needs_both`` it also silences the other side.
    """
    both, left_only, right_only = texts
    left_high = F.coalesce(left.cast("double") > left_threshold, F.lit(False))
    right_high = F.coalesce(right.cast("double") > right_threshold, F.lit(False))
    text = (
        F.when(left_high & right_high, both)
        .when(left_high, left_only)
        .when(right_high, right_only)
        .otherwise(fixed.NO_ALERT)
    )
    if needs_both:
        return F.when(left.isNull() | right.isNull(), fixed.NO_ALERT).otherwise(text)
    return text
