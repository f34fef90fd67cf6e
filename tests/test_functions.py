import math

import pytest
from pyspark.sql import functions as F

from vigil.config import CPU_MEM, NET_DISK
from vigil.functions.alerts import alert_text
from vigil.functions.numbers import parse_number
from vigil.functions.timestamps import epoch_second, time_of_day, with_default_date

TEN = 1760954400  # 2025-10-20 10:00:00 UTC

TIMESTAMPS = [
    ("2025-10-20 10:00:00", TEN, TEN),
    ("2025-10-20 10:00:00.7", TEN, None),
    ("2025-10-20T10:00:00", TEN, None),
    ("2025-10-20 10:00:00Z", TEN, None),
    ("2025-10-20", TEN - 36000, None),
    ("10:00:00", None, None),
    ("T10:00:00", None, None),
    ("1969-12-31 23:59:59.5", -1, None),
    ("bad", None, None),
    ("", None, None),
    (None, None, None),
]


def test_timestamps(column):
    texts = [t for t, _, _ in TIMESTAMPS]
    assert column(texts, epoch_second(F.col("x"), "lenient")) == [l for _, l, _ in TIMESTAMPS]
    assert column(texts, epoch_second(F.col("x"), "strict")) == [s for _, _, s in TIMESTAMPS]


def test_unknown_timestamp_mode():
    with pytest.raises(ValueError):
        epoch_second(F.lit(""), "guess")


def test_default_date_goes_by_length_alone(column):
    texts = ["10:00:00", "2025-10-21 10:00:00", "whatever", "", None]
    dated = column(texts, with_default_date(F.col("x")))
    assert dated == ["2025-10-20 10:00:00", "2025-10-21 10:00:00", "2025-10-20 whatever", "", None]


def test_time_of_day_wraps_at_midnight(column):
    assert column(["86390", "86400"], time_of_day(F.col("x").cast("bigint"))) == ["23:59:50", "00:00:00"]


def test_numbers(column):
    good = {" 5 ": 5.0, "1e3": 1000.0, "1_0": 10.0, "1.": 1.0, ".5": 0.5, "+2.5E-1": 0.25, "inf": math.inf, "-Infinity": -math.inf}
    assert column(list(good), parse_number(F.col("x"))) == list(good.values())
    assert all(math.isnan(n) for n in column(["nan", "-NaN", " +nan"], parse_number(F.col("x"))))
    bad = ["", "x", "1.5f", "2d", "0x1p3", "1__0", "_1", "1e", "1 0", ".", None]
    assert column(bad, parse_number(F.col("x"))) == [None] * len(bad)


def test_rounding_is_half_up_on_decimal_text(spark):
    frame = spark.sql("select 2.675d a, -2.675d b, 0.145d c").select(*(F.round(c, 2) for c in "abc"))
    assert tuple(frame.first()) == (2.68, -2.68, 0.15)


def alerts(spark, rule, pairs, limits, kind="double"):
    frame = spark.createDataFrame(
        [(i, *p) for i, p in enumerate(pairs)], f"i int, a {kind}, b {kind}"
    )
    text = alert_text(F.col("a"), F.col("b"), *(F.lit(l) for l in limits), rule.texts, rule.needs_both)
    return [r.t for r in frame.select("i", text.alias("t")).orderBy("i").collect()]


def test_alerts_with_nulls(spark):
    pairs = [(None, 90.0), (90.0, None), (90.0, 90.0), (90.0, 1.0), (1.0, 90.0), (1.0, 1.0), (87.97, 83.18)]
    both, left, right = CPU_MEM.texts
    assert alerts(spark, CPU_MEM, pairs, (87.97, 83.18)) == ["", "", both, left, right, "", ""]
    both, left, right = NET_DISK.texts
    assert alerts(spark, NET_DISK, pairs, (87.97, 83.18)) == [right, left, both, left, right, "", ""]


def test_float_samples_equal_to_a_threshold(spark):
    both, left, right = NET_DISK.texts
    assert alerts(spark, NET_DISK, [(5338.75, 2696.29)], (5338.75, 2696.29), "float") == [right]
    assert alerts(spark, CPU_MEM, [(87.97, 83.18)], (87.97, 83.18), "float") == [CPU_MEM.texts[0]]


def test_nan_is_high(spark):
    assert alerts(spark, CPU_MEM, [(math.nan, 1.0)], (87.97, 83.18)) == [CPU_MEM.texts[1]]
