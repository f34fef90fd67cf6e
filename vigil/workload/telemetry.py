"""Server telemetry derived from ``events`` (definitions in FIXTURES.md).

Two samples a second for five servers, the same integers in any SQL engine.
Metrics are made in hundredths, so their text and their float agree exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil.fixed_values import FAMILY_METRICS, STRICT_TS_FORMAT

FIRST_SECOND = 1704150000
# How late samples of the stream may be.
STREAM_DELAY_SECONDS = 60
# Thresholds that hold in the second half of a stream.
LATER_THRESHOLDS = {"cpu_threshold": 79.5, "mem_threshold": 91.25}


EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


_C = "CAST(round(value * 100) AS BIGINT)"
# Metrics in hundredths.
HUNDREDTHS = {
    "cpu_pct": f"({_C} * 37) % 4000 + 6000",
    "mem_pct": f"({_C} * 91 + event_id * 13) % 4000 + 6000",
    "net_in": f"({_C} * 53 + event_id * 7) % 560000",
    "net_out": f"({_C} * 41 + event_id * 11) % 560000",
    "disk_io": f"({_C} * 29 + event_id * 17) % 280000",
}
SERVER = "concat('srv-', CAST(user_id % 5 AS STRING)) AS server_id"


# Names that CSV has to quote or keep the blanks of.
ODD_SERVERS = ['a"b', 'q"x,y', "back\\slash", '"quoted"', "  lead", "trail  ", "c,d", "plain"]


def event_second() -> Column:
    return F.lit(FIRST_SECOND) + F.shiftright("event_id", 1)


def few_seconds() -> Column:
    """Only 20 different seconds, whatever the number of events."""
    return F.lit(FIRST_SECOND) + F.pmod(F.shiftright("event_id", 1), F.lit(20)) * 3


def second_text(second: Column) -> Column:
    return F.date_format(F.timestamp_seconds(second), STRICT_TS_FORMAT)


def _family_events(rows: DataFrame, family: str) -> DataFrame:
    """Memory and disk lack the samples of error events, so joins drop some."""
    return rows.where(F.col("event_type") != "error") if family in ("mem", "disk") else rows


def samples_of(
    rows: DataFrame, family: str, days: int = 1, whole: bool = False, carry: list[str] | None = None
) -> DataFrame:
    """(event_id, server_id, ts_sec, metrics) of events, batch or stream.

    event_id is the ingest position. With ``days`` above 1, events take turns
    to lie on that many days.
    """
    second = f"{FIRST_SECOND} + shiftright(event_id, 1)"
    if days > 1:
        second += f" + event_id % {days} * 86400"
    metrics = [f"CAST(({HUNDREDTHS[m]}) / 100.0D AS FLOAT) AS {m}" for m in FAMILY_METRICS[family]]
    rows = rows if whole else _family_events(rows, family)
    return rows.selectExpr("event_id", SERVER, f"{second} AS ts_sec", *metrics, *(carry or []))


def rows_of(rows: DataFrame, family: str, whole: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Decoded rows: (ts text, server_id, metrics, event_id, carried columns)."""
    return samples_of(rows, family, whole=whole, carry=carry).select(
        second_text(F.col("ts_sec")).alias("ts"), "server_id", *FAMILY_METRICS[family], "event_id", *(carry or [])
    )


def family_samples(spark: SparkSession, sf_dir: str, family: str, days: int = 1) -> DataFrame:
    return samples_of(events(spark, sf_dir), family, days)


def subsecond_rows(rows: DataFrame, family: str) -> DataFrame:
    """Rows without position whose text has tenths, so that a second's samples differ or tie in time."""
    tenth = (F.lit(9) - F.pmod("event_id", F.lit(3))).cast("string")
    text = F.concat(second_text(F.col("ts_sec")), F.lit("."), tenth).alias("ts")
    return samples_of(rows, family).select(text, "server_id", *FAMILY_METRICS[family])


def family_rows(spark: SparkSession, sf_dir: str, family: str, whole: bool = False) -> DataFrame:
    """Decoded rows of all the family's samples; ``whole``: of all events."""
    return rows_of(events(spark, sf_dir), family, whole)


def family_records(spark: SparkSession, sf_dir: str, family: str, carry: list[str] | None = None) -> DataFrame:
    """JSON records: (value, event_id, carried columns of events)."""
    rows = rows_of(events(spark, sf_dir), family, carry=carry)
    return rows.select(
        F.to_json(F.struct("ts", "server_id", *FAMILY_METRICS[family])).alias("value"), "event_id", *(carry or [])
    )


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide rows of text, as a CSV reader gives them, with event_id beside them.

    Every third row has a time-only timestamp.
    """
    second = event_second()
    text = F.when(
        F.col("event_id") % 3 == 0, F.date_format(F.timestamp_seconds(second), "HH:mm:ss")
    ).otherwise(second_text(second))
    metrics = [
        F.expr(f"concat(({h}) DIV 100, '.', lpad(({h}) % 100, 2, '0')) AS {m}") for m, h in HUNDREDTHS.items()
    ]
    return events(spark, sf_dir).select(text.alias("ts"), F.expr(SERVER), *metrics, "event_id")
