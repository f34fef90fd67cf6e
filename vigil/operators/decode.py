"""JSON records to typed rows, and bad rows set aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from vigil.functions.numbers import round_metric
from vigil.functions.timestamps import epoch_second


def decode_records(records: DataFrame, schema: StructType, carry: list[str] | None = None) -> DataFrame:
    """Decode the JSON in ``value`` (text or binary) into the schema's columns.

    ``carry`` lists columns of ``records`` to keep beside them, such as the
    topic offset. Text that is not a JSON object gives a row of nulls.

    The object is unpacked by a generator: filters on its fields, such as the
    not-null checks a join adds, then stay above it. Below a plain projection
    each field such a filter names would parse the text once more.
    """
    data = F.from_json(F.col("value").cast("string"), schema)
    return records.select(F.inline(F.array(data)), *(carry or []))


def round_metrics(rows: DataFrame, metrics: list[str], scale: int = 2) -> DataFrame:
    return rows.withColumns({m: round_metric(m, scale) for m in metrics})


def with_second(rows: DataFrame, mode: str) -> DataFrame:
    """Add ``ts_sec``, the whole epoch second of the text in ``ts``."""
    return rows.withColumn("ts_sec", epoch_second(F.col("ts"), mode))


def flag_problems(rows: DataFrame) -> DataFrame:
    """Add ``problem``: why a row can not reach a report, null where it can.

    Needs ``server_id``, ``ts`` and ``ts_sec``. A missing metric is no problem:
    statistics skip it.
    """
    return rows.withColumn(
        "problem",
        F.when(F.col("server_id").isNull() & F.col("ts").isNull(), "undecodable")
        .when(F.col("server_id").isNull(), "no server")
        .when(F.col("ts_sec").isNull(), "bad timestamp"),
    )


def good_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("problem").isNull()).drop("problem")


def bad_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("problem").isNotNull())
