"""Wide rows to one JSON record per metric family."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vigil import fixed_values as fixed
from vigil.functions.numbers import parse_number
from vigil.functions.timestamps import with_default_date


def fan_out(dataset: DataFrame, default_date: str = fixed.DEFAULT_DATE) -> DataFrame:
    """Rows (topic, value) from wide text rows, in one pass.

    A family is sent only if the row has a timestamp and every metric of this
    family and of those before it is number text, so a row that breaks off at a
    later family still sends the earlier ones. A column the dataset lacks
    counts as broken.
    """
    def text(column):
        return F.col(column) if column in dataset.columns else F.lit(None).cast("string")

    # Parsed once here, used by the record and by the checks of later families.
    parsed = dataset.select(
        with_default_date(text("ts"), default_date).alias("ts"),
        text("server_id").alias("server_id"),
        *(parse_number(text(m)).alias(m) for ms in fixed.FAMILY_METRICS.values() for m in ms),
    )
    sendable = F.col("ts").isNotNull() if "server_id" in dataset.columns else F.lit(False)
    records = []
    for family, metrics in fixed.FAMILY_METRICS.items():
        for metric in metrics:
            sendable = sendable & F.col(metric).isNotNull()
        value = F.to_json(F.struct("ts", "server_id", *metrics))
        record = F.struct(F.lit(fixed.TOPICS[family]).alias("topic"), value.alias("value"))
        records.append(F.when(sendable, record))
    return (
        parsed.select(F.explode(F.array(*records)).alias("record"))
        .where(F.col("record").isNotNull())
        .select("record.*")
    )
