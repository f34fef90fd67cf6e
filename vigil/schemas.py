"""Schemas of the record families, declared once."""

from __future__ import annotations

from pyspark.sql import types as T

from vigil.fixed_values import FAMILY_METRICS


def family_schema(family: str) -> T.StructType:
    """Schema of one family's records and raw snapshot: ts, server_id, metrics."""
    schema = T.StructType().add("ts", T.StringType()).add("server_id", T.StringType())
    for metric in FAMILY_METRICS[family]:
        schema = schema.add(metric, T.FloatType())
    return schema


def dataset_columns() -> list[str]:
    """Columns of the wide dataset, one row per sample with every metric."""
    return ["ts", "server_id", *(m for metrics in FAMILY_METRICS.values() for m in metrics)]
