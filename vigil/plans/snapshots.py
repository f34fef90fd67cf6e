"""Raw snapshots of a metric family."""

from __future__ import annotations

from pyspark.sql import DataFrame

from vigil.fixed_values import FAMILY_METRICS
from vigil.operators.decode import bad_rows, decode_records, flag_problems, round_metrics, with_second
from vigil.operators.dedupe import first_per_key
from vigil.schemas import family_schema


def decode_family(records: DataFrame, family: str, order: list[str] | None = None) -> DataFrame:
    """Records of one family as rows with metrics rounded to two places."""
    rows = decode_records(records, family_schema(family), carry=order)
    return round_metrics(rows, FAMILY_METRICS[family])


def raw_snapshot(
    rows: DataFrame,
    family: str,
    order: list[str] | None = None,
    keep_undecodable: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Decoded rows, one per server and timestamp text, sorted by both if ``ordered``.

    Rows without server or timestamp are left out (``quarantine`` has them);
    ``keep_undecodable`` keeps one of each, as nulls, for a like-for-like copy.
    """
    if not keep_undecodable:
        rows = rows.dropna(subset=["server_id", "ts"])
    unique = first_per_key(rows, ["server_id", "ts"], order)
    snapshot = unique.select(*family_schema(family).names)
    return snapshot.orderBy("server_id", "ts") if ordered else snapshot


def quarantine(rows: DataFrame, timestamps: str) -> DataFrame:
    """Decoded rows that can not reach a report, with the reason in ``problem``."""
    return bad_rows(flag_problems(with_second(rows, timestamps)))
