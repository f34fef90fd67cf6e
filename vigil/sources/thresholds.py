"""Threshold files: lines of ``name: number``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vigil import fixed_values as fixed
from vigil.functions.numbers import parse_number


def read_threshold_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rows (position, line) of a threshold file, in file order."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("position", "line"))


def threshold_table(
    lines: DataFrame,
    names: list[str] | None = None,
    default: float = fixed.MISSING_THRESHOLD,
    by: list[str] | None = None,
) -> DataFrame:
    """One row with a double column per name, from rows (position, line); one per value of ``by``.

    Lines without a colon are skipped. The last line of a name wins; a name
    without a line gets the default. A line whose value is no number fails the
    query, whichever name it has.
    """
    names = names or list(fixed.THRESHOLDS)
    by = by or []
    parts = F.split("line", ":", 2)
    entry = F.col("line").contains(":")
    entries = lines.select(
        *by,
        "position",
        F.when(entry, F.trim(parts[0])).alias("name"),
        F.when(entry, parse_number(F.get(parts, F.lit(1)))).alias("number"),
    )
    kept = [_last(name).alias(name) for name in names]
    bad = F.count_if(F.col("name").isNotNull() & F.col("number").isNull()).alias("bad_lines")
    row = entries.groupBy(*by).agg(bad, *kept)
    failed = F.raise_error(F.concat(F.col("bad_lines").cast("string"), F.lit(" bad threshold line(s)")))
    return row.select(
        *by,
        *(
            F.when(F.col("bad_lines") > 0, failed.cast("double"))
            .otherwise(F.coalesce(name, F.lit(float(default))))
            .alias(name)
            for name in names
        )
    )


def _last(name: str) -> Column:
    matches = F.col("name") == name
    return F.max_by(F.when(matches, F.col("number")), F.when(matches, F.col("position")))


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    return threshold_table(read_threshold_lines(spark, path))


#: Column with the epoch second a version of the thresholds holds from.
VALID_FROM = "valid_from"


def read_threshold_versions(spark: SparkSession, root: str) -> DataFrame:
    """A row of thresholds per folder ``valid_from=<epoch second>`` below ``root``, each with one threshold file.

    A version holds for windows that end at its second or later, until the next.
    """
    text = spark.read.schema(f"value string, {VALID_FROM} long").text(root, wholetext=True)
    lines = text.select(VALID_FROM, F.posexplode(F.split("value", r"\r\n|\r|\n")).alias("position", "line"))
    return threshold_table(lines, by=[VALID_FROM])
