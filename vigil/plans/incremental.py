"""A snapshot kept up to date from new files only."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.operators.decode import with_second
from vigil.operators.dedupe import first_per_key
from vigil.plans.snapshots import decode_family, raw_snapshot
from vigil.schemas import family_schema
from vigil.sources.days import Days, day_of
from vigil.sources.ledger import FILES, IDENTITY, FileLedger
from vigil.sources.sinks import write_snapshot_by_date
from vigil.sources.storage import exists, job_folder, list_files, remove_folder
from vigil.sources.tables import read_snapshot_parquet

KEYS = ["server_id", "ts"]


def refresh_snapshot(
    spark: SparkSession,
    source: str,
    out: str,
    family: str,
    timestamps: str,
    ledger: str | None = None,
    check: Callable[[DataFrame], DataFrame] | None = None,
) -> dict[str, object]:
    """Merge the records of files below ``source`` that no earlier run has read into the days of ``out``.

    Only days that new rows belong to are read and written again, each as a whole.
    The result is that of one ``raw_snapshot`` over all files: the row kept of a
    server and timestamp is the one with the largest values, a choice that does not depend on
    the order in which files come. ``check`` may add a filter on decoded rows.

    Files are noted in the ledger, by default in ``out`` itself, after the days
    are written. A run that fails before reads the same files again, which adds
    nothing; days it may have left incomplete are then made from all files.
    Returns the counts and the days written; None stands for rows whose timestamp does not parse.
    """
    notes = FileLedger(spark, ledger or f"{out.rstrip('/')}/_ledger")
    found = [tuple(r) for r in notes.new_files(source).collect()]
    broken = notes.interrupted_days()
    if not found and not broken:
        return {"new_files": 0, "days": []}
    folder = job_folder(spark, f"snapshot-{family}")

    def decoded(paths: list[str]) -> DataFrame:
        rows = decode_family(spark.read.text(paths).select("value"), family)
        rows = with_second(rows if check is None else check(rows), timestamps)
        return rows.withColumn("date", day_of(F.col("ts_sec"))).drop("ts_sec")

    def stored(rows: DataFrame, name: str) -> DataFrame:
        """Rows without repeats, written once: their days are asked for before they are merged."""
        unique = first_per_key(rows.dropna(subset=KEYS), [*KEYS, "date"])
        unique.write.partitionBy("date").parquet(f"{folder}/{name}")
        return spark.read.schema(family_schema(family).add("date", "date")).parquet(f"{folder}/{name}")

    new = stored(decoded([path for path, *_ in found]), "new") if found else None
    if broken:
        every = [r.path for r in list_files(spark, source).select("path").collect()]
        again = Days.of(broken).holds(F.col("date"))
        rebuilt = stored(decoded(every).where(again), "again")
        new = rebuilt if new is None else new.where(~again).unionByName(rebuilt)
    days = sorted((r.date for r in new.select("date").distinct().collect()), key=lambda d: d or date.min)
    days = sorted({*days, *broken}, key=lambda d: d or date.min)
    run = notes.begin(spark.createDataFrame([(d,) for d in days], "date date"))
    merged = new
    if exists(spark, out) and (kept := Days.of(d for d in days if d not in broken)) != Days(()):
        old = read_snapshot_parquet(spark, out, family, days=kept, dated=True)
        merged = old.unionByName(new)
    merged = raw_snapshot(merged.drop("date"), family, ordered=False)
    write_snapshot_by_date(with_second(merged, timestamps), out, days=Days.of(days))
    notes.commit(run, spark.createDataFrame(found, FILES).select(*IDENTITY))
    remove_folder(spark, folder)
    return {"new_files": len(found), "days": [d and d.isoformat() for d in days]}
