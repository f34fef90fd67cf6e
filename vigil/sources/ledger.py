"""Which files earlier runs have read, so that a run reads new ones only.

A run notes the days it is about to replace (``begin``), replaces them, and then
its files (``commit``). Spark's marker of a finished write decides whether a
note counts. A run that ends before its commit is repeated from the same files;
the days it began to replace are told by ``interrupted_days``. The last commit
holds the files of all runs, and earlier notes are removed.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.sources.storage import exists, list_files, remove_folder

FILES = "path string, length long, modified timestamp"
IDENTITY = ["path", "length", "modified"]


class FileLedger:
    """A folder with the files read up to the last run, and the days of runs since. Runs are numbered from 1."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def _note(self, kind: str, run: int) -> str:
        return f"{self.folder}/{kind}/run={run}"

    def _notes(self, kind: str) -> dict[int, bool]:
        """Runs with a note of a kind, and whether it was written to its end."""
        if not exists(self.spark, f"{self.folder}/{kind}"):
            return {}
        # markers are hidden files, which the readers leave out, so runs come from the notes themselves
        run = F.regexp_extract("path", rf"/{kind}/run=(\d+)/", 1)
        runs = list_files(self.spark, f"{self.folder}/{kind}").select(run.cast("int").alias("run")).distinct().collect()
        return {r.run: exists(self.spark, f"{self._note(kind, r.run)}/_SUCCESS") for r in runs}

    def last_run(self) -> int:
        """The last run that is committed, 0 before the first."""
        return max((run for run, finished in self._notes("files").items() if finished), default=0)

    def files(self) -> DataFrame:
        """Files the committed runs have read."""
        last = self.last_run()
        if not last:
            return self.spark.createDataFrame([], FILES)
        return self.spark.read.schema(FILES).parquet(self._note("files", last))

    def new_files(self, source: str) -> DataFrame:
        """Files below ``source`` no committed run has read; one written anew under its old name is new."""
        return list_files(self.spark, source).join(self.files(), IDENTITY, "left_anti")

    def begin(self, days: DataFrame) -> int:
        """Note the days (rows with a date) a run is about to replace; returns its number."""
        run = max([self.last_run(), *self._notes("files"), *self._notes("days")]) + 1
        days.select("date").coalesce(1).write.mode("overwrite").parquet(self._note("days", run))
        return run

    def commit(self, run: int, files: DataFrame) -> None:
        """Note the files a run has read; from here on they are not new."""
        self.files().unionByName(files.select(*IDENTITY)).write.mode("overwrite").parquet(self._note("files", run))
        for kind, last in (("files", run - 1), ("days", run)):
            for old in self._notes(kind):
                if old <= last:
                    remove_folder(self.spark, self._note(kind, old))

    def interrupted_days(self) -> list[date | None]:
        """Days that runs began to replace after the last commit, which may be incomplete."""
        last = self.last_run()
        open_runs = [run for run, finished in self._notes("days").items() if finished and run > last]
        if not open_runs:
            return []
        notes = self.spark.read.schema("date date").parquet(*(self._note("days", run) for run in open_runs))
        return [r.date for r in notes.distinct().collect()]
