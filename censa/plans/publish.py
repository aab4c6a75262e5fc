"""Staged writes: a run's tables appear in their folder only when complete.

Tables are written to ``{folder}/_staging/{run}/{name}``. ``publish`` then
writes a journal (a manifest of the run's tables), moves each old table to
``{folder}/_old/{run}`` and the new one into its place, and removes journal and
old tables. Whatever happens to the run, every table has a complete copy:

* before the journal is there, the old tables are untouched;
* after it, all new tables are complete, and the next ``recover`` (every run
  starts with one) finishes the moves that are missing.

Moves are renames of Hadoop's file systems: one step on HDFS and local disks,
a copy on object stores. Runs into one folder must not overlap.
"""

from __future__ import annotations

import json
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


class Staged:
    """The staged tables of one run into ``folder``."""

    def __init__(self, spark: SparkSession, folder: str, run: str | None = None):
        self.spark, self.folder, self.run = spark, folder.rstrip("/"), run or uuid4().hex
        self.fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self._path(path))

    def final(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def staged(self, name: str) -> str:
        return f"{self.folder}/_staging/{self.run}/{name}"

    def old(self, name: str) -> str:
        return f"{self.folder}/_old/{self.run}/{name}"

    def _move(self, source: str, target: str) -> None:
        self.fs.mkdirs(self._path(target).getParent())
        if not self.fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not move {source} to {target}")

    def _remove(self, path: str) -> None:
        self.fs.delete(self._path(path), True)

    def journal(self) -> str:
        return f"{self.folder}/_journal/{self.run}"

    def publish(self, names: list[str]) -> None:
        """Put the staged tables ``names`` in place of the old ones."""
        draft = f"{self.folder}/_staging/{self.run}/_journal"
        out = self.fs.create(self._path(draft), True)
        out.write(bytearray(json.dumps(names).encode()))
        out.close()
        self._move(draft, self.journal())  # from here on the run counts
        self._finish(names)

    def _finish(self, names: list[str]) -> None:
        for name in names:
            if self.exists(self.staged(name)):  # else it is in place already
                if self.exists(self.final(name)):
                    self._move(self.final(name), self.old(name))
                self._move(self.staged(name), self.final(name))
        for path in (self.journal(), f"{self.folder}/_old/{self.run}", f"{self.folder}/_staging/{self.run}"):
            self._remove(path)

    def drop(self) -> None:
        """Remove what was staged and not published."""
        self._remove(f"{self.folder}/_staging/{self.run}")


def recover(spark: SparkSession, folder: str) -> list[str]:
    """Finish the runs that were lost while their tables were moved, and
    remove what runs lost earlier had staged. Returns the finished runs."""
    here = Staged(spark, folder)
    done = []
    for kind in ("_journal", "_staging"):
        if not here.exists(f"{here.folder}/{kind}"):
            continue
        for status in here.fs.listStatus(here._path(f"{here.folder}/{kind}")):
            run = Staged(spark, folder, status.getPath().getName())
            if kind == "_journal":
                text = spark.read.text(status.getPath().toString(), wholetext=True).first()[0]
                run._finish(json.loads(text))
                done.append(run.run)
            else:
                run.drop()
    return done


def read_published(spark: SparkSession, folder: str, name: str, fmt: str = "parquet", **options) -> DataFrame:
    """A published table; a lost run's moves are finished first."""
    recover(spark, folder)
    return spark.read.format(fmt).options(**options).load(Staged(spark, folder).final(name))
