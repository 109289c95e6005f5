"""Exchange of single data files inside a table's folder.

New files are written below the table's folder under a name that readers skip.  A
journal beside them lists which file goes where and which files it replaces; once a
table property names the journal, the exchange is bound to happen: ``carry_out`` can be
repeated after a loss at any point and ends in the same state.  New files are put in
before old ones go, so no row is ever absent; a reader that lists the folder in that
short time sees rows of the exchanged files twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

# Renames and deletions at a time: requests to the file system, no data.
THREADS = 16


class Folder:
    """The file system that holds ``root``, by the calls an exchange needs."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Paths of what lies in a folder; none if it is absent."""
        return [f.getPath().toString() for f in self._fs.listStatus(self._path(path))] if self.exists(path) else []

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Rename ``source``; nothing if that has been done."""
        if self.exists(source) and not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"cannot rename {source} to {target}")
        if not self.exists(target):
            raise FileNotFoundError(target)


def _each(work: Callable, rows: Iterable) -> None:
    with ThreadPoolExecutor(THREADS) as pool:
        for _ in pool.map(work, rows):  # raises what a call raised
            pass


def write_journal(spark: SparkSession, work: str, moves: DataFrame, replaced: DataFrame) -> None:
    """``source, target`` of the new files and ``path`` of the files they replace."""
    moves.select("source", "target").coalesce(1).write.parquet(f"{work}/moves")
    replaced.select("path").coalesce(1).write.parquet(f"{work}/replaced")


def carry_out(spark: SparkSession, work: str) -> tuple[int, int]:
    """Do what the journal below ``work`` says; the number of files put in and taken out.

    File names reach the driver, which has to rename them: metadata of the files exchanged.
    """
    folder = Folder(spark, work)
    moves = spark.read.schema("source string, target string").parquet(f"{work}/moves").collect()
    old = [r["path"] for r in spark.read.schema("path string").parquet(f"{work}/replaced").collect()]
    _each(lambda r: folder.move(r["source"], r["target"]), moves)
    _each(folder.delete, old)
    return len(moves), len(old)


def remove(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete folders of staged data whose use has ended."""
    for path in paths:
        Folder(spark, path).delete(path)
