"""Whole partitions of a stored table replaced by renames.

A write goes to a run folder inside the table, ``<table>/_swap/<run>``, which readers of
the table skip:

    new/       the increment, written once
    touched/   one row per partition of the increment: Spark names the folders,
               also of null values
    data/      the new partitions, complete
    READY      written when ``data`` is complete: from here on the run goes forward
    old/       partitions moved out of the way

Then every partition of ``data`` is swapped by two renames (the old one away, the new one
in), and the run folder is removed with all stages. :func:`recover` is the restart rule:
a run without READY is dropped (the table still holds every old partition), a run with
READY is finished, partition by partition, wherever it stopped. So a killed write leaves
each partition old or new once the next write, or a call of ``recover``, has run; between
the two renames a partition can be absent for readers. One writer per table at a time.

The driver handles names of touched partitions only; rows never pass through it. On
object stores a rename copies, so there the swap costs a second write of the partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

SWAP, READY = "_swap", "READY"
THREADS = 16


class Folder:
    """A folder reached through Spark's own file systems."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, *parts: str) -> str:
        return "/".join([self.path, *parts])

    def exists(self, *parts: str) -> bool:
        return self._fs.exists(self._p(self.at(*parts)))

    def names(self, *parts: str) -> list[str]:
        """Folders and files directly inside, without hidden ones (partition folders may begin with ``_``)."""
        p = self._p(self.at(*parts))
        if not self._fs.exists(p):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(p)]
        return sorted(n for n in found if "=" in n or not n.startswith(("_", ".")))

    def partitions(self, depth: int, *parts: str) -> list[str]:
        """Relative folders of the partitions, e.g. ``symbol=A/year=2024``."""
        level = [""]
        for _ in range(depth):
            level = [f"{d}/{n}".lstrip("/") for d in level for n in self.names(*parts, *([d] if d else []))
                     if "=" in n]
        return level

    def move(self, source: Sequence[str], target: Sequence[str]) -> None:
        to = self._p(self.at(*target))
        self._fs.mkdirs(to.getParent())
        if not self._fs.rename(self._p(self.at(*source)), to):
            raise OSError(f"cannot rename {self.at(*source)} to {to}")

    def touch(self, *parts: str) -> None:
        self._fs.create(self._p(self.at(*parts))).close()

    def remove(self, *parts: str) -> None:
        """Removes a folder below this one (never the folder itself)."""
        assert parts and all(parts)
        self._fs.delete(self._p(self.at(*parts)), True)


class Swap:
    """One run of a partition replacement in the table at ``path``."""

    def __init__(self, spark: SparkSession, path: str, partition_cols: Sequence[str], run: str | None = None):
        self.spark, self.cols = spark, list(partition_cols)
        self.table = Folder(spark, path)
        self.run = run or uuid.uuid4().hex

    def folder(self, name: str) -> str:
        return self.table.at(SWAP, self.run, name)

    def stage(self, df: DataFrame) -> DataFrame:
        """``df`` evaluated once: written into the run and read back."""
        df.write.option("compression", "snappy").parquet(self.folder("new"))
        return self.spark.read.schema(df.schema).parquet(self.folder("new"))

    def touched(self, df: DataFrame) -> list[str]:
        """Partition folders of ``df``'s rows, named by Spark."""
        one = "_".join([*self.cols, "touched"])
        (df.select(*self.cols).distinct().selectExpr("*", f"true AS `{one}`")
         .write.partitionBy(*self.cols).parquet(self.folder("touched")))
        return self.table.partitions(len(self.cols), SWAP, self.run, "touched")

    def commit(self) -> None:
        self.table.touch(SWAP, self.run, READY)
        self.finish()

    def finish(self) -> None:
        """Swap what is left to swap, then remove the run."""
        at = (SWAP, self.run)

        def one(part: str) -> None:
            if self.table.exists(part) and not self.table.exists(*at, "old", part):
                self.table.move([part], [*at, "old", part])
            self.table.move([*at, "data", part], [part])

        with ThreadPoolExecutor(THREADS) as pool:
            list(pool.map(one, self.table.partitions(len(self.cols), *at, "data")))
        self.table.remove(*at)

    def drop(self) -> None:
        self.table.remove(SWAP, self.run)


def recover(spark: SparkSession, path: str, partition_cols: Sequence[str]) -> list[str]:
    """Finish committed runs and drop the others; the runs that were finished."""
    table, done = Folder(spark, path), []
    for run in table.names(SWAP):
        swap = Swap(spark, path, partition_cols, run)
        if table.exists(SWAP, run, READY):
            swap.finish()
            done.append(run)
        else:
            swap.drop()
    return done
