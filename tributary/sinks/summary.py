"""Incremental summaries with atomic versions.

A summary keeps partial states (sums, counts, extremes per key) and a ledger of
the input files they come from.  An update reads only files that the ledger
lacks, merges their states into the stored ones and writes both as a new
version; a marker file, made last, makes it the current one.  A run that fails
leaves no marker, so the version before stays readable, and the next run starts
over from it.  A file is known by path, length and modification time: one that
was replaced under its old name is refused, since its old rows cannot be taken
out of the states.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
LEDGER = "path string, length long, modificationTime timestamp"


class Summary:
    """``measures`` is ``{out: (kind, column)}`` with kind sum, count, min, max
    or avg, over ``keys``; versions live under ``root``."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], measures: dict[str, tuple[str, str]]) -> None:
        self.spark, self.root, self.keys, self.measures = spark, root.rstrip("/"), list(keys), measures
        self.parts: dict[str, tuple[str, str]] = {}
        for out, (kind, column) in measures.items():
            self.parts |= ({f"{out}_sum": ("sum", column), f"{out}_count": ("count", column)} if kind == "avg"
                           else {out: (kind, column)})

    def _fs(self, name: str = ""):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The newest complete version, 0 before the first."""
        p, fs = self._fs()
        if not fs.exists(p):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return max([int(n.removeprefix("done-")) for n in names if n.startswith("done-")], default=0)

    def _stored(self, what: str, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/v{version}/{what}")

    def new_files(self, source: str) -> DataFrame:
        """The files under ``source`` that the ledger lacks (contents are not read)."""
        files = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(source).select(
            "path", "length", "modificationTime")
        now = self.version()
        if not now:
            return files
        ledger = self._stored("ledger", now)
        again = files.join(ledger.withColumnsRenamed({"length": "l", "modificationTime": "m"}), "path").where(
            "length <> l or modificationTime <> m")
        changed = again.select("path").limit(1).collect()
        if changed:
            raise ValueError(f"{changed[0].path} has changed since its rows were summed")
        return files.join(ledger.select("path"), "path", "left_anti")

    def update(self, source: str) -> int:
        """Take in the new files under ``source``; the number of them (0: the
        current version stays)."""
        now, fresh = self.version(), self.new_files(source)
        step = f"{self.root}/v{now + 1}"
        fresh.write.mode("overwrite").parquet(f"{step}/new")
        fresh = self.spark.read.parquet(f"{step}/new")
        paths = [r.path for r in fresh.select("path").collect()]  # this load's own files, to be listed by the reader
        if not paths:
            return 0
        delta = self.spark.read.parquet(*paths).groupBy(*self.keys).agg(
            *[getattr(F, kind)(column).alias(out) for out, (kind, column) in self.parts.items()])
        ledger = fresh
        if now:
            old = self._stored("state", now)
            delta = old.unionByName(delta).groupBy(*self.keys).agg(
                *[_MERGE[kind](out).alias(out) for out, (kind, _) in self.parts.items()])
            ledger = self._stored("ledger", now).unionByName(fresh)
        delta.write.mode("overwrite").parquet(f"{step}/state")
        ledger.write.mode("overwrite").parquet(f"{step}/ledger")
        marker, fs = self._fs(f"done-{now + 1}")
        if not fs.createNewFile(marker):
            raise RuntimeError(f"version {now + 1} of {self.root} was made by another run")
        return len(paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The summary of the current (or an older) version."""
        stored = self._stored("state", version or self.version())
        return stored.select(*self.keys, *[
            F.try_divide(F.col(f"{out}_sum"), F.col(f"{out}_count")).alias(out) if kind == "avg" else F.col(out)
            for out, (kind, _) in self.measures.items()])
