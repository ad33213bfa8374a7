"""Totals that are kept up to date: partial aggregates per load of new files, merged when they are read.

A partial aggregate is one that can be merged again: counts, sums, least and greatest values, the first rows of an
order, sketches of distinct values. A refresh reads only files it has not seen, so the work of a load grows with the load, and
a reader never scans the table itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.sources.files import exists, remove

_FILES = "path string, modified timestamp, length long"


class Partials:
    """Partial aggregates of the Parquet files at ``source``, stored below ``folder`` by kind and load.

    A load is named by its files and is valid once they are listed, which is written last; a load that broke off is
    written again under the same name. When a file that was loaded is gone or changed, all is built anew. One writer at a
    time; the files' names, not their rows, pass through the driver.
    """

    def __init__(self, spark: SparkSession, folder: str, source: str):
        self.spark, self.folder, self.source = spark, folder.rstrip("/"), source
        self._known: dict[tuple, str] | None = None

    def _present(self) -> set[tuple]:
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.source)
        return {tuple(r) for r in listed.select("path", "modificationTime", "length").collect()}

    def _loaded(self) -> dict[tuple, str]:
        if self._known is None:
            found = exists(self.spark, f"{self.folder}/files")
            rows = self.spark.read.schema(f"{_FILES}, load string").parquet(f"{self.folder}/files").collect() if found else []
            self._known = {(r.path, r.modified, r.length): r.load for r in rows}
        return self._known

    def refresh(self, build: Callable[[list[str]], dict[str, DataFrame]]) -> int:
        """Load the files that are new; ``build`` gives the partial aggregates of a list of files by kind. The number of files."""
        self._known = None
        present, loaded = self._present(), set(self._loaded())
        if loaded - present:
            remove(self.spark, self.folder)
            loaded = set()
        new = sorted(present - loaded)
        if new:
            load = "l" + hashlib.sha256(repr(new).encode()).hexdigest()[:20]
            for kind, rows in build([f[0] for f in new]).items():
                rows.write.mode("overwrite").parquet(f"{self.folder}/{kind}/load={load}")
            self._known = None
            self.spark.createDataFrame(new, _FILES).coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/files/load={load}")
        return len(new)

    def read(self, kind: str) -> DataFrame:
        """The partial aggregates of all valid loads, to be merged by the reader."""
        loads = sorted(set(self._loaded().values()))
        return self.spark.read.option("basePath", f"{self.folder}/{kind}").parquet(
            *[f"{self.folder}/{kind}/load={load}" for load in loads]).drop("load")
