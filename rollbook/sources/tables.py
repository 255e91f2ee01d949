"""Keyed tables kept as numbered Parquet folders.

A write claims the next number by creating a file, which only one writer can, and makes that folder; it never
touches one that is there: not one that may be being read, nor one that another writer has begun, which is an
error. A folder counts once its success marker is there,
so a lost job leaves the previous version in force; the next write goes past its folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollbook.operators.columns import conform
from rollbook.sources.paths import claim, file_names, folder_names, is_complete, remove_folder


class KeyedTable:
    def __init__(self, spark: SparkSession, base: str, schema: T.StructType, keep_versions: int | None = None):
        """``keep_versions`` finished versions stay (at least 2, for readers at work); None keeps all."""
        if keep_versions is not None and keep_versions < 2:
            raise ValueError("keep_versions must be 2 or more")
        self.keep_versions = keep_versions
        self.spark = spark
        self.base = base.rstrip("/")
        self.schema = schema

    def _path(self, version: int) -> str:
        return f"{self.base}/v={version}"

    def _numbers(self) -> list[int]:
        return sorted(int(n[2:]) for n in folder_names(self.spark, self.base) if n.startswith("v=") and n[2:].isdigit())

    def latest(self) -> int | None:
        """Highest finished version."""
        return next((n for n in reversed(self._numbers()) if is_complete(self.spark, self._path(n))), None)

    def read(self) -> DataFrame:
        """The latest version in the declared schema: columns it lacks are null; empty at first."""
        version = self.latest()
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self._load(self._path(version))

    def _load(self, path: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(path)

    def _store(self, df: DataFrame, path: str) -> None:
        df.write.mode("errorifexists").parquet(path)

    def _claim(self, version: int) -> None:
        """Take a version number before its folder is there; of two writers that chose one, one gets it."""
        if not claim(self.spark, f"{self.base}/claim={version}"):
            raise RuntimeError(f"another writer has begun version {version} of {self.base}")

    def write(self, df: DataFrame) -> DataFrame:
        """Store the frame as the next version and return it read back (lineage ends here)."""
        numbers = self._numbers()
        claimed = [int(n[6:]) for n in file_names(self.spark, self.base) if n.startswith("claim=") and n[6:].isdigit()]
        target = max([-1, *numbers, *claimed]) + 1
        self._claim(target)
        self._store(conform(df, self.schema), self._path(target))
        if self.keep_versions is not None:
            done = [n for n in numbers if is_complete(self.spark, self._path(n))]
            for old in done[: max(0, len(done) + 1 - self.keep_versions)]:
                remove_folder(self.spark, self._path(old))
        return self.read()
