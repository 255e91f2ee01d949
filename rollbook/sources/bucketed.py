"""Keyed tables stored in buckets of their key.

Rows of a key lie in one file of a version, sorted by the key, so a join or aggregate on the key needs no shuffle
of the table: only updates are shuffled, into as many partitions as the table has buckets, and each task writes
the bucket it has joined. Versions, claims and success markers are those of ``KeyedTable``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.operators import keyed
from rollbook.sources.tables import KeyedTable


class BucketedTable(KeyedTable):
    def __init__(
        self, spark: SparkSession, base: str, schema: T.StructType, key: str, buckets: int, keep_versions: int | None = None
    ):
        """Choose ``buckets`` so that one fits a task (some 200 MB each) and keep the number: tables meet without
        a shuffle where theirs are equal. Rows without a key share a bucket."""
        super().__init__(spark, base, schema, keep_versions)
        if key not in schema.names:
            raise ValueError(f"{key} is not a column of the table")
        self.key = key
        self.buckets = buckets

    def _name(self, path: str) -> str:
        return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"

    def _load(self, path: str) -> DataFrame:
        # A session that did not write the version learns of its buckets here; the catalog holds no data.
        quoted = lambda name: "`" + name.replace("`", "``") + "`"
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema.fields)
        place = path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(path)} ({columns}) USING parquet CLUSTERED BY ({quoted(self.key)}) "
            f"SORTED BY ({quoted(self.key)}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        return self.spark.table(self._name(path))

    def _store(self, df: DataFrame, path: str) -> None:
        stored = df.write.format("parquet").mode("errorifexists").option("path", path)
        stored.bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self._name(path))

    def write(self, df: DataFrame) -> DataFrame:
        """Store the frame as the next version: one shuffle deals its rows over the buckets."""
        return super().write(df.repartition(self.buckets, self.key))

    def _dealt(self, updates: DataFrame, order_by: Sequence[str]) -> DataFrame:
        """One update per key, in the partitions of the table's buckets. Copies shrink before they are dealt."""
        latest = keyed.latest_per_key(updates.where(F.col(self.key).isNotNull()), self.key, order_by)
        return latest.repartition(self.buckets, self.key)

    def merged(self, updates: DataFrame, order_by: Sequence[str] = (), **options) -> DataFrame:
        """``keyed.upsert`` of the table and the updates, without a shuffle of the table."""
        return keyed.upsert(self.read(), self._dealt(updates, order_by), self.key, order_by=order_by, **options)

    def updated(
        self, updates: DataFrame, update_cols: Sequence[str] | None = None, order_by: Sequence[str] = (), **options
    ) -> DataFrame:
        """``keyed.update_by_key`` of the table and the updates, without a shuffle of the table."""
        return keyed.update_by_key(self.read(), self._dealt(updates, order_by), self.key, update_cols, order_by, **options)

    def upsert(self, updates: DataFrame, **options) -> DataFrame:
        """The merged rows as the next version: they are read, merged and written in the tasks of their buckets."""
        return super().write(self.merged(updates, **options))

    def update(self, updates: DataFrame, update_cols: Sequence[str] | None = None, **options) -> DataFrame:
        """The updated rows as the next version, likewise."""
        return super().write(self.updated(updates, update_cols, **options))

    def delta(self, new: DataFrame, keep: Sequence[str] | None = None, null_safe: bool = False) -> DataFrame:
        """Rows of ``new`` that the table has not; without any shuffle if ``new`` is a table of equal buckets."""
        return keyed.keyed_delta(new, self.read(), self.key, self.schema.names if keep is None else keep, null_safe)
