"""Registry snapshots (Parquet) and address samples (CSV)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.sources.paths import is_complete


def snapshot_path(base: str, date: str) -> str:
    return f"{base.rstrip('/')}/snapshot_date={date}"


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One snapshot; with a schema given the files are not probed for theirs."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def keep_known(df: DataFrame, keep: Sequence[str] = schemas.REQUIRED_COLUMNS) -> DataFrame:
    """Those of the wanted columns that exist; the scan reads no others."""
    return df.select(*[name for name in keep if name in df.columns])


def write_snapshot(df: DataFrame, base: str, date: str, resume: bool = True) -> str:
    """Write the snapshot of a day (Snappy Parquet) and return its path.

    With ``resume`` a finished snapshot of that day is kept as it is; an unfinished one is redone.
    """
    path = snapshot_path(base, date)
    if not (resume and is_complete(df.sparkSession, path)):
        df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def read_address_csv(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ADDRESS_SAMPLES
) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("encoding", "UTF-8").csv(path)


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header line and commas; one file per partition. Quotes inside values are doubled."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path
