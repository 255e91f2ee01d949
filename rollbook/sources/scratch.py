"""Frames written to the shared scratch folder, where a later step starts from."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rollbook.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: it is computed once, and a lost executor costs nothing done before."""
    path = f"{scratch_dir(df.sparkSession, name)}/rows"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
