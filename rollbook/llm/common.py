"""Words, let-bindings and written intermediate tables shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.session import scratch_dir

# The characters between words, and patterns made of them.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once a row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text_or_empty(text), F.lit(BLANKS))


def words(text: Column) -> Column:
    """The words of a text in order; none for null, empty or blank text."""
    return F.filter(F.split(trimmed(text), BLANK_CLASS + "+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words (long)."""
    return let(
        trimmed(text),
        lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, BLANK_CLASS + "+"))),
    ).cast("long")


def written(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared scratch folder and read back: lineage ends there, and executors
    that are lost later cost nothing of what was done before."""
    spark: SparkSession = df.sparkSession
    path = f"{scratch_dir(spark, name)}/rows"
    df.write.mode("errorifexists").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def give_back_memory() -> None:
    """Return what a finished piece of work has freed to the system: workers are used again, and their share of
    an executor's memory should not stay at the most that any task before took."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted``, or the first of wanted_1, wanted_2 ... that no column has (case ignored)."""
    low = {c.lower() for c in taken}
    name, n = wanted, 0
    while name.lower() in low:
        n += 1
        name = f"{wanted}_{n}"
    return name
