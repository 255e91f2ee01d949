"""Daily difference by digests of key ranges.

A snapshot is written by ranges of the key's hash, with a two-level digest beside it: per range, and per sixteenth
of a range, how many rows it has and sums of their hashes that need no order. Two snapshots are compared by
range, the ranges that differ by their sixteenths, and only rows of sixteenths that differ are read and compared
one by one. When little has changed, little is read; the result is that of ``keyed.snapshot_delta``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.operators.keyed import snapshot_delta

#: Ranges are the first two hex digits of the key's sha1, their sixteenths the third.
RANGES, PARTS = 256, 16
_SUMS = ("n", "n_null", "h_sum", "h_xor")


def _place(key: str) -> tuple[Column, Column]:
    digits = F.sha1(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    return F.substring(digits, 1, 2).alias("_range"), F.substring(digits, 3, 1).alias("_part")


def digest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per ``_range, _part``: rows, rows with a null in ``columns``, sum and xor of the rows' hashes."""
    some_null = F.lit(False)
    for c in columns:
        some_null = some_null | F.col(c).isNull()
    # A null hashes like nothing, so which columns are null goes in as well.
    h = F.xxhash64(*columns, F.array(*[F.col(c).isNull() for c in columns]))
    return rows.groupBy("_range", "_part").agg(
        F.count("*").alias("n"), F.count_if(some_null).alias("n_null"), F.sum(h.cast("decimal(20,0)")).alias("h_sum"), F.bit_xor(h).alias("h_xor")
    )


def write_ranged(snapshot: DataFrame, path: str, key: str = "cr_no", keep: Sequence[str] = schemas.REQUIRED_COLUMNS) -> None:
    """Store a snapshot by key ranges, and the digest of its columns ``keep`` (those it has)."""
    columns = [c for c in keep if c in snapshot.columns]
    placed = snapshot.select("*", *_place(key))
    # One file a range: 256 tasks, each with an even share of the keys.
    placed.repartition(RANGES, "_range").write.mode("errorifexists").partitionBy("_range").parquet(f"{path}/rows")
    stored = snapshot.sparkSession.read.schema(placed.schema).parquet(f"{path}/rows")
    digest(stored, columns).select("_range", "_part", *_SUMS, F.lit(",".join(columns)).alias("columns")).write.mode("errorifexists").parquet(f"{path}/digest")


def read_ranged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a stored snapshot; ranges such as 00 and 1e are text, not numbers."""
    found = spark.read.parquet(f"{path}/rows")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields if f.name != "_range")
    return spark.read.schema(f"{types}, _range string").parquet(f"{path}/rows")


def _differing(new: DataFrame, old: DataFrame, level: Sequence[str], null_safe: bool) -> DataFrame:
    total = [F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.sum("h_sum").alias("h_sum"), F.bit_xor("h_xor").alias("h_xor")]
    left = new.groupBy(*level).agg(*total)
    right = old.groupBy(*level).agg(*total).select(*level, *[F.col(c).alias(f"_old_{c}") for c in _SUMS])
    same = F.lit(True)
    for c in _SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    # Where null equals nothing, rows with a null are in the delta though they did not change.
    differs = ~same if null_safe else ~same | (F.col("n_null") > 0)
    return left.join(right, list(level), "left").where(differs).select(*level)


def changed_parts(new_digest: DataFrame, old_digest: DataFrame, null_safe: bool = False) -> DataFrame:
    """``_range, _part`` that may hold rows of the delta: first by range, then within ranges that differ."""
    ranges = _differing(new_digest, old_digest, ["_range"], null_safe)
    near = [d.join(ranges, "_range", "left_semi") for d in (new_digest, old_digest)]
    return _differing(*near, ["_range", "_part"], null_safe)


def ranged_delta(
    spark: SparkSession, new_path: str, old_path: str, keep: Sequence[str] = schemas.REQUIRED_COLUMNS, null_safe: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """``keyed.snapshot_delta`` of two stored snapshots, reading only the ranges whose digests differ.

    Both must have been written for the same columns; else all is read and compared."""
    digests = [spark.read.parquet(f"{p}/digest") for p in (new_path, old_path)]
    new, old = (read_ranged(spark, p) for p in (new_path, old_path))
    columns = {r[0] for d in digests for r in d.select("columns").distinct().collect()}
    wanted = ",".join(c for c in keep if c in new.columns and c in old.columns)
    if columns == {wanted}:
        # 4,096 parts at most.
        parts = changed_parts(*digests, null_safe).collect()
        ranges, names = sorted({r["_range"] for r in parts}), [r["_range"] + r["_part"] for r in parts]
        new, old = (
            d.where(F.col("_range").isin(ranges) & F.concat("_range", "_part").isin(names)) if parts else d.where(F.lit(False)) for d in (new, old)
        )
    return snapshot_delta(new, old, keep, null_safe, carry)
