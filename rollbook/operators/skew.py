"""Joins of many rows to a table that is unique on the key, when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is heavy from this many rows on; about what one task joins comfortably.
HEAVY_ROWS = 1_000_000
# At most this many keys can hold more than 1 / MAX_HEAVY_KEYS of all rows each, so a list of them is
# bounded without leaving any out.
MAX_HEAVY_KEYS = 1_000


def heavy_keys(counts: DataFrame, key: str, min_rows: int = HEAVY_ROWS, max_keys: int = MAX_HEAVY_KEYS) -> DataFrame:
    """``key, n_salts`` of the keys with more than ``min_rows`` rows and more than a ``max_keys``-th of
    all rows: so many salts that a task gets about that number of them."""
    total = counts.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n"))
    bound = F.greatest(F.lit(min_rows), F.floor(total.scalar() / max_keys))
    often = counts.where(F.col(key).isNotNull() & (F.col("n_rows") > bound))
    return often.select(key, F.ceil(F.col("n_rows") / bound).cast("int").alias("n_salts"))


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    counts: DataFrame | None = None,
    min_rows: int = HEAVY_ROWS,
    max_keys: int = MAX_HEAVY_KEYS,
) -> DataFrame:
    """Left join; rows of heavy keys are dealt over as many tasks as they fill, all others by key alone.

    Rows without a key, which match nothing, are dealt out by their hash. The lookup row of a heavy
    key is repeated once per salt, so the join stays exact. The salt is a hash of the whole row and
    thus the same when a lost task is run again. ``counts`` (``key, n_rows``) saves counting the keys,
    where a caller has them; counting combines on the map side.
    """
    if counts is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("n_rows"))
    heavy = F.broadcast(heavy_keys(counts, key, min_rows, max_keys))
    spread = F.xxhash64(*rows.columns)
    dealt = rows.join(heavy, key, "left").withColumn(
        "_salt",
        F.when(F.col(key).isNull(), spread).when(F.col("n_salts").isNotNull(), F.pmod(spread, F.col("n_salts"))).otherwise(0),
    )
    every_salt = F.when(F.col("n_salts").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("n_salts").cast("long") - 1))
    repeated = lookup.join(heavy, key, "left").withColumn(
        "_salt", F.explode(F.coalesce(every_salt, F.array(F.lit(0).cast("long"))))
    )
    joined = dealt.drop("n_salts").join(repeated.drop("n_salts"), [key, "_salt"], "left")
    payload = [c for c in lookup.columns if c != key]
    return joined.select(*rows.columns, *payload)
