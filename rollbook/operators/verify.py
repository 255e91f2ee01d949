"""Re-verification: refreshed records against stored ones, and what follows from a change."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.keys import same_text
from rollbook.functions.text import strip_blanks
from rollbook.operators.keyed import set_where_key

COMPARED = ("name_zh", "name_en", "address_raw")
OUTCOMES = ("new", "updated", "unchanged", "gone", "error")

# Emptied in a master row whose company changed, until it is geocoded again.
DERIVED = (
    "address_clean", "geo_address", "region", "district", "street_name", "building_name",
    "latitude", "longitude",
)


def classify(responses: DataFrame, raw: DataFrame) -> DataFrame:
    """``cr_no``, the three compared fields (trimmed, never null) and ``outcome``.

    ``responses`` has ``cr_no, outcome_http, name_zh, name_en, address_raw``, one row per key asked
    for; ``outcome_http`` is ``ok``, ``gone`` (no record any more) or ``error``.
    """
    stored = raw.select(
        "cr_no", F.lit(True).alias("_stored"), *[F.col(c).alias(f"_was_{c}") for c in COMPARED]
    )
    unchanged = F.lit(True)
    for column in COMPARED:
        unchanged = unchanged & same_text(F.col(column), F.col(f"_was_{column}"))
    outcome = (
        F.when(F.col("outcome_http") == "gone", "gone")
        .when(F.coalesce(F.col("outcome_http"), F.lit("error")) != "ok", "error")
        .when(F.col("_stored").isNull(), "new")
        .when(unchanged, "unchanged")
        .otherwise("updated")
    )
    return responses.join(stored, "cr_no", "left").select(
        "cr_no", *[strip_blanks(F.col(c)).alias(c) for c in COMPARED], outcome.alias("outcome")
    )


def raw_changes(classified: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """New and changed records, to be upserted into the raw table with all their columns."""
    moment = now if isinstance(now, Column) else F.lit(now)
    changed = classified.where(F.col("outcome").isin("new", "updated"))
    return changed.select("cr_no", *COMPARED, moment.cast("timestamp").alias("fetched_at"))


def cascade_reset(master: DataFrame, classified: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """Master rows of updated companies take the new address and lose what was derived from the old."""
    moment = now if isinstance(now, Column) else F.lit(now)
    updated = classified.where(F.col("outcome") == "updated").select(
        "cr_no", F.col("address_raw").alias("_address")
    )
    values = {c: F.lit(None).cast(master.schema[c].dataType) for c in DERIVED}
    values |= {
        "address_raw": F.col("_address"),
        "confidence": F.lit(0.0),
        "manual_review": F.lit(True),
        "last_updated": moment.cast(master.schema["last_updated"].dataType),
    }
    return set_where_key(master, updated, "cr_no", values)


def touch_queue(queue: DataFrame, classified: DataFrame, now: dt.datetime | Column) -> DataFrame:
    """New ``queried_at`` for the keys found updated or unchanged."""
    moment = now if isinstance(now, Column) else F.lit(now)
    seen = classified.where(F.col("outcome").isin("updated", "unchanged"))
    keys = seen.select(F.col("cr_no").alias("brn"))
    return set_where_key(
        queue, keys, "brn", {"queried_at": moment.cast(queue.schema["queried_at"].dataType)}
    )


def verify_stats(classified: DataFrame) -> DataFrame:
    """One row: number of keys by outcome, each outcome counted on its own."""
    return classified.agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES])
