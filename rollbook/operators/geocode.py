"""Resolving each distinct cleaned address once, and giving the result to every row."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions import fixed_values as fv
from rollbook.functions.geojson import geocode_document, geocode_fields
from rollbook.functions.keys import text_hash
from rollbook.functions.text import clean_address
from rollbook.operators.columns import conform
from rollbook.operators.skew import HEAVY_ROWS, lookup_join


def needs_review(score: Column, threshold: float = fv.GEOCODE_REVIEW_BELOW) -> Column:
    return score < F.lit(threshold)


def with_clean_address(df: DataFrame, **cleaning) -> DataFrame:
    """Adds ``address_clean`` and its hash (null hash where nothing is left of the address)."""
    cleaned = df.withColumn("address_clean", clean_address(F.col("address_raw"), **cleaning))
    filled = F.col("address_clean") != ""
    return cleaned.withColumn("address_hash", F.when(filled, text_hash(F.col("address_clean"))))


def distinct_addresses(df: DataFrame) -> DataFrame:
    """Each non-empty cleaned address once, with its hash and number of rows.

    Empty addresses are dropped after the grouping, by a count: a filter on the cleaned text itself
    would be pushed below it and have every row cleaned twice.
    """
    counted = df.groupBy("address_clean").agg(F.count_if(F.col("address_clean") != "").alias("n_rows"))
    return counted.where(F.col("n_rows") > 0).select(
        text_hash(F.col("address_clean")).alias("address_hash"), "address_clean", "n_rows"
    )


def probe_cache(addresses: DataFrame, cache: DataFrame) -> DataFrame:
    """Adds ``cached``: whether the address has a stored result."""
    stored = cache.select("address_hash", F.lit(True).alias("cached"))
    probed = addresses.join(stored, "address_hash", "left")
    return probed.withColumn("cached", F.coalesce("cached", F.lit(False)))


def cache_misses(addresses: DataFrame, cache: DataFrame) -> DataFrame:
    return addresses.join(cache.select("address_hash"), "address_hash", "left_anti")


def cache_hits(addresses: DataFrame, cache: DataFrame) -> DataFrame:
    return addresses.join(cache.select("address_hash"), "address_hash", "left_semi")


def cache_stats(probed: DataFrame) -> DataFrame:
    return probed.agg(
        F.count("*").alias("distinct_addresses"),
        F.count_if("cached").alias("hits"),
        F.count_if(~F.col("cached")).alias("misses"),
    )


def parse_answers(responses: DataFrame, column: str = "als_json") -> DataFrame:
    """Adds the eight address fields of landed geocoder answers. Each text is parsed once."""
    others = responses.columns
    parsed = responses.withColumn("_doc", geocode_document(F.col(column)))
    return parsed.select(*others, geocode_fields(F.col("_doc")).alias("_geo")).select(*others, "_geo.*")


def cache_rows(
    responses: DataFrame,
    run_ts: dt.datetime | Column | None = None,
    threshold: float = fv.GEOCODE_REVIEW_BELOW,
) -> DataFrame:
    """Cache rows of landed responses ``address_hash, address_clean, als_json``."""
    parsed = parse_answers(responses.select("address_hash", "address_clean", "als_json"))
    stamped = parsed.withColumn("manual_review", needs_review(F.col("score"), threshold)).withColumn(
        "fetched_at", run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    )
    return conform(stamped, schemas.ADDRESS_CACHE)


RESULT_COLUMNS = (
    "geo_address", "region", "district", "street_name", "building_name",
    "latitude", "longitude", "score", "manual_review",
)


def attach_geocode(
    rows: DataFrame,
    results: DataFrame,
    addresses: DataFrame | None = None,
    min_rows: int = HEAVY_ROWS,
    **salting,
) -> DataFrame:
    """Every row with the result of its address, duplicates included.

    Rows with an empty or unresolved address get score 0 and are marked for review. An address
    shared by very many rows is spread over many tasks; ``addresses``, the distinct addresses of the
    rows with their counts, saves counting them again.
    """
    looked_up = lookup_join(
        rows,
        results.select("address_hash", *RESULT_COLUMNS),
        "address_hash",
        None if addresses is None else addresses.select("address_hash", "n_rows"),
        min_rows,
        **salting,
    )
    return looked_up.withColumn("score", F.coalesce("score", F.lit(0.0))).withColumn(
        "manual_review", F.coalesce("manual_review", F.lit(True))
    )


def build_master(rows: DataFrame, run_ts: dt.datetime | Column | None) -> DataFrame:
    """Master rows of geocoded registry rows; the score becomes the confidence."""
    named = rows.withColumn("confidence", F.col("score")).withColumn(
        "last_updated", run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    )
    return conform(named, schemas.MASTER)
