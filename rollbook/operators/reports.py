"""Reports over the master table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.keys import one_decimal_text, percent_text


def master_summary(master: DataFrame, cache: DataFrame) -> DataFrame:
    """One row: sizes, rows to review, share not to review, average of the positive confidences.

    Both tables are counted into partial rows and added up; nothing is joined.
    """
    positive = F.when(F.col("confidence") > 0, F.col("confidence"))
    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    of_master = master.agg(
        F.count("*").alias("total"),
        F.count_if("manual_review").alias("review"),
        F.coalesce(F.sum(positive), none).alias("conf_sum"),
        F.count(positive).alias("conf_n"),
        zero.alias("cache_n"),
    )
    of_cache = cache.agg(
        zero.alias("total"), zero.alias("review"), none.alias("conf_sum"), zero.alias("conf_n"),
        F.count("*").alias("cache_n"),
    )
    sums = of_master.unionByName(of_cache).agg(
        *[F.sum(c).alias(c) for c in ("total", "review", "conf_sum", "conf_n", "cache_n")]
    )
    rate = 1 - F.try_divide("review", "total")
    average = F.coalesce(F.try_divide("conf_sum", "conf_n"), F.lit(0.0))
    return sums.select(
        F.col("total").alias("master_total"),
        F.col("review").alias("manual_review"),
        F.col("cache_n").alias("cache_size"),
        rate.alias("hit_rate"),
        average.alias("avg_confidence"),
        F.coalesce(percent_text(rate), F.lit("N/A")).alias("hit_rate_text"),
        one_decimal_text(average).alias("avg_confidence_text"),
    )


def district_counts(master: DataFrame) -> DataFrame:
    """Companies by region and district, most first."""
    counts = master.groupBy("region", "district").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "region", "district")


def district_review(master: DataFrame) -> DataFrame:
    """Companies, rows to review and their share by region and district."""
    counts = master.groupBy("region", "district").agg(
        F.count("*").alias("n"), F.count_if("manual_review").alias("n_review")
    )
    return counts.withColumn("review_share", F.col("n_review") / F.col("n"))


def review_queue(master: DataFrame, n: int = 20) -> DataFrame:
    """Rows whose address is to be reviewed, least confident first."""
    return (
        master.where("manual_review")
        .select("cr_no", "name_zh", "address_raw", "confidence")
        .orderBy(F.asc_nulls_last("confidence"), "cr_no")
        .limit(n)
    )


def tag_review_queue(master: DataFrame, n: int = 20) -> DataFrame:
    """Rows whose tag is to be reviewed, least confident first."""
    return (
        master.where("industry_review")
        .select("cr_no", "name_zh", "industry_tag", "industry_conf")
        .orderBy(F.asc_nulls_last("industry_conf"), "cr_no")
        .limit(n)
    )


def name_search(master: DataFrame, text: str, column: str = "name_zh", n: int = 20) -> DataFrame:
    """Companies whose name holds the text, first ``n`` by key."""
    found = master.where(F.contains(F.col(column), F.lit(text)))
    return found.select("cr_no", "name_zh", "name_en", "address_raw", "district").orderBy("cr_no").limit(n)


def in_district(master: DataFrame, district: str, columns: Sequence[str] | None = None) -> DataFrame:
    return _slice(master.where(F.col("district") == district), columns)


def with_coordinates(master: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _slice(master.where(F.col("latitude").isNotNull()), columns)


def reviewed_only(master: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _slice(master.where(~F.col("manual_review")), columns)


def _slice(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    return df if columns is None else df.select(*columns)
