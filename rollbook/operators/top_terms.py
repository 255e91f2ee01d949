"""The most frequent terms of many days, kept up to date day by day.

A day's counts are stored sorted by count, with its greatest counts as a small table beside them. The least count
of such a table bounds what the day has of any term outside it, so the small tables of all days give every term a
lower and an upper bound. Terms whose upper bound reaches the n-th greatest lower bound are counted exactly. Where
the bounds are too wide to tell (a term in no small table could be among the first n), a second pass reads each
day's counts down to an even share of that bound first; what is below the share on every day cannot reach it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.operators import mining
from rollbook.sources.paths import folder_names, is_complete
from rollbook.sources.scratch import staged

#: Terms of a day's small table.
SIZE = 2_000
_COUNTS = "term string, n bigint, day string"
_TOP = "term string, n bigint, whole boolean, day string"


def write_day(counts: DataFrame, base: str, day: str, size: int = SIZE) -> None:
    """Store a day's ``term, n`` (a row per term). A day that is there already is an error; one that a lost job
    left unfinished is written anew. Null terms are left out."""
    spark = counts.sparkSession
    if is_complete(spark, f"{base}/top/day={day}"):
        raise ValueError(f"day {day} is there already")
    path = f"{base}/counts/day={day}"
    rows = counts.where(F.col("term").isNotNull()).select("term", F.col("n").cast("bigint").alias("n"))
    rows.repartitionByRange(F.desc("n"), F.col("term")).sortWithinPartitions(F.desc("n"), "term").write.mode("overwrite").parquet(path)
    stored = spark.read.schema("term string, n bigint").parquet(path)
    whole = stored.count() <= size
    mining.top_terms(stored, size).withColumn("whole", F.lit(whole)).write.mode("overwrite").parquet(f"{base}/top/day={day}")


def stored_days(spark: SparkSession, base: str) -> list[str]:
    """Days whose small table is finished."""
    days = [name[4:] for name in folder_names(spark, f"{base}/top") if name.startswith("day=")]
    return sorted(day for day in days if is_complete(spark, f"{base}/top/day={day}"))


def _counts(spark: SparkSession, base: str, days: Sequence[str]) -> DataFrame:
    return spark.read.schema(_COUNTS).parquet(f"{base}/counts").where(F.col("day").isin(list(days)))


def _first_look(spark: SparkSession, base: str, days: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """The small tables' rows, and the most that a term outside them has on each day."""
    top = spark.read.schema(_TOP).parquet(f"{base}/top").where(F.col("day").isin(list(days)))
    rest = top.groupBy("day").agg(F.when(F.bool_and("whole"), 0).otherwise(F.min("n")).cast("bigint").alias("rest"))
    return top.select("term", "n", "day"), {day: 0 for day in days} | {r["day"]: r["rest"] for r in rest.collect()}


def _summed(spark: SparkSession, seen: DataFrame, rest: dict[str, int]) -> DataFrame:
    """Per seen term the sum of its counts, ``low``, and the most it can have in all, ``high``."""
    by_day = spark.createDataFrame(list(rest.items()), "day string, rest bigint")  # a row per day
    sums = seen.join(F.broadcast(by_day), "day").groupBy("term").agg(F.sum("n").alias("low"), F.sum("rest").alias("covered"))
    return staged(sums.select("term", "low", (F.col("low") + sum(rest.values()) - F.col("covered")).alias("high")), "terms")


def _border(sums: DataFrame, n: int) -> int:
    """The n-th greatest lower bound; 0 if there are fewer terms."""
    best = sums.orderBy(F.desc("low")).limit(n).agg(F.count("*").alias("terms"), F.min("low").alias("least")).first()
    return best["least"] if best["terms"] == n else 0


def second_pass_needed(spark: SparkSession, base: str, n: int, days: Sequence[str] | None = None) -> bool:
    """Whether a term that no small table holds could be among the ``n`` most frequent."""
    chosen = stored_days(spark, base) if days is None else list(days)
    seen, rest = _first_look(spark, base, chosen)
    return 0 < sum(rest.values()) >= _border(_summed(spark, seen, rest), n)


def top_terms(spark: SparkSession, base: str, n: int = 200, days: Sequence[str] | None = None) -> DataFrame:
    """``term, n``: the most frequent terms of the days (all that are stored), equal counts in term order; the
    rows that counting everything would give."""
    chosen = stored_days(spark, base) if days is None else list(days)
    if not chosen or n < 1:
        return spark.createDataFrame([], "term string, n bigint")
    seen, rest = _first_look(spark, base, chosen)
    sums = _summed(spark, seen, rest)
    border = _border(sums, n)
    if 0 < sum(rest.values()) >= border:
        share = max(1, -(-border // len(chosen)))
        again = [day for day in chosen if rest[day] >= share]
        deeper = _counts(spark, base, again).where(F.col("n") >= share)
        seen = seen.where(~F.col("day").isin(again)).unionByName(deeper)
        rest = {day: share - 1 if day in again else most for day, most in rest.items()}
        sums = _summed(spark, seen, rest)
        border = _border(sums, n)
    if sum(rest.values()) == 0:
        return mining.top_terms(sums.select("term", F.col("low").alias("n")), n)
    hopeful = sums.where(F.col("high") >= border)
    # A term that every day's rows hold is counted already; the others are looked up.
    known = hopeful.where(F.col("high") == F.col("low")).select("term", F.col("low").alias("n"))
    unsure = hopeful.where(F.col("high") > F.col("low")).select("term")
    looked_up = _counts(spark, base, chosen).join(unsure, "term", "left_semi").groupBy("term").agg(F.sum("n").alias("n"))
    return mining.top_terms(known.unionByName(looked_up), n)
