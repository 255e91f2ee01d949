"""Substring search through an index of trigrams.

``write_index`` stores rows in shards by ranges of the searched text, each row with its place in the shard, and
for every three characters in a row the list of places that have them, in pieces of one block of rows. A search
reads the lists of the pattern's trigrams, intersects them from the rarest on, and looks for the pattern only in
the rows that are left, in the shards that hold them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.sources.scratch import staged

GRAM = 3
SHARDS = 128
#: Rows of a block: the most places that one piece of a list holds.
BLOCK = 4096
#: Lists longer than the rarest by more than this factor are left out: to look at the rows costs less.
LONGER = 16
#: If the rarest list has more than this part of all rows, the rows are scanned.
SCAN_PART = 0.1
_PLACE = ("_shard", "_row")


def trigrams(text: Column) -> Column:
    """Distinct windows of three characters (code points); none in shorter texts, null of null."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit("(?s)(?=(...))."), F.lit(1)))


def write_index(df: DataFrame, path: str, column: str, shards: int = SHARDS) -> None:
    """Store ``df`` and the trigram lists of ``column`` under ``path``, which must not be there yet.

    Equal texts, however many, are dealt over shards by where they stood. Null texts are stored and never found;
    repeated rows are rows of their own. Columns named ``_shard`` or ``_row`` are an error.
    """
    if set(_PLACE) & set(df.columns):
        raise ValueError(f"{' and '.join(_PLACE)} are names of the index")
    spark = df.sparkSession
    # After the shuffle an id is the number of the partition in its high bits and the place in it below.
    numbered = df.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(shards, F.col(column), F.col("_row"))
    placed = numbered.withColumns(
        {"_shard": F.spark_partition_id(), "_row": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}
    )
    placed.write.mode("errorifexists").partitionBy("_shard").parquet(f"{path}/rows")
    placed.limit(0).write.mode("errorifexists").parquet(f"{path}/columns")  # rows in folders have none if there are no rows
    grams = _rows(spark, path).select("_shard", "_row", F.explode(trigrams(F.col(column))).alias("gram"))
    lists = grams.groupBy("gram", "_shard", F.floor(F.col("_row") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list((F.col("_row") % BLOCK).cast("int"))).alias("places"), F.count("*").alias("n")
    )
    # Sorted by trigram: a search skips the row groups of all others. A frequent one spreads over files by shard.
    ranged = lists.repartitionByRange("gram", "_shard", "block").sortWithinPartitions("gram", "_shard", "block")
    ranged.write.mode("errorifexists").parquet(f"{path}/lists")


def _rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/rows")


def _windows(pattern: str) -> list[str]:
    return sorted({pattern[i : i + GRAM] for i in range(len(pattern) - GRAM + 1)})


def list_sizes(spark: SparkSession, path: str, pattern: str) -> dict[str, int]:
    """Rows that have each trigram of the pattern; as many entries as it has trigrams that occur."""
    lists = spark.read.parquet(f"{path}/lists").where(F.col("gram").isin(_windows(pattern)))
    return {r["gram"]: r["n"] for r in lists.groupBy("gram").agg(F.sum("n").alias("n")).collect()}


def _candidates(spark: SparkSession, path: str, chosen: list[str]) -> DataFrame:
    """``_shard, _row`` of the rows that have all the chosen trigrams, which come rarest first."""
    lists = spark.read.parquet(f"{path}/lists").where(F.col("gram").isin(chosen))
    rank = F.array_position(F.array(*map(F.lit, chosen)), F.col("gram"))
    # A group is one block: at most a piece of each chosen list.
    met = lists.groupBy("_shard", "block").agg(F.sort_array(F.collect_list(F.struct(rank.alias("rank"), "places"))).alias("found"))
    met = met.where(F.size("found") == len(chosen))
    common = reduce(F.array_intersect, [F.col("found")[i]["places"] for i in range(len(chosen))])
    return met.select("_shard", "block", F.explode(common).alias("place")).select("_shard", (F.col("block") * BLOCK + F.col("place")).alias("_row"))


def listed_rows(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """The indexed rows that may hold the pattern: read from the shards that the lists name, and no others.

    A pattern of fewer than three characters has no list, and one whose rarest trigram is in a large part of the
    rows gains nothing from it: all rows are given then.
    """
    rows = _rows(spark, path)
    grams = _windows(pattern)
    if not grams:
        return rows
    sizes = list_sizes(spark, path, pattern)
    if len(sizes) < len(grams):
        return rows.where(F.lit(False))
    rarest = min(sizes.values())
    if rarest > SCAN_PART * rows.count():
        return rows
    chosen = [g for g in sorted(grams, key=lambda g: (sizes[g], g)) if sizes[g] <= LONGER * rarest]
    found = staged(_candidates(spark, path, chosen), "trigrams")
    shards = [r["_shard"] for r in found.select("_shard").distinct().collect()]  # at most the shards of the index
    return rows.where(F.col("_shard").isin(shards)).join(found, [*_PLACE], "left_semi").select(*rows.columns)


def search(spark: SparkSession, path: str, pattern: str, column: str) -> DataFrame:
    """The indexed rows whose ``column`` holds the pattern, case and all: those that ``contains`` finds."""
    return listed_rows(spark, path, pattern).where(F.contains(F.col(column), F.lit(pattern))).drop(*_PLACE)
