"""Substring search by index against ``contains``."""

import random
import re

import pytest
from pyspark.sql import functions as F

from rollbook.operators import trigrams
from tests.conftest import as_set

WORDS = ["TRADING", "MEGA", "九龍汪角", "🎉🎉🎉x", "50%_off", "Limited", "limited", "a\nb", ".*["]


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    draw = random.Random(5)
    rows = [(str(i), " ".join(draw.choices(WORDS, k=3)) + f" {draw.randrange(900)}") for i in range(3000)]
    rows += [(None, "RARE GEM"), ("x", None), ("y", ""), ("z", "ab")] + [("same", "ONE NAME OF MANY")] * 150
    frame = spark.createDataFrame(rows, "cr_no string, name string")
    path = str(tmp_path_factory.mktemp("index"))
    trigrams.write_index(frame.repartition(7), path, "name", shards=12)
    return frame, path


@pytest.mark.parametrize(
    "pattern",
    ["", "a", "9", "ab", "RARE", "RARE GEM", "ONE NAME OF MANY", "TRADING MEGA 77", "龍汪角", "🎉🎉x", "🎉🎉🎉x 5", "%_o", "a\nb 1",
     ".*[ 3", "limited limited limited 1", "no such text", "ING", " 899"],
)
def test_search_finds_what_contains_finds(spark, indexed, pattern):
    frame, path = indexed
    want = frame.where(F.contains("name", F.lit(pattern)))
    assert as_set(trigrams.search(spark, path, pattern, "name")) == as_set(want)


def test_only_listed_shards_and_rows_are_read(spark, indexed):
    frame, path = indexed
    everything = len(spark.read.parquet(f"{path}/rows").inputFiles())
    listed = trigrams.listed_rows(spark, path, "RARE GEM")
    assert listed.count() == 1 and everything == 12
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*_shard#\d+ = \d+", plan)


def test_equal_texts_are_dealt_over_shards(spark, tmp_path):
    frame = spark.range(1200).select(F.col("id").cast("string").alias("cr_no"), F.lit("SAME NAME").alias("name"))
    trigrams.write_index(frame, str(tmp_path), "name", shards=6)
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/rows").groupBy("_shard").count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 600
    assert trigrams.search(spark, str(tmp_path), "E NAM", "name").count() == 1200


def test_empty_table_and_clashing_names(spark, tmp_path):
    empty = spark.createDataFrame([], "cr_no string, name string, gram string, places string")
    trigrams.write_index(empty, f"{tmp_path}/e", "name", shards=3)
    assert trigrams.search(spark, f"{tmp_path}/e", "abcd", "name").columns == empty.columns
    assert trigrams.search(spark, f"{tmp_path}/e", "abcd", "name").count() == 0
    clash = spark.createDataFrame([("abcd", "k", "l", 1)], "name string, gram string, block string, n int")
    trigrams.write_index(clash, f"{tmp_path}/c", "name", shards=3)
    assert as_set(trigrams.search(spark, f"{tmp_path}/c", "bcd", "name")) == [("abcd", "k", "l", 1)]
    with pytest.raises(ValueError):
        trigrams.write_index(clash.withColumn("_row", F.lit(1)), f"{tmp_path}/x", "name")
