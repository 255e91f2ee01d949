"""The difference by digests against the plain one."""

import random

import pytest
from pyspark.sql import functions as F

from rollbook.operators import digests, keyed
from tests.conftest import as_set

SCHEMA = "cr_no string, name_zh string, name_en string, address_raw string, note string"


def days(seed, n=600, changes=4):
    draw = random.Random(seed)
    some = lambda: draw.choice([None, "", "x", "y"])
    old = [(f"{k:08d}" if k else None, some(), f"n{k}", some(), "old") for k in range(n)] + [("00000007", "z", "twice", "z", "old")] * 2
    new = [(*r[:4], "new") for r in old]
    for k in draw.sample(range(n), changes):
        new[k] = (*new[k][:2], new[k][2] + "!", *new[k][3:])
    del new[50]
    return old, [*new, ("added", None, "a", "b", "new"), new[3]]


@pytest.mark.parametrize("null_safe", [False, True])
def test_delta_is_that_of_the_join(spark, tmp_path, null_safe):
    old, new = (spark.createDataFrame(d, SCHEMA) for d in days(1))
    for name, day in (("old", old), ("new", new)):
        digests.write_ranged(day, f"{tmp_path}/{name}")
    got = digests.ranged_delta(spark, f"{tmp_path}/new", f"{tmp_path}/old", null_safe=null_safe, carry=["note"])
    want = keyed.snapshot_delta(new, old, null_safe=null_safe, carry=["note"])
    assert got.columns == want.columns and as_set(got) == as_set(want) and want.count() >= 5


def test_unchanged_ranges_are_not_read(spark, tmp_path):
    old, new = (spark.createDataFrame(d, SCHEMA) for d in days(2))
    for name, day in (("old", old), ("new", new)):
        digests.write_ranged(day, f"{tmp_path}/{name}")
    parts = digests.changed_parts(*[spark.read.parquet(f"{tmp_path}/{n}/digest") for n in ("new", "old")], null_safe=True)
    touched = parts.count()
    assert 0 < touched <= 8
    got = digests.ranged_delta(spark, f"{tmp_path}/new", f"{tmp_path}/old", null_safe=True)
    plan = got._jdf.queryExecution().executedPlan().treeString()
    assert "PartitionFilters: [_range" in plan and "PartitionFilters: []" not in plan
    rows = spark.read.parquet(f"{tmp_path}/new/rows")
    ranges = {r[0] for r in parts.select("_range").distinct().collect()}
    every = {f.rsplit("_range=", 1)[1][:2] for f in rows.inputFiles()}
    assert len(ranges) < 10 < len(every)


def test_equal_days_and_other_columns(spark, tmp_path):
    old = spark.createDataFrame(days(3)[0], SCHEMA)
    for name in ("a", "b"):
        digests.write_ranged(old, f"{tmp_path}/{name}")
    digests.write_ranged(old.drop("address_raw"), f"{tmp_path}/narrow")
    assert digests.ranged_delta(spark, f"{tmp_path}/a", f"{tmp_path}/b", null_safe=True).isEmpty()
    got = digests.ranged_delta(spark, f"{tmp_path}/a", f"{tmp_path}/narrow", null_safe=True)
    assert as_set(got) == as_set(keyed.snapshot_delta(old, old.drop("address_raw"), null_safe=True))
    # Null and empty text, and a value moved from one column to the next, are different rows.
    swapped = old.withColumn("name_zh", F.when(F.col("name_zh") == "", None).otherwise(F.col("name_zh")))
    digests.write_ranged(swapped, f"{tmp_path}/swapped")
    got = digests.ranged_delta(spark, f"{tmp_path}/swapped", f"{tmp_path}/a", null_safe=True)
    assert as_set(got) == as_set(keyed.snapshot_delta(swapped, old, null_safe=True)) and not got.isEmpty()
