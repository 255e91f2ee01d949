"""Bucketed tables: the rows of the plain operators, and plans without a shuffle of the table."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook.operators import keyed
from rollbook.sources.bucketed import BucketedTable
from tests.conftest import as_set

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("cr_no", "name_zh", "name_en", "address_raw")])


def rows(seed, n, low=0):
    draw = random.Random(seed)
    some = lambda: draw.choice([None, "", "x", "y"])
    return [(f"{k:05d}", some(), some(), some()) for k in range(low, low + n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange ")


def shuffles_of_tables(df):
    """Exchanges above a table's scan in the plan, which is indented by depth."""
    above, found = [], 0
    for line in plan(df).splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        above = [(d, text) for d, text in above if d < depth] + [(depth, line)]
        if "FileScan" in line:
            found += sum("Exchange " in text for _, text in above)
    return found


@pytest.fixture
def unbroadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("buckets", [4, 16])
def test_upsert_and_update_leave_the_table_where_it_lies(spark, tmp_path, unbroadcast, buckets):
    base = spark.createDataFrame(rows(1, 300), SCHEMA)
    updates = spark.createDataFrame(rows(2, 80, 260) + rows(3, 5) + [(None, "no", "key", "")] + [("00009", "many", "copies", str(i)) for i in range(90)], SCHEMA)
    table = BucketedTable(spark, str(tmp_path), SCHEMA, "cr_no", buckets)
    assert as_set(table.write(base)) == as_set(base)
    assert shuffles_of_tables(keyed.upsert(table.read().repartition(3), updates, "cr_no")) > 0
    for merged in (table.merged(updates), table.updated(updates)):
        assert shuffles_of_tables(merged) == 0 and plan(merged).count("SortMergeJoin") == 1
    want = as_set(keyed.upsert(base, updates, "cr_no"))
    assert as_set(table.upsert(updates)) == want
    assert len(table.read().inputFiles()) <= buckets
    changed = updates.withColumn("name_en", F.lit("changed"))
    want = as_set(keyed.update_by_key(spark.createDataFrame(want, SCHEMA), changed, "cr_no", ["name_en"]))
    assert as_set(table.update(changed, ["name_en"])) == want
    assert table.latest() == 2 and shuffles(table.read().groupBy("cr_no").count()) == 0


@pytest.mark.parametrize("null_safe", [False, True])
def test_delta_without_a_shuffle(spark, tmp_path, unbroadcast, null_safe):
    old = rows(4, 200) + [("00007", "z", "twice", None)] * 2 + [(None, "a", None, "b")] * 3
    new = [(*r[:3], "moved") if i % 40 == 0 else r for i, r in enumerate(old)] + rows(5, 10, 500) + [(None, "a", "c", "b")]
    days = {}
    for name, data in (("old", old), ("new", new)):
        days[name] = BucketedTable(spark, f"{tmp_path}/{name}", SCHEMA, "cr_no", 8)
        days[name].write(spark.createDataFrame(data, SCHEMA))
    got = days["old"].delta(days["new"].read(), null_safe=null_safe)
    want = keyed.snapshot_delta(spark.createDataFrame(new, SCHEMA), spark.createDataFrame(old, SCHEMA), null_safe=null_safe)
    assert as_set(got) == as_set(want) and want.count() > 10
    keyed_part = keyed.keyed_delta(days["new"].read(), days["old"].read())
    assert shuffles(keyed_part) == 0 and "SortMergeJoin" in plan(keyed_part)


def test_another_session_knows_the_buckets(spark, tmp_path, unbroadcast):
    table = BucketedTable(spark, str(tmp_path), SCHEMA, "cr_no", 8)
    assert table.read().count() == 0
    table.write(spark.createDataFrame(rows(6, 50), SCHEMA))
    spark.sql(f"DROP TABLE {table._name(table._path(0))}")
    again = BucketedTable(spark, str(tmp_path), SCHEMA, "cr_no", 8)
    assert again.read().count() == 50 and shuffles(again.read().groupBy("cr_no").count()) == 0
    with pytest.raises(ValueError):
        BucketedTable(spark, str(tmp_path), SCHEMA, "other", 8)
