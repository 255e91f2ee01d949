import json

from pyspark.sql import functions as F

from rollbook.operators import geocode, skew
from tests.conftest import as_set


def answer(score=85, block="ChiPremisesAddress", **changes):
    premises = {
        "GeoAddress": "G123",
        block: {
            "ChiRegion": "九龍", "EngRegion": "KLN",
            "ChiDistrictBlock": {"ChiDistrict": "深水埗區"},
            "StreetBlock": {"ChiStreetName": "大埔道"},
            "BuildingBlock": {"ChiBuildingName": "", "EngBuildingName": "TOWER"},
        },
        "GeospatialInformation": {"Latitude": "22.5", "Longitude": 114},
    }
    premises.update(changes)
    return {"SuggestedAddress": [{"Address": {"PremisesAddress": premises}, "ValidationInformation": {"Score": score}}]}


EMPTY = {
    "geo_address": None, "score": 0.0, "region": None, "district": None, "street_name": None,
    "building_name": None, "latitude": None, "longitude": None,
}


def parse(spark, *bodies):
    texts = [b if b is None or isinstance(b, str) else json.dumps(b, ensure_ascii=False) for b in bodies]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, als_json string")
    return [r.asDict() for r in geocode.parse_answers(df).orderBy("i").drop("i", "als_json").collect()]


def test_fields(spark):
    got, low, as_text = parse(spark, answer(90), answer(50), answer("72.5"))
    assert got == {
        "geo_address": "G123", "score": 90.0, "region": "九龍", "district": "深水埗區",
        "street_name": "大埔道", "building_name": "TOWER", "latitude": 22.5, "longitude": 114.0,
    }
    assert (low["score"], as_text["score"]) == (50.0, 72.5)


def test_empty_records(spark):
    wrong = answer()
    wrong["SuggestedAddress"][0]["Address"] = "text"
    bodies = [{"SuggestedAddress": []}, {}, [], None, "{bad", '"x"', {"SuggestedAddress": {"a": 1}},
              answer("high"), answer({"a": 1}), wrong, answer(StreetBlock=1, ChiPremisesAddress=5)]
    assert parse(spark, *bodies) == [EMPTY] * len(bodies)


def test_blocks(spark):
    english, both, bare, no_score = parse(
        spark,
        answer(block="EngPremisesAddress"),
        answer(EngPremisesAddress={"EngRegion": "other"}, ChiPremisesAddress={}),
        {"SuggestedAddress": [{}, {"Address": {}}]},
        {"SuggestedAddress": [{"Address": {"PremisesAddress": {"GeoAddress": "G"}}}]},
    )
    assert english["region"] == "九龍"
    assert both["region"] is None  # the zh block counts when it is there, even empty
    assert bare == EMPTY
    assert (no_score["geo_address"], no_score["score"]) == ("G", 0.0)


def test_first_suggestion_counts(spark):
    two = answer(90)
    two["SuggestedAddress"].append(answer(10)["SuggestedAddress"][0])
    assert parse(spark, two)[0]["score"] == 90.0


def test_review_is_below_the_threshold(spark):
    df = spark.createDataFrame([(69.9,), (70.0,)], "score double")
    assert [r[0] for r in df.select(geocode.needs_review(F.col("score"))).collect()] == [True, False]


def test_lookup_join_equals_left_join_with_heavy_and_null_keys(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("key"),
        "id",
    )
    lookup = spark.range(300).select(F.concat(F.lit("k"), F.col("id")).alias("key"), F.col("id").alias("value"))
    lookup = lookup.unionByName(spark.createDataFrame([("hot", -1)], "key string, value bigint"))
    want = as_set(rows.join(lookup, "key", "left"))
    assert as_set(skew.lookup_join(rows, lookup, "key")) == want
    for least, most in ((3, 5), (500, 1), (3, 1000)):
        got = skew.lookup_join(rows, lookup, "key", min_rows=least, max_keys=most)
        assert as_set(got) == want


def test_heavy_rows_are_spread(spark):
    rows = spark.range(2000).select(F.lit("hot").alias("key"), "id")
    lookup = spark.createDataFrame([("hot", 1)], "key string, value int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.lookup_join(rows, lookup, "key", min_rows=60)
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 1000


def test_cache_hit_and_miss(spark):
    rows = spark.createDataFrame([("旺角道1號",), ("旺角道1號",), ("沙田2號",), ("",), (None,)], "address_clean string")
    addresses = geocode.distinct_addresses(rows)
    assert as_set(addresses.select("address_clean", "n_rows")) == [("旺角道1號", 2), ("沙田2號", 1)]
    cache = geocode.cache_rows(addresses.where("n_rows = 2").withColumn("als_json", F.lit(json.dumps(answer(60)))))
    assert cache.select("score", "manual_review", "region").first()[:] == (60.0, True, "九龍")
    assert geocode.cache_stats(geocode.probe_cache(addresses, cache)).first()[:] == (2, 1, 1)
    assert [r["address_clean"] for r in geocode.cache_misses(addresses, cache).collect()] == ["沙田2號"]
    assert [r["address_clean"] for r in geocode.cache_hits(addresses, cache).collect()] == ["旺角道1號"]
