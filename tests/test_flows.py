import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.keys import text_hash
from rollbook.functions.text import clean_address
from rollbook.operators import columns, scan
from rollbook.plans import registry as flows
from rollbook.sources import rules as rule_source
from rollbook.streaming import ingest
from tests.conftest import as_set
from tests.test_geocode import answer

DAY1, DAY2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
FOUR = "cr_no string, name_zh string, name_en string, address_raw string"
COMPANIES = [
    ("1", "大新銀行", None, "九龍旺角彌敦道1號"), ("2", "海景", "HARBOUR Trading", "九龍旺角彌敦道1號, 香港特區"),
    ("3", None, "X", "沙田2號"), ("4", None, "Y", None), ("5", "五", "Z", "沒有答案"),
]


def answers(df, score=85):
    h = text_hash(clean_address(F.col("address_raw"))).alias("address_hash")
    known = df.where("coalesce(address_raw, '') NOT IN ('', '沒有答案')")
    return known.select(h, F.lit(json.dumps(answer(score), ensure_ascii=False)).alias("als_json"))


@pytest.fixture
def registry(spark, tmp_path):
    return flows.Registry.at(spark, str(tmp_path / "registry"))


@pytest.fixture
def day1(rows):
    return rows(COMPANIES, FOUR)


def master(registry, *names):
    return as_set(registry.master.read().select("cr_no", *names))


def test_full_refresh(registry, day1):
    summary = flows.full_refresh(registry, day1, answers(day1), DAY1).first()
    assert (summary["master_total"], summary["manual_review"], summary["cache_size"]) == (5, 2, 2)
    assert master(registry, "address_clean", "confidence", "manual_review") == [
        ("1", "九龍旺角彌敦道1號", 85.0, False), ("2", "九龍旺角彌敦道1號", 85.0, False), ("3", "沙田2號", 85.0, False),
        ("4", "", 0.0, True), ("5", "沒有答案", 0.0, True),
    ]
    # companies already there are not geocoded again
    flows.full_refresh(registry, day1, answers(day1, 10), DAY2)
    assert {r[1] for r in master(registry, "last_updated")} == {DAY1}
    assert {r["fetched_at"] for r in registry.raw.read().collect()} == {DAY2}


def test_rows_of_one_file_are_cleaned_by_many_tasks(registry, spark):
    from rollbook.sources.paths import file_names, folder_names

    numbers = spark.range(0, 400, 1, 1).select(F.col("id").cast("string").alias("cr_no"))
    snapshot = numbers.select("cr_no", F.lit(None).cast("string").alias("name_zh"), F.lit("n").alias("name_en"), F.concat(F.lit("Flat "), "cr_no").alias("address_raw"))
    # Few rows would be put together into one task whatever the plan says.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        flows._geocode_into_master(registry, columns.normalise_columns(snapshot), answers(snapshot), DAY1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    staging = f"{registry.base}/staging"
    (folder,) = [n for n in folder_names(spark, staging) if n.startswith("cleaned-")]
    assert len([n for n in file_names(spark, f"{staging}/{folder}") if n.endswith(".parquet")]) > 4
    assert registry.master.read().count() == 400


def test_answers_of_the_queries_land_once(rows):
    from suite.flows import _answers

    days = rows([("1", "Flat 1"), ("2", "Flat 1"), ("3", None)], "cr_no string, address_raw string")
    told = _answers(days, days)
    files = told.inputFiles()
    assert files and all("hashes-" in f for f in files)
    assert {r["address_hash"] for r in told.collect()} <= {r["h"] for r in days.select(text_hash(clean_address(F.col("address_raw"))).alias("h")).collect()}


def test_delta_equals_full_for_changed_keys(registry, spark, tmp_path, day1, rows):
    day2 = rows([COMPANIES[0], ("2", "海景", "HARBOUR Trading", "沙田2號"), COMPANIES[2], ("6", None, None, "沙田2號")], FOUR)
    flows.full_refresh(registry, day1, answers(day1), DAY1)
    flows.delta_refresh(registry, day2, day1, answers(day2), DAY2)
    other = flows.Registry.at(spark, str(tmp_path / "other"))
    flows.full_refresh(other, day2, answers(day2), DAY2)
    changed = [r for r in master(registry, "address_clean", "geo_address", "last_updated") if r[3] == DAY2]
    assert [r[0] for r in changed] == ["2", "6"]
    assert set(changed) <= set(master(other, "address_clean", "geo_address", "last_updated"))


def test_pending_run_keeps_tags_and_snapshot_fields(registry, day1):
    snapshot = day1.withColumn("company_type", F.lit("private"))
    flows.full_refresh(registry, snapshot, answers(day1.where("cr_no = '1'")), DAY1)
    flows.tag_industries(registry, rule_source.keyword_frame(registry.spark, {"K": ["銀行"], "G": ["Trading"]}))
    flows.geocode_pending(registry, answers(day1), DAY2)
    got = {r["cr_no"]: r for r in registry.master.read().collect()}
    assert got["1"]["last_updated"] == DAY1 and got["3"]["last_updated"] == DAY2
    assert got["3"]["confidence"] == 85.0 and got["3"]["company_type"] == "private"
    assert got["1"]["industry_tag"] == "K" and got["1"]["industry_name_zh"] == "金融及保險業"


def test_verify(registry, day1, rows):
    flows.full_refresh(registry, day1, answers(day1), DAY1)
    registry.queue.write(day1.select(F.col("cr_no").alias("brn"), F.lit("hit").alias("status")))
    checked = rows(
        [("1", "ok", "大新銀行", "", "九龍旺角彌敦道1號"), ("2", "ok", "海景", "HARBOUR Trading", "沙田9號"), ("3", "gone", None, None, None), ("9", "ok", "n", "n", "n")],
        "cr_no string, outcome_http string, name_zh string, name_en string, address_raw string",
    )
    stats = flows.verify_hits(registry, checked, DAY2).first().asDict()
    assert stats == {"new": 1, "updated": 1, "unchanged": 1, "gone": 1, "error": 0}
    assert {r["cr_no"]: r["address_raw"] for r in registry.raw.read().collect()}["2"] == "沙田9號"
    assert [r["cr_no"] for r in registry.master.read().where("confidence = 0 AND geo_address IS NULL AND address_clean IS NULL").collect()] == ["2"]
    assert as_set(registry.queue.read().where("queried_at IS NOT NULL").select("brn")) == [("1",), ("2",)]
    assert [r["cr_no"] for r in registry.master.read().where("cr_no = '9'").collect()] == []


def test_scan_bookkeeping(registry, spark):
    log = spark.createDataFrame(
        [("b1", i, f"{i:08d}", "miss" if i < 3 else "hit", DAY1) for i in range(10)],
        "batch_id string, seq bigint, brn string, status string, queried_at timestamp",
    )
    stats, progress = flows.record_scan(registry, scan.numeric_candidates(spark, 0, 19), log, miss_limit=3)
    assert stats.first().asDict() == {"batch_id": "b1", "total": 3, "hit": 0, "miss": 3, "skipped": 0, "stopped_early": True}
    assert progress.select("pending", "hit", "miss").first()[:] == (17, 0, 3)


def test_codes(registry, spark):
    bodies = spark.createDataFrame([('[{"code":"01","name_en":"Crop","level":2}]',), ('{"data":[{"code":"01","name_en":"Crops","level":2}]}',)], "value string")
    assert flows.load_codes(registry, bodies).count() == 1
    with pytest.raises(ValueError):
        flows.load_codes(registry, spark.createDataFrame([("{}",)], "value string"))
    assert flows.load_codes(registry, builtin=True).count() == 20


def test_enrichment(spark, rows):
    names = rows([("1", "大新貿易", "Alpha Trading"), ("2", "東方貿易", "Beta Trading")], "cr_no string, name_zh string, name_en string")
    terms = flows.mine_terms(names, 1)
    assert as_set(terms) == [("en", "Trading", 2), ("zh", "貿易", 2)]
    rules = rule_source.keyword_frame(spark, {"G": ["行"]})
    labels = rows([("Trading", "g"), ("貿易", "G"), ("Other", "G")], "word string, code string")
    merged = flows.enrich_keywords(rules, terms, labels)
    assert as_set(merged) == [("G", 0, 0, "行"), ("G", 0, 1, "貿易"), ("G", 0, 2, "Trading")]


OUTCOME = "brn string, status string, queried_at timestamp, batch_id string, cr_no string, name_en string"


def outcome_rows(first, n):
    kinds = ("hit", "miss", "pending")
    return [
        (f"{i % 40:08d}", kinds[i % 3], DAY1 + dt.timedelta(minutes=i), f"b{i // 10}", f"{i % 40:08d}", f"N{i}")
        for i in range(first, first + n)
    ]


def test_stream_gives_what_batch_gives_and_resumes(registry, spark, rows, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "checkpoint"))
    seen = []

    def run():
        stream = spark.readStream.schema(OUTCOME).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest_outcomes(stream, log, checkpoint, lambda df, epoch: seen.append((epoch, df.count()))).awaitTermination()

    every = rows(outcome_rows(0, 90), OUTCOME)
    registry.queue.write(scan.enqueue(registry.queue.read(), every))
    rows(outcome_rows(0, 60), OUTCOME).repartition(3).write.mode("append").parquet(source)
    run()
    first = len(seen)
    rows(outcome_rows(60, 30), OUTCOME).coalesce(1).write.mode("append").parquet(source)
    run()
    assert first == 3 and len(seen) == 4 and sum(n for _, n in seen) == 30
    queue, raw = ingest.fold(registry, log)
    once = as_set(queue), as_set(raw)
    want_queue = scan.apply_outcomes(scan.enqueue(registry.queue.read().limit(0), every), every)
    assert once[0] == as_set(columns.conform(want_queue, schemas.SCAN_QUEUE))
    queue, raw = ingest.fold(registry, log)  # folding again changes nothing
    assert (as_set(queue), as_set(raw)) == once


def test_fold_of_new_micro_batches_keeps_later_outcomes(registry, spark, rows, tmp_path):
    source, log, checkpoint = (str(tmp_path / n) for n in ("in", "log", "checkpoint"))
    registry.queue.write(scan.enqueue(registry.queue.read(), rows(outcome_rows(0, 60), OUTCOME)))
    for epoch, first in enumerate((30, 0)):  # the later outcomes land and are folded first
        rows(outcome_rows(first, 30), OUTCOME).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(OUTCOME).option("maxFilesPerTrigger", 1).parquet(source)
        ingest.ingest_outcomes(stream, log, checkpoint).awaitTermination()
        new = ingest.landed_log(spark, log, "raw", schemas.COMPANIES_RAW, after=epoch - 1)
        assert {r["epoch"] for r in new.select("epoch").distinct().collect()} == {epoch}
        ingest.fold(registry, log, after=epoch - 1)
    status = {r["brn"]: (r["status"], r["batch_id"]) for r in registry.queue.read().collect()}
    assert status["00000000"] == ("miss", "b4")  # outcome 40, not the hit of outcome 0 landed after it
    assert status["00000003"] == ("miss", "b4") and status["00000021"] == ("hit", "b2")
    queue, raw = as_set(registry.queue.read()), as_set(registry.raw.read())
    ingest.fold(registry, log, after=1)  # nothing new
    assert (as_set(registry.queue.read()), as_set(registry.raw.read())) == (queue, raw)


def test_replayed_micro_batch_leaves_the_same_files(registry, spark, rows, tmp_path):
    source, log = str(tmp_path / "in"), str(tmp_path / "log")
    rows(outcome_rows(0, 30), OUTCOME).coalesce(1).write.parquet(source)
    for attempt in range(2):  # the second run has lost its checkpoint and does the batch again
        stream = spark.readStream.schema(OUTCOME).parquet(source)
        ingest.ingest_outcomes(stream, log, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    assert ingest.landed_log(spark, log, "raw", schemas.COMPANIES_RAW).count() == 10
    assert ingest.landed_log(spark, log, "none", schemas.COMPANIES_RAW).isEmpty()
