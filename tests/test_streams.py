"""Stateful streams: runs of misses across micro-batches, answers that land after their rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.keys import text_hash
from rollbook.functions.text import clean_address
from rollbook.operators import scan
from rollbook.streaming import ingest
from rollbook.streaming.runs import miss_run_stream
from tests.conftest import as_set

DAY = dt.datetime(2024, 1, 1)
LOG = "batch_id string, seq int, status string, queried_at timestamp, extra double, note string"


def outcome_log(seed, n=400):
    draw = random.Random(seed)
    return [
        (f"b{draw.randint(0, 5)}" if i % 50 else None, i, draw.choice(["hit", "miss", "miss", "miss", "pending", None]),
         DAY + dt.timedelta(seconds=i, microseconds=draw.randint(0, 999_999)), draw.random() if i % 7 else None, f"n{i}")
        for i in range(n)
    ]


def append(rows, data, schema, folder):
    rows(data, schema).coalesce(1).write.mode("append").parquet(folder)


def run(stream, base):
    (
        stream.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True).start().awaitTermination()
    )


@pytest.mark.parametrize(("limit", "timed"), [(1, False), (4, False), (4, True), (99, False)])
def test_streamed_runs_are_those_of_the_whole_log(spark, rows, tmp_path, limit, timed):
    log = outcome_log(limit)
    source, base = f"{tmp_path}/in", f"{tmp_path}/run"
    for k, part in enumerate((log[:150], log[150:170], log[170:330], log[330:])):
        shuffled = part[:]
        random.Random(k).shuffle(shuffled)
        append(rows, shuffled, LOG, source)
        if k in (1, 3):  # ended half way, resumed from the checkpoint
            stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
            run(miss_run_stream(stream, limit, "queried_at" if timed else None), base)
    whole = scan.miss_runs(rows(log, LOG).where("batch_id IS NOT NULL"), limit, 16)
    got = spark.read.schema(whole.schema).parquet(f"{base}/out")
    assert as_set(got.where("batch_id IS NOT NULL")) == as_set(whole)
    lone = got.where("batch_id IS NULL").orderBy("seq").collect()
    assert [r["seq"] for r in lone] == [r[1] for r in log if r[0] is None][: len(lone)] and lone


def test_a_batch_is_forgotten_when_idle(spark, rows, tmp_path):
    """A miss, a day's silence in which the watermark moves on, and a miss: the run begins anew."""
    source, base = f"{tmp_path}/in", f"{tmp_path}/run"
    for k, (batch, hours) in enumerate([("a", 0), ("b", 60), ("b", 61), ("a", 62)]):
        append(rows, [(batch, k, "miss", DAY + dt.timedelta(hours=hours), None, "")], LOG, source)
    stream = spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(source)
    run(miss_run_stream(stream, 9, "queried_at", "1 hour"), base)
    got = spark.read.parquet(f"{base}/out").select("seq", "miss_run")
    assert as_set(got) == [(0, 1), (1, 1), (2, 2), (3, 1)]


RAW = schemas.COMPANIES_RAW
ANSWER = "address_hash string, als_json string, answered_at timestamp"


def body(name):
    return f'{{"SuggestedAddress":[{{"Address":{{"PremisesAddress":{{"GeoAddress":"{name}"}}}},"ValidationInformation":{{"Score":90}}}}]}}'


def test_answers_before_after_too_late_and_never(spark, rows, tmp_path):
    minute = lambda n: DAY + dt.timedelta(minutes=n)
    hash_of = {
        r["a"]: r["h"] for r in rows([(f"{i} ROAD",) for i in range(6)], "a string").select("a", text_hash(clean_address(F.col("a"))).alias("h")).collect()
    }
    company = lambda n, at, address=None: (f"c{n}", None, "N", address or f"{n} ROAD", minute(at))
    answer = lambda n, at, name=None: (hash_of[f"{n} ROAD"], body(name or f"G{n}"), minute(at))
    raws, answers, log, checkpoint = (f"{tmp_path}/{n}" for n in ("raw", "answers", "log", "checkpoint"))

    def go():
        raw = spark.readStream.schema(RAW).option("maxFilesPerTrigger", 1).parquet(raws)
        told = spark.readStream.schema(ANSWER).option("maxFilesPerTrigger", 1).parquet(answers)
        ingest.late_geocode_stream(raw, told, log, checkpoint, wait="30 minutes", keep="20 minutes", delay="5 minutes").awaitTermination()

    first = [company(0, 10), company(1, 10), company(2, 10), company(3, 12), company(4, 12, "  ")]
    append(rows, first, RAW, raws)
    append(rows, [answer(0, 0)], ANSWER, answers)  # before its row
    go()
    append(rows, [company(9, 25, "0 ROAD")], RAW, raws)  # too long after the answer: it waits in vain
    append(rows, [answer(1, 35), answer(2, 45), answer(1, 36, "G1 again")], ANSWER, answers)  # in time, too late
    go()
    # Time goes on in both streams, and a row comes that is behind it.
    append(rows, [company(5, 300)], RAW, raws)
    append(rows, [answer(5, 301)], ANSWER, answers)
    go()
    append(rows, [(("late"), None, "N", "5 ROAD", minute(3))], RAW, raws)
    append(rows, [answer(5, 302)], ANSWER, answers)
    go()
    from rollbook.plans.registry import Registry

    reg = Registry.at(spark, f"{tmp_path}/reg")
    ingest.fold(reg, log)
    master = reg.master.read()
    assert as_set(master.select("cr_no", "geo_address")) == [("c0", "G0"), ("c1", "G1 again"), ("c5", "G5")]
    assert master.where("confidence = 90 AND NOT manual_review").count() == 3
    pending = ingest.landed_log(spark, log, "pending", RAW)
    assert {"c2", "c3", "c4", "c9"} <= {r["cr_no"] for r in pending.collect()}
    left = ingest.unanswered(spark.read.schema(RAW).parquet(raws), log)
    assert as_set(left.select("cr_no")) == [("c2",), ("c3",), ("c4",), ("c9",), ("late",)]


def test_ingest_ends_a_batch_at_the_limit(spark, rows, tmp_path):
    from rollbook.plans.registry import Registry

    schema = "brn string, status string, queried_at timestamp, batch_id string, seq long, cr_no string, name_en string"
    data = [(f"{i}", "miss" if i < 5 else "hit", DAY + dt.timedelta(seconds=i), "b", i, f"{i}", "N") for i in range(8)]
    source, log = f"{tmp_path}/in", f"{tmp_path}/log"
    reg = Registry.at(spark, f"{tmp_path}/reg")
    reg.queue.write(scan.enqueue(reg.queue.read(), rows(data, schema)))
    seen = []
    for part in (data[:2], data[2:4], data[4:]):
        append(rows, part, schema, source)
        stream = spark.readStream.schema(schema).parquet(source)
        ingest.ingest_outcomes(stream, log, f"{tmp_path}/cp", lambda df, epoch: seen.append(df.count()), miss_limit=3).awaitTermination()
    queue, raw = ingest.fold(reg, log)
    assert as_set(queue.groupBy("status").count()) == [("miss", 3), ("pending", 5)]
    assert raw.isEmpty() and sum(seen) == 0


@pytest.mark.parametrize(("n", "files"), [(4000, 16), (40, 1)])
def test_landed_parts_are_many_files_and_one_micro_batch_each(spark, tmp_path, n, files):
    from suite.flows import _in_order

    land = _in_order(spark.range(n).withColumnRenamed("id", "seq"), spark, "order-test", "seq")
    met = []

    def note(batch, _):
        met.append((*batch.agg(F.min("seq"), F.max("seq"), F.count("*")).first(), batch.select(F.input_file_name()).distinct().count()))

    for half in (0, 1):
        ingest.run_available(land(half), note, str(tmp_path / "checkpoint")).awaitTermination()
    step = n // 4
    assert met == [(k * step, (k + 1) * step - 1, step, files) for k in range(4)]
