"""Landed responses as streams.

A micro-batch only writes its own folders (named by the batch number, overwritten on a replay), so
its cost follows the batch and a replay leaves the same files. ``fold`` merges what has landed into
the keyed tables in one upsert.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rollbook import schemas
from rollbook.operators import columns, geocode, keyed, scan
from rollbook.plans.registry import Registry
from rollbook.sources.paths import folder_names, is_complete
from rollbook.streaming.runs import miss_run_stream

BatchHook = Callable[[DataFrame, int], None]


def _epoch_path(base: str, kind: str, epoch: int) -> str:
    return f"{base.rstrip('/')}/{kind}/epoch={epoch}"


def run_available(
    stream: DataFrame, each_batch: BatchHook, checkpoint: str
) -> StreamingQuery:
    """Start a query that works off what is there, resuming from the checkpoint, and then ends."""
    return (
        stream.writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_outcomes(
    outcomes: DataFrame, log_base: str, checkpoint: str, on_hit: BatchHook | None = None, miss_limit: int | None = None
) -> StreamingQuery:
    """Per micro-batch: raw backup, then status changes, then raw rows.

    ``outcomes`` is a stream of ``brn, status, queried_at, batch_id`` and the record fields. Rows
    still pending reach only the backup. ``on_hit`` is called with the hit rows of each batch. With
    ``miss_limit`` a batch ends at the row where its run of misses reaches it (``outcomes`` then has a
    position ``seq``): what lands after that is not recorded.
    """
    if miss_limit is not None:
        outcomes = miss_run_stream(outcomes, miss_limit)

    def land(batch: DataFrame, epoch: int) -> None:
        backup = _epoch_path(log_base, "backup", epoch)
        batch.write.mode("overwrite").parquet(backup)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(backup)
        status = scan.decided(landed).select("brn", "status", "queried_at", "batch_id")
        status.write.mode("overwrite").parquet(_epoch_path(log_base, "status", epoch))
        hits = scan.with_status(landed, "hit")
        rows = columns.conform(
            columns.normalise_columns(hits).withColumn("fetched_at", F.col("queried_at")),
            schemas.COMPANIES_RAW,
        )
        rows.write.mode("overwrite").parquet(_epoch_path(log_base, "raw", epoch))
        if on_hit is not None:
            on_hit(rows, epoch)

    return run_available(outcomes, land, checkpoint)


def landed_log(
    spark: SparkSession, log_base: str, kind: str, schema: T.StructType, after: int = -1
) -> DataFrame:
    """Finished micro-batches of a kind numbered higher than ``after``, their number as ``epoch``."""
    base = f"{log_base.rstrip('/')}/{kind}"
    named = re.compile(r"epoch=(\d+)")
    names = [n for n in folder_names(spark, base) if (m := named.fullmatch(n)) and int(m[1]) > after]
    done = [f"{base}/{n}" for n in names if is_complete(spark, f"{base}/{n}")]
    with_epoch = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    if not done:
        return spark.createDataFrame([], with_epoch)
    return spark.read.schema(with_epoch).option("basePath", base).parquet(*done)


def fold(registry: Registry, log_base: str, after: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Merge landed micro-batches into queue, raw table and master; returns queue and raw table.

    Of several outcomes of a key, those in the tables included, the one queried last counts, in
    whatever order they landed; so folding the same micro-batches again changes nothing. The registry
    remembers the last number folded of each log and leaves those before it unread; ``after`` overrides
    that. Each table is joined once with what has landed for it; one that nothing landed for is not written.
    """
    spark = registry.spark
    queue, table, master = registry.queue.read(), registry.raw.read(), registry.master.read()
    folded = registry.folds.read()
    if after is None:
        last = folded.where(F.col("log_base") == log_base).agg(F.max("epoch")).first()[0]
        after = -1 if last is None else last
    status = landed_log(spark, log_base, "status", schemas.SCAN_QUEUE, after)
    raw = landed_log(spark, log_base, "raw", schemas.COMPANIES_RAW, after)
    built = landed_log(spark, log_base, "master", schemas.MASTER, after)
    until = status.select("epoch").union(raw.select("epoch")).union(built.select("epoch")).agg(F.max("epoch")).first()[0]
    if not status.isEmpty():
        queue = registry.queue.write(scan.apply_outcomes(queue, status, ("queried_at", "epoch"), newer_by="queried_at"))
    if not raw.isEmpty():
        table = registry.raw.write(keyed.upsert(table, raw, "cr_no", order_by=("fetched_at", "epoch"), newer_by="fetched_at"))
    if not built.isEmpty():
        registry.master.write(keyed.upsert(master, built, "cr_no", order_by=("last_updated", "epoch"), newer_by="last_updated"))
    if until is not None:
        done = spark.createDataFrame([(log_base, max(until, after))], folded.schema)
        registry.folds.write(keyed.upsert(folded, done, "log_base"))
    return queue, table


def drop_repeats(records: DataFrame, event_time: str, delay: str, key: str = "cr_no") -> DataFrame:
    """First record of each key within the watermark delay. State is dropped after the delay;
    exact uniqueness over all time belongs to the keyed upsert."""
    return records.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def geocode_stream(
    raw: DataFrame, registry: Registry, log_base: str, checkpoint: str, **cleaning
) -> StreamingQuery:
    """Per micro-batch of raw rows: join with the cache as it is then, and land master rows."""

    def land(batch: DataFrame, epoch: int) -> None:
        place = _epoch_path(log_base, "cleaned", epoch)
        geocode.with_clean_address(batch, **cleaning).write.mode("overwrite").parquet(place)
        cleaned = registry.spark.read.parquet(place)
        attached = geocode.attach_geocode(cleaned, registry.cache.read(), geocode.distinct_addresses(cleaned))
        built = geocode.build_master(attached, F.col("fetched_at"))
        built.write.mode("overwrite").parquet(_epoch_path(log_base, "master", epoch))

    return run_available(raw, land, checkpoint)


def late_geocode_stream(
    raw: DataFrame,
    answers: DataFrame,
    log_base: str,
    checkpoint: str,
    wait: str = "1 hour",
    keep: str = "1 hour",
    delay: str = "10 minutes",
    **cleaning,
) -> StreamingQuery:
    """Raw rows joined with geocoder answers that land before or after them, as two streams.

    ``answers`` has ``address_hash, als_json, answered_at``. A row takes the answers of its address given up
    to ``wait`` after its ``fetched_at`` or up to ``keep`` before it; both streams may be ``delay`` out of order.
    Once no such answer can come any more, a row without one goes to the ``pending`` log; rows with one go to
    the ``master`` log, stamped with the time of the answer, so that ``fold`` keeps the latest. Rows and answers
    behind the watermark are in neither; ``unanswered`` finds such rows, and those that still wait, again.
    """
    rows = geocode.with_clean_address(raw, **cleaning).withWatermark("fetched_at", delay)
    told = answers.select(F.col("address_hash").alias("answer_hash"), "als_json", "answered_at").withWatermark("answered_at", delay)
    near = (
        (F.col("address_hash") == F.col("answer_hash"))
        & (F.col("answered_at") >= F.col("fetched_at") - F.expr(f"INTERVAL {keep}"))
        & (F.col("answered_at") <= F.col("fetched_at") + F.expr(f"INTERVAL {wait}"))
    )
    joined = rows.join(told, near, "left_outer")
    fields = [f.name for f in schemas.COMPANIES_RAW.fields]

    def land(batch: DataFrame, epoch: int) -> None:
        place = _epoch_path(log_base, "joined", epoch)
        batch.write.mode("overwrite").parquet(place)
        landed = batch.sparkSession.read.schema(batch.schema).parquet(place)
        answered = geocode.parse_answers(landed.where(F.col("answer_hash").isNotNull()))
        reviewed = answered.withColumn("manual_review", geocode.needs_review(F.col("score")))
        built = geocode.build_master(reviewed, F.col("answered_at"))
        built.write.mode("overwrite").parquet(_epoch_path(log_base, "master", epoch))
        waiting = landed.where(F.col("answer_hash").isNull()).select(*fields)
        waiting.write.mode("overwrite").parquet(_epoch_path(log_base, "pending", epoch))

    return run_available(joined, land, checkpoint)


def unanswered(raw: DataFrame, log_base: str) -> DataFrame:
    """Rows of ``raw`` no landed master row exists for: those without an answer in time, those that still wait
    and those too late for the stream. They are what ``geocode_pending`` works off."""
    built = landed_log(raw.sparkSession, log_base, "master", schemas.MASTER)
    return keyed.without_keys(raw, built, "cr_no")
