"""Candidate keys, the scan queue, outcome logs and the name-prefix search."""

from __future__ import annotations

import datetime as dt
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv
from rollbook.functions.keys import key_kind, numeric_key
from rollbook.operators.keyed import first_per_key, insert_ignore, update_by_key
from rollbook.sources.scratch import staged

# Rows of one batch that are ordered together in one task (by position in the batch).
CHUNK = 65_536


# --- candidate keys -------------------------------------------------------------------------------


def numeric_candidates(
    spark: SparkSession,
    start: int = fv.KEY_NUMERIC_RANGE[0],
    end: int = fv.KEY_NUMERIC_RANGE[1],
) -> DataFrame:
    """Keys start..end, both included."""
    return spark.range(start, end + 1).select(numeric_key(F.col("id")).alias("brn"))


def prefixed_candidates(
    spark: SparkSession,
    prefixes: Sequence[str] = fv.KEY_PREFIXES,
    start: int = fv.KEY_PREFIX_RANGE[0],
    end: int = fv.KEY_PREFIX_RANGE[1],
) -> DataFrame:
    """Every prefix with every number start..end: one range over all pairs, no join."""
    span = end - start + 1
    letters = F.array(*map(F.lit, prefixes))
    pair = F.col("id")
    prefix = F.get(letters, F.floor(pair / F.lit(span)).cast("int"))
    return spark.range(len(prefixes) * span).select(
        F.concat(prefix, (F.lit(start) + pair % span).cast("string")).alias("brn")
    )


def listed_candidates(keys: DataFrame, column: str = "brn") -> DataFrame:
    """An explicit key list, trimmed, upper-cased and each key once, with its kind."""
    key = F.upper(F.trim(F.col(column)))
    return keys.select(key.alias("brn")).distinct().withColumn("kind", key_kind(F.col("brn")))


def enqueue(queue: DataFrame, keys: DataFrame) -> DataFrame:
    """The queue with the keys it lacks added as pending."""
    return insert_ignore(queue, keys.select("brn", F.lit("pending").alias("status")), "brn")


# --- queue ----------------------------------------------------------------------------------------


def with_status(queue: DataFrame, status: str) -> DataFrame:
    return queue.where(F.col("status") == status)


def sample_pending(queue: DataFrame, n: int, seed: str = "0") -> DataFrame:
    """``n`` pending keys drawn by a seeded hash, the same ones on every run.

    Keys are counted by the first digits of the hash (65,536 groups at most) to find where the n-th
    falls; only keys up to there are sorted, not n of every partition.
    """
    drawn = with_status(queue, "pending").select(
        "brn", F.md5(F.concat(F.lit(seed), "brn").cast("binary")).alias("draw")
    )
    group = F.substring("draw", 1, 4)
    seen = F.sum("n").over(Window.orderBy("grp"))
    reached = drawn.groupBy(group.alias("grp")).agg(F.count("*").alias("n")).select("grp", seen.alias("seen"))
    cut = reached.where(F.col("seen") >= n).agg(F.coalesce(F.min("grp"), F.lit("~")))
    return drawn.where(group <= cut.scalar()).orderBy("draw", "brn").limit(n).select("brn")


def stale(queried_at: Column, now: dt.datetime | Column, days: int) -> Column:
    moment = now if isinstance(now, Column) else F.lit(now)
    return queried_at < moment - F.make_interval(days=F.lit(days))


def stale_hits(
    queue: DataFrame, n: int, now: dt.datetime | Column | None = None, days: int | None = None
) -> DataFrame:
    """The ``n`` hits not queried for longest; with ``days`` only those older than that."""
    hits = with_status(queue, "hit")
    if days is not None:
        hits = hits.where(stale(F.col("queried_at"), now, days))
    return hits.orderBy(F.asc_nulls_last("queried_at"), "brn").limit(n).select("brn", "queried_at")


def decided(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("status").isin("hit", "miss"))


def apply_outcomes(
    queue: DataFrame, outcomes: DataFrame, order_by: Sequence[str] = ("queried_at",), newer_by: str | None = None
) -> DataFrame:
    """The queue with decided outcomes written in; undecided keys stay as they are."""
    return update_by_key(
        queue, decided(outcomes), "brn", ["status", "queried_at", "batch_id"], order_by, newer_by
    )


def _status_counts() -> list[Column]:
    return [F.count_if(F.col("status") == s).alias(s) for s in ("pending", "hit", "miss")]


def status_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("status").agg(F.count("*").alias("n"))


def scan_progress(queue: DataFrame) -> DataFrame:
    """Counts by status, the batch queried last and when, and the two rates (null where undefined).

    ``max_batch_id`` is the greatest id, which for random ids need not be the last batch.
    """
    counts = queue.agg(
        *_status_counts(),
        F.max_by("batch_id", F.struct("queried_at", "batch_id")).alias("last_batch_id"),
        F.max("batch_id").alias("max_batch_id"),
        F.max("queried_at").alias("last_queried_at"),
    )
    scanned = F.col("hit") + F.col("miss")
    total = scanned + F.col("pending")
    return counts.withColumn("hit_rate", F.try_divide("hit", scanned)).withColumn(
        "scanned_share", F.try_divide(scanned, total)
    )


# --- outcome logs ---------------------------------------------------------------------------------


def _miss_state(log: DataFrame, chunk: int) -> DataFrame:
    """Within chunks of a batch: misses so far and misses up to the last hit so far."""
    within = Window.partitionBy("batch_id", "_chunk").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    missed = F.when(F.col("status") == "miss", 1).otherwise(0)
    hit_mark = F.when(F.col("status") == "hit", F.col("_missed"))
    return (
        log.withColumn("_chunk", F.floor(F.col("seq") / F.lit(chunk)))
        .withColumn("_missed", F.sum(missed).over(within))
        .withColumn("_at_hit", F.max(hit_mark).over(within))
    )


def _chunk_state(state: DataFrame, limit: int) -> DataFrame:
    """Per chunk: misses and last-hit mark carried in, and whether the batch stopped before it."""
    miss = F.col("status") == "miss"
    own_run = F.col("_missed") - F.col("_at_hit")
    chunks = state.groupBy("batch_id", "_chunk").agg(
        F.max("_missed").alias("misses"),
        F.max("_at_hit").alias("hit_mark"),
        F.coalesce(F.max(F.when(F.col("_at_hit").isNull() & miss, F.col("_missed"))), F.lit(0)).alias("lead"),
        F.coalesce(F.bool_or(miss & (own_run >= limit)), F.lit(False)).alias("stops_inside"),
    )
    before = Window.partitionBy("batch_id").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.withColumn("_misses_in", F.coalesce(F.sum("misses").over(before), F.lit(0)))
    carried = carried.withColumn(
        "_mark_in",
        F.coalesce(F.max(F.col("_misses_in") + F.col("hit_mark")).over(before), F.lit(0)),
    )
    run_in = F.col("_misses_in") - F.col("_mark_in")
    stops = F.col("stops_inside") | ((F.col("lead") > 0) & (run_in + F.col("lead") >= limit))
    return carried.withColumn("_stops", stops).select(
        "batch_id",
        "_chunk",
        "_misses_in",
        "_mark_in",
        F.coalesce(F.max("_stops").over(before), F.lit(False)).alias("_stopped"),
    )


def miss_runs(log: DataFrame, limit: int = fv.MISS_LIMIT, chunk: int = CHUNK) -> DataFrame:
    """The counted rows of each batch with the run of consecutive misses at each.

    ``log`` has ``batch_id``, a whole-number position ``seq`` that is unique in the batch, and
    ``status``. A hit ends a run, a pending row does not. A batch stops at the first row where the
    run reaches ``limit`` (``is_stop``); rows after it are not counted.

    A batch of any size is worked on in chunks of positions; only one summary row per chunk is
    brought together by batch.
    """
    # Written once: rows and chunk summaries both come from it, the log is read and shuffled once.
    state = staged(_miss_state(log, chunk), "miss-state")
    joined = state.join(_chunk_state(state, limit), ["batch_id", "_chunk"])
    mark = F.coalesce(F.col("_misses_in") + F.col("_at_hit"), F.col("_mark_in"))
    runs = joined.where(~F.col("_stopped")).withColumn(
        "miss_run", (F.col("_misses_in") + F.col("_missed") - mark).cast("bigint")
    )
    reached = (F.col("status") == "miss") & (F.col("miss_run") >= limit)
    stop = F.min(F.when(reached, F.col("seq"))).over(Window.partitionBy("batch_id", "_chunk"))
    return (
        runs.withColumn("_stop", stop)
        .where(F.col("_stop").isNull() | (F.col("seq") <= F.col("_stop")))
        .select(*log.columns, "miss_run", F.coalesce(F.col("seq") == F.col("_stop"), F.lit(False)).alias("is_stop"))
    )


def batch_stats(counted: DataFrame) -> DataFrame:
    """Totals of each batch of ``miss_runs`` rows; skipped rows are those still pending."""
    return counted.groupBy("batch_id").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "hit").alias("hit"),
        F.count_if(F.col("status") == "miss").alias("miss"),
        F.count_if(F.col("status") == "pending").alias("skipped"),
        F.bool_or("is_stop").alias("stopped_early"),
    )


def running_totals(
    stats: DataFrame, order: str, columns: Sequence[str] = ("hit", "miss"), chunk: int = CHUNK
) -> DataFrame:
    """Adds ``cum_<column>`` over all rows by a whole-number, unique ``order`` column.

    Sums run within chunks of the order column; only chunk totals are summed in one place.
    """
    parts = stats.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.groupBy("_chunk").agg(*[F.sum(c).alias(f"_sum_{c}") for c in columns])
    offsets = sums.select(
        "_chunk",
        *[F.coalesce(F.sum(f"_sum_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in columns],
    )
    within = Window.partitionBy("_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return parts.join(offsets, "_chunk").select(
        *stats.columns,
        *[(F.col(f"_before_{c}") + F.sum(c).over(within)).alias(f"cum_{c}") for c in columns],
    )


# --- prefix search --------------------------------------------------------------------------------


def expansion_characters() -> list[str]:
    return [*string.ascii_uppercase, *string.digits, *fv.EXPANSION_ZH]


def prefix_counts(
    responses: DataFrame,
    page_limit: int = fv.PREFIX_PAGE_LIMIT,
    max_depth: int = fv.PREFIX_MAX_DEPTH,
) -> DataFrame:
    """Results per queried prefix. A full page (``saturated``) is extended (``expanded``) unless it
    is at the greatest depth, where it may be cut short (``truncated``)."""
    counts = responses.groupBy("prefix", "depth").agg(F.count("*").alias("n"))
    full = F.col("n") >= page_limit
    deepest = F.col("depth") >= max_depth
    return counts.select(
        "prefix", "depth", "n",
        full.alias("saturated"),
        (full & ~deepest).alias("expanded"),
        (full & deepest).alias("truncated"),
    )


def prefix_frontier(
    counts: DataFrame, queried: DataFrame, characters: Sequence[str] | None = None
) -> DataFrame:
    """Prefixes to query next: every extension of an expanded prefix not queried yet."""
    alphabet = F.array(*map(F.lit, characters or expansion_characters()))
    children = counts.where("expanded").select(
        "prefix", "depth", F.posexplode(alphabet).alias("char_ord", "char")
    ).select(
        F.concat("prefix", "char").alias("prefix"), (F.col("depth") + 1).alias("depth"), "char_ord"
    )
    return children.join(queried.select("prefix"), "prefix", "left_anti")


def assemble_prefixes(
    responses: DataFrame,
    counts: DataFrame,
    keep_parent_rows: bool = True,
    characters: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of all queried prefixes; take ``first_by_key`` of the result.

    With ``keep_parent_rows=False`` a prefix that was extended goes if every extension of it has been
    queried; names going on with a character outside the alphabet are lost with it.
    """
    if keep_parent_rows:
        return responses
    alphabet = list(characters or expansion_characters())
    last = F.substring("prefix", -1, 1)
    parent = counts.where(F.length("prefix") > 1).select(
        F.expr("substring(prefix, 1, length(prefix) - 1)").alias("prefix"), last.alias("char")
    )
    landed = parent.where(F.col("char").isin(alphabet)).groupBy("prefix").agg(F.count_distinct("char").alias("n_children"))
    covered = counts.where("expanded").join(landed, "prefix").where(F.col("n_children") == len(set(alphabet)))
    return responses.join(covered.select("prefix"), "prefix", "left_anti")


def first_by_key(records: DataFrame, key: str = "cr_no", order_by: Sequence[str] = ("prefix_ord", "pos")) -> DataFrame:
    """First record of each key in prefix order; records without a key are all kept."""
    return first_per_key(records, key, order_by)
