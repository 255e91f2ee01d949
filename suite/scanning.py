"""Queries on candidate keys, the scan queue, outcome logs and the prefix search."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollbook.functions.keys import key_kind as kind_of
from rollbook.operators import bitmaps, prefixes, scan
from suite.inputs import frame
from suite.registry import query

NOW = dt.datetime(2000, 6, 1)
MISS_LIMIT = 4


def _key_bounds(spark, sf):
    return frame(spark, sf, "orders").agg(F.min("o_orderkey"), (F.max("o_orderkey") + 500)).first()


@query("SELECT printf('%08d', k) AS brn FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 501)) AS k FROM {orders}) r")
def candidates_numeric(spark, sf):
    low, high = _key_bounds(spark, sf)
    return scan.numeric_candidates(spark, low, high)


@query(
    "SELECT p || CAST(1000 + k AS VARCHAR) AS brn FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 501)) AS k FROM {orders}) r "
    "CROSS JOIN (VALUES ('C'), ('G'), ('L')) v(p)"
)
def candidates_prefix(spark, sf):
    low, high = _key_bounds(spark, sf)
    return scan.prefixed_candidates(spark, ("C", "G", "L"), 1000 + low, 1000 + high)


@query(
    "SELECT brn, status FROM {queue} UNION ALL SELECT printf('%08d', k), 'pending' FROM "
    "(SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 501)) AS k FROM {orders}) r "
    "WHERE NOT EXISTS (SELECT 1 FROM {queue} q WHERE q.brn = printf('%08d', k))"
)
def enqueue(spark, sf):
    low, high = _key_bounds(spark, sf)
    queue = frame(spark, sf, "queue")
    twice = scan.enqueue(scan.enqueue(queue, scan.numeric_candidates(spark, low, high)), scan.numeric_candidates(spark, low, high))
    return twice.select("brn", "status")


@query(
    "SELECT brn, CASE WHEN regexp_full_match(brn, '\\d+') THEN 'numeric' ELSE 'alpha' END AS kind FROM "
    "(SELECT DISTINCT upper(trim(CASE WHEN p_partkey % 3 = 0 THEN ' c' || CAST(p_partkey // 3 AS VARCHAR) || ' ' ELSE CAST(p_partkey // 3 AS VARCHAR) END)) AS brn FROM {part}) k"
)
def key_kind(spark, sf):
    number = F.expr("p_partkey div 3").cast("string")
    key = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(" c"), number, F.lit(" "))).otherwise(number)
    return scan.listed_candidates(frame(spark, sf, "part").select(key.alias("brn")))


@query("SELECT brn FROM {queue} WHERE status = 'pending' ORDER BY md5('7' || brn), brn LIMIT 1000")
def sample_pending(spark, sf):
    return scan.sample_pending(frame(spark, sf, "queue"), 1000, seed="7")


@query(
    "SELECT brn, queried_at FROM {queue} WHERE status = 'hit' AND queried_at < TIMESTAMP '2000-06-01' - INTERVAL 365 DAY "
    "ORDER BY queried_at ASC NULLS LAST, brn LIMIT 500"
)
def stale_hits(spark, sf):
    queue = frame(spark, sf, "queue")
    return scan.stale_hits(queue, 500, F.lit(NOW).cast("timestamp_ntz"), 365)


@query("SELECT brn, queried_at FROM {queue} WHERE status = 'hit' ORDER BY queried_at ASC NULLS LAST, brn LIMIT 500")
def oldest_hits(spark, sf):
    return scan.stale_hits(frame(spark, sf, "queue"), 500)


@query("SELECT status, count(*) AS n FROM {queue} GROUP BY status")
def status_counts(spark, sf):
    return scan.status_counts(frame(spark, sf, "queue"))


@query("SELECT brn, batch_id FROM {queue} WHERE status = 'hit'")
def status_filter(spark, sf):
    return scan.with_status(frame(spark, sf, "queue"), "hit").select("brn", "batch_id")


@query("SELECT batch_id, brn, status FROM {outcomes} WHERE status IN ('hit', 'miss')")
def decided_outcomes(spark, sf):
    return scan.decided(frame(spark, sf, "outcomes")).select("batch_id", "brn", "status")


@query(
    """SELECT count(*) FILTER (WHERE status = 'pending') AS pending, count(*) FILTER (WHERE status = 'hit') AS hit,
  count(*) FILTER (WHERE status = 'miss') AS miss,
  (SELECT batch_id FROM {queue} WHERE queried_at IS NOT NULL ORDER BY queried_at DESC, batch_id DESC LIMIT 1) AS last_batch_id,
  max(batch_id) AS max_batch_id, max(queried_at) AS last_queried_at,
  count(*) FILTER (WHERE status = 'hit') / count(*) FILTER (WHERE status <> 'pending') AS hit_rate,
  count(*) FILTER (WHERE status <> 'pending') / count(*) AS scanned_share FROM {queue}"""
)
def scan_progress(spark, sf):
    return scan.scan_progress(frame(spark, sf, "queue"))


@query(
    """SELECT q.brn, coalesce(o.status, q.status) AS status,
  CASE WHEN o.brn IS NULL THEN q.batch_id ELSE o.batch_id END AS batch_id
FROM {queue} q LEFT JOIN (SELECT * FROM {outcomes} WHERE status IN ('hit', 'miss')) o ON q.brn = o.brn"""
)
def apply_outcomes(spark, sf):
    applied = scan.apply_outcomes(frame(spark, sf, "queue"), frame(spark, sf, "outcomes"))
    return applied.select("brn", "status", "batch_id")


_RUNS = f"""islands AS (SELECT *, sum(CASE WHEN status = 'hit' THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id ORDER BY seq) AS island FROM {{outcomes}}),
runs AS (SELECT *, CAST(sum(CASE WHEN status = 'miss' THEN 1 ELSE 0 END) OVER (PARTITION BY batch_id, island ORDER BY seq) AS BIGINT) AS miss_run FROM islands),
stops AS (SELECT batch_id, min(seq) AS stop FROM runs WHERE status = 'miss' AND miss_run >= {MISS_LIMIT} GROUP BY batch_id),
counted AS (SELECT batch_id, batch_no, seq, brn, status, miss_run, coalesce(seq = stop, FALSE) AS is_stop
            FROM runs LEFT JOIN stops USING (batch_id) WHERE stop IS NULL OR seq <= stop),
stats AS (SELECT batch_id, count(*) AS total, count(*) FILTER (WHERE status = 'hit') AS hit, count(*) FILTER (WHERE status = 'miss') AS miss,
          count(*) FILTER (WHERE status = 'pending') AS skipped, bool_or(is_stop) AS stopped_early FROM counted GROUP BY batch_id)"""


def _counted(spark, sf, chunk=1_000):
    return scan.miss_runs(frame(spark, sf, "outcomes"), MISS_LIMIT, chunk)


@query(f"WITH {_RUNS} SELECT * FROM counted")
def miss_runs(spark, sf):
    return _counted(spark, sf).drop("queried_at")


@query(f"WITH {_RUNS} SELECT * FROM stats")
def batch_stats(spark, sf):
    return scan.batch_stats(_counted(spark, sf))


@query(
    f"WITH {_RUNS} SELECT CAST(substr(batch_id, 2) AS BIGINT) AS batch_no, hit, miss, "
    "CAST(sum(hit) OVER (ORDER BY CAST(substr(batch_id, 2) AS BIGINT)) AS BIGINT) AS cum_hit, "
    "CAST(sum(miss) OVER (ORDER BY CAST(substr(batch_id, 2) AS BIGINT)) AS BIGINT) AS cum_miss FROM stats"
)
def batch_running_totals(spark, sf):
    stats = scan.batch_stats(_counted(spark, sf)).select(
        F.expr("CAST(substr(batch_id, 2) AS BIGINT)").alias("batch_no"), "hit", "miss"
    )
    return scan.running_totals(stats, "batch_no", chunk=16)


def _counts_sql(answers, limit, depth):
    return f"""counts AS (SELECT prefix, depth, count(*) AS n, count(*) >= {limit} AS saturated, count(*) >= {limit} AND depth < {depth} AS expanded,
           count(*) >= {limit} AND depth >= {depth} AS truncated FROM {{{answers}}} GROUP BY prefix, depth)"""


_COUNTS = _counts_sql("prefix_answers", 20, 3)


def _prefix_counts(spark, sf):
    return scan.prefix_counts(frame(spark, sf, "prefix_answers"), page_limit=20, max_depth=3)


@query(f"WITH {_COUNTS} SELECT * FROM counts")
def prefix_counts(spark, sf):
    return _prefix_counts(spark, sf)


@query(
    f"""WITH {_COUNTS}, alphabet AS (SELECT CAST(unnest(range(36)) AS INTEGER) AS char_ord)
SELECT prefix || char AS prefix, depth + 1 AS depth, char_ord
FROM (SELECT prefix, depth, char_ord, CASE WHEN char_ord < 26 THEN chr(65 + char_ord) ELSE chr(22 + char_ord) END AS char
      FROM counts CROSS JOIN alphabet WHERE expanded) e
WHERE NOT EXISTS (SELECT 1 FROM {{prefix_answers}} q WHERE q.prefix = e.prefix || e.char)"""
)
def prefix_frontier(spark, sf):
    letters_and_digits = scan.expansion_characters()[:36]
    queried = frame(spark, sf, "prefix_answers").select("prefix").distinct()
    return scan.prefix_frontier(_prefix_counts(spark, sf), queried, letters_and_digits)


def _assembled_sql(answers, last, n):
    """An extended prefix goes if all its extensions were queried."""
    return (
        f"SELECT p.* FROM {{{answers}}} p WHERE NOT EXISTS (SELECT 1 FROM counts c WHERE c.prefix = p.prefix AND c.expanded "
        "AND (SELECT count(*) FROM counts k WHERE length(k.prefix) = length(c.prefix) + 1 AND left(k.prefix, length(c.prefix)) = c.prefix "
        f"AND regexp_matches(right(k.prefix, 1), '{last}')) = {n})"
    )


@query(f"WITH {_COUNTS} {_assembled_sql('prefix_answers', '[0-9]', 10)}")
def prefix_assemble(spark, sf):
    answers = frame(spark, sf, "prefix_answers")
    return scan.assemble_prefixes(answers, _prefix_counts(spark, sf), keep_parent_rows=False, characters="0123456789")


# --- prefix search to its end ---

_SEARCH = dict(page_limit=20, max_depth=4, characters=scan.expansion_characters()[:36])
# A prefix is asked if the one before it is full; all its characters are in the alphabet.
_SEARCHED = """every AS (SELECT cr_no, name_en, left(name_en, k) AS prefix, CAST(k - 1 AS INTEGER) AS depth
  FROM (SELECT *, unnest(range(1, 6)) AS k FROM {search_names}) x WHERE length(name_en) >= k AND regexp_full_match(left(name_en, k), '[A-Z0-9]+')),
whole AS (SELECT prefix, depth, count(*) AS m FROM every GROUP BY prefix, depth),
asked AS (SELECT w.* FROM whole w LEFT JOIN whole p ON p.prefix = left(w.prefix, length(w.prefix) - 1) WHERE w.depth = 0 OR p.m >= 20),
prefixes AS (SELECT prefix, depth, least(m, 20) AS n, m >= 20 AS saturated, m >= 20 AND depth < 4 AS expanded, m >= 20 AND depth >= 4 AS truncated FROM asked),
pages AS (SELECT prefix, depth, CAST(row_number() OVER (PARTITION BY prefix ORDER BY cr_no) - 1 AS INTEGER) AS pos, cr_no, name_en
  FROM every SEMI JOIN asked USING (prefix) QUALIFY pos < 20)"""


def _searched(spark, sf):
    return prefixes.search_to_end(frame(spark, sf, "search_names"), **_SEARCH)


@query(f"WITH {_SEARCHED} SELECT * FROM prefixes")
def prefix_search(spark, sf):
    """Every prefix asked for, level by level, and the truncated ones."""
    return _searched(spark, sf).prefixes


@query(f"WITH {_SEARCHED} SELECT * FROM pages ANTI JOIN (SELECT prefix FROM prefixes WHERE expanded) e USING (prefix)")
def prefix_search_records(spark, sf):
    return _searched(spark, sf).records()


@query(
    f"""WITH {_SEARCHED}
SELECT depth, asked, count(n) AS answered, count(*) FILTER (saturated) AS saturated, count(*) FILTER (truncated) AS truncated,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows
FROM (SELECT 0 AS depth, 36 AS asked UNION ALL SELECT depth + 1, 36 * count(*) FROM prefixes WHERE expanded GROUP BY depth) d
LEFT JOIN prefixes USING (depth) GROUP BY depth, asked"""
)
def prefix_search_levels(spark, sf):
    return _searched(spark, sf).levels


@query(
    f"""WITH {_SEARCHED} SELECT cr_no, name_en, min(prefix) AS prefix FROM pages
GROUP BY cr_no, name_en"""
)
def prefix_search_companies(spark, sf):
    """Each company found, with the first prefix of the alphabet's order that showed it (here: the shortest)."""
    found = _searched(spark, sf).records(keep_parent_rows=True)
    order = prefixes.prefix_order(F.col("prefix"), _SEARCH["characters"])
    return scan.first_by_key(found.withColumn("prefix_ord", order)).select("cr_no", "name_en", "prefix")


# First of key is taken of all names, without the page limit of a search.
_WHOLE_COUNTS, _WHOLE_ASSEMBLED = _counts_sql("prefix_keys", 100, 2), _assembled_sql("prefix_keys", "[A-G]", 7)


def _whole_counts(spark, sf):
    return scan.prefix_counts(frame(spark, sf, "prefix_keys"), page_limit=100, max_depth=2)


@query(
    f"""WITH {_WHOLE_COUNTS}, parts AS ({_WHOLE_ASSEMBLED})
SELECT cr_no, name_en, prefix FROM (SELECT *, row_number() OVER (PARTITION BY cr_no ORDER BY prefix_ord, pos) AS rn FROM parts) r
WHERE rn = 1 OR cr_no = ''"""
)
def first_by_key(spark, sf):
    whole = scan.assemble_prefixes(
        frame(spark, sf, "prefix_keys"), _whole_counts(spark, sf), keep_parent_rows=False, characters="ABCDEFG"
    )
    return scan.first_by_key(whole).select("cr_no", "name_en", "prefix")


@query(
    """SELECT cr_no, name_en, prefix FROM (SELECT *, row_number() OVER (PARTITION BY cr_no ORDER BY prefix_ord, pos) AS rn FROM {prefix_keys}) r
WHERE rn = 1 OR cr_no = ''"""
)
def first_by_key_with_parents(spark, sf):
    whole = scan.assemble_prefixes(
        frame(spark, sf, "prefix_keys"), _whole_counts(spark, sf), keep_parent_rows=True
    )
    return scan.first_by_key(whole).select("cr_no", "name_en", "prefix")


# --- the queue as bitmaps ---

_QUEUED = """queued AS (SELECT brn, status FROM {queue} UNION ALL SELECT printf('%08d', k), 'pending' FROM
(SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 501)) AS k FROM {orders}) r
WHERE NOT EXISTS (SELECT 1 FROM {queue} q WHERE q.brn = printf('%08d', k)))"""
_LATEST = "(SELECT brn, status FROM {outcomes} WHERE status <> 'pending')"


def _bitmap_queue(spark, sf):
    low, high = _key_bounds(spark, sf)
    more = bitmaps.range_bits(spark, low, high)
    return bitmaps.BitmapQueue.of(frame(spark, sf, "queue")).enqueue(more).enqueue(more)


@query(f"WITH {_QUEUED} SELECT * FROM queued")
def bitmap_enqueue(spark, sf):
    return _bitmap_queue(spark, sf).rows()


@query(
    f"""WITH {_QUEUED} SELECT count(*) FILTER (status = 'pending') AS pending, count(*) FILTER (status = 'hit') AS hit,
count(*) FILTER (status = 'miss') AS miss FROM (SELECT q.brn, coalesce(o.status, q.status) AS status FROM queued q LEFT JOIN {_LATEST} o ON o.brn = q.brn) s"""
)
def bitmap_progress(spark, sf):
    """Counts by status after the outcomes of a scan."""
    return _bitmap_queue(spark, sf).apply(frame(spark, sf, "outcomes")).progress()


@query(f"WITH {_QUEUED} SELECT brn FROM queued WHERE status = 'pending' ORDER BY brn LIMIT 2000")
def bitmap_next_pending(spark, sf):
    return _bitmap_queue(spark, sf).next_pending(2000)


@query(
    "SELECT brn, CASE WHEN regexp_full_match(brn, '\\d+') THEN 'numeric' ELSE 'alpha' END AS kind FROM {queue}"
)
def queue_key_kind(spark, sf):
    return frame(spark, sf, "queue").select("brn", kind_of(F.col("brn")).alias("kind"))
