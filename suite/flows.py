"""Whole flows over registry tables in the scratch folder, and their streaming forms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions.keys import text_hash
from rollbook.functions.text import clean_address
from rollbook.operators import columns, geocode, scan
from rollbook.plans import registry as flows
from rollbook.session import scratch_dir
from rollbook.sources import landed
from rollbook.sources.scratch import staged
from rollbook.streaming import ingest
from rollbook.streaming.runs import miss_run_stream
from suite.address import RUN_TS, clean_sql
from suite.inputs import frame
from suite.registry import query
from suite.scanning import _RUNS, MISS_LIMIT
from suite.tags import SECTION, keywords

_SHOWN = ("cr_no", "name_zh", "name_en", "address_raw", "address_clean", "geo_address", "region", "confidence", "manual_review")

# What the geocoder answered: something for the hashes that start with a decimal digit.
_RESOLVED = """CASE WHEN substr({h}, 1, 1) <= '9' THEN 'G' || substr({h}, 1, 6) END AS geo_address,
  CASE WHEN substr({h}, 1, 1) <= '9' THEN 'R' || substr({h}, 3, 1) END AS region,
  CASE WHEN substr({h}, 1, 1) <= '9' THEN CAST(ascii(substr({h}, 2, 1)) AS DOUBLE) ELSE 0 END AS confidence,
  CASE WHEN substr({h}, 1, 1) <= '9' THEN ascii(substr({h}, 2, 1)) < 70 ELSE TRUE END AS manual_review""".format(h="address_hash")


def _resolved(source: str) -> str:
    return (
        f"SELECT cr_no, name_zh, name_en, address_raw, address_clean, {_RESOLVED} FROM (SELECT *, nullif(sha1(address_clean), sha1('')) AS address_hash "
        f"FROM (SELECT *, {clean_sql('address_raw')} AS address_clean FROM {source}) c) h"
    )


def _answers(*days):
    """Landed answers by address hash.

    They land once, and each address is cleaned once: without its table the distinct would be dropped as one that
    the later distinct makes needless, and every row be cleaned."""
    h = F.col("address_hash")
    body = F.concat(
        F.lit('{"SuggestedAddress":[{"Address":{"PremisesAddress":{"GeoAddress":"G'), F.substring(h, 1, 6),
        F.lit('","ChiPremisesAddress":{"ChiRegion":"R'), F.substring(h, 3, 1),
        F.lit('"}}},"ValidationInformation":{"Score":'), F.ascii(F.substring(h, 2, 1)).cast("string"), F.lit("}}]}"),
    )
    rows = staged(columns.union_all([d.select("address_raw") for d in days]).distinct(), "addresses")
    hashed = rows.select(text_hash(clean_address(F.col("address_raw"))).alias("address_hash")).distinct()
    return staged(hashed, "hashes").where(F.substring(h, 1, 1) <= "9").withColumn("als_json", body)


def _snapshot(spark, sf, name):
    """A snapshot as it lands: computed once, in files that many tasks write and read."""
    rows = frame(spark, sf, name)
    return staged(rows.repartition("cr_no"), name)


def _registry(spark, name):
    return flows.Registry.at(spark, scratch_dir(spark, name))


@query(_resolved("{companies}"))
def full_refresh(spark, sf):
    reg, rows = _registry(spark, "full"), _snapshot(spark, sf, "companies")
    flows.full_refresh(reg, rows, _answers(rows), RUN_TS)
    return reg.master.read().select(*_SHOWN)


_SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM n.{c}" for c in schemas.REQUIRED_COLUMNS)


@query(
    f"""WITH changed AS (SELECT * FROM {{day2}} n WHERE NOT EXISTS (SELECT 1 FROM {{day1}} o WHERE {_SAME})),
merged AS (SELECT * FROM changed UNION ALL SELECT * FROM {{day1}} d WHERE NOT EXISTS (SELECT 1 FROM changed c WHERE c.cr_no = d.cr_no))
SELECT m.*, CASE WHEN c.cr_no IS NOT NULL THEN 'T' || right(c.cr_no, 1) END AS company_type
FROM ({_resolved('merged')}) m LEFT JOIN (SELECT DISTINCT cr_no FROM changed) c ON c.cr_no = m.cr_no"""
)
def delta_refresh(spark, sf):
    reg, day1, day2 = _registry(spark, "delta"), _snapshot(spark, sf, "day1"), _snapshot(spark, sf, "day2")
    answers = _answers(day1, day2)
    flows.full_refresh(reg, day1, answers, RUN_TS)
    day2 = day2.withColumn("company_type", F.concat(F.lit("T"), F.substring("cr_no", -1, 1)))
    flows.delta_refresh(reg, day2, day1, answers, RUN_TS + dt.timedelta(days=1))
    return reg.master.read().select(*_SHOWN, "company_type")


@query(
    f"SELECT count(*) AS master_total, count(*) FILTER (WHERE manual_review) AS manual_review, "
    f"count(DISTINCT address_clean) FILTER (WHERE geo_address IS NOT NULL) AS cache_size FROM ({_resolved('{companies}')}) m"
)
def geocode_pending(spark, sf):
    """Raw rows without a geo address are geocoded later, in a second run nothing is left to change."""
    reg, day1 = _registry(spark, "pending"), _snapshot(spark, sf, "companies")
    reg.raw.write(columns.stamp(day1, RUN_TS))
    answers = _answers(day1)
    flows.geocode_pending(reg, answers, RUN_TS)
    summary = flows.geocode_pending(reg, answers, RUN_TS)
    return summary.select("master_total", "manual_review", "cache_size")


@query(
    f"""WITH {_RUNS}
SELECT coalesce(q.brn, o.brn) AS brn, coalesce(o.status, q.status) AS status, CASE WHEN o.brn IS NULL THEN NULL ELSE o.batch_id END AS batch_id
FROM (SELECT printf('%08d', k) AS brn, 'pending' AS status FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 1)) AS k FROM {{orders}}) r) q
LEFT JOIN (SELECT * FROM counted WHERE status IN ('hit', 'miss')) o ON q.brn = o.brn"""
)
def record_scan(spark, sf):
    reg = _registry(spark, "scan")
    low, high = frame(spark, sf, "orders").agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    log = frame(spark, sf, "outcomes").withColumn("queried_at", F.col("queried_at").cast("timestamp"))
    flows.record_scan(reg, scan.numeric_candidates(spark, low, high), log, MISS_LIMIT)
    return reg.queue.read().select("brn", "status", "batch_id")


_VERIFIED = """v AS (SELECT cr_no, trim(coalesce(name_zh, '')) AS name_zh, trim(coalesce(name_en, '')) AS name_en,
                         trim(coalesce(address_raw, '')) AS address_raw FROM {verify_answers} WHERE outcome_http = 'ok'),
c AS (SELECT v.* FROM v LEFT JOIN {day1} r ON r.cr_no = v.cr_no WHERE r.cr_no IS NULL OR v.name_zh <> trim(coalesce(r.name_zh, ''))
      OR v.name_en <> trim(coalesce(r.name_en, '')) OR v.address_raw <> trim(coalesce(r.address_raw, '')))"""


def _verified(spark, sf):
    reg, day1 = _registry(spark, "verify"), frame(spark, sf, "day1")
    reg.raw.write(columns.stamp(day1, RUN_TS))
    reg.master.write(day1)
    reg.queue.write(day1.select(F.col("cr_no").alias("brn"), F.lit("hit").alias("status")))
    flows.verify_hits(reg, frame(spark, sf, "verify_answers"), dt.datetime(2024, 3, 1))
    return reg


@query(
    f"""WITH {_VERIFIED}
SELECT cr_no, name_zh, name_en, address_raw, '2024-03-01 00:00:00' AS fetched_at FROM c
UNION ALL SELECT cr_no, name_zh, name_en, address_raw, '2024-01-02 03:04:05' FROM {{day1}} d
WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.cr_no = d.cr_no)"""
)
def verify_hits(spark, sf):
    return _verified(spark, sf).raw.read().withColumn("fetched_at", F.col("fetched_at").cast("string"))


@query(
    f"""WITH {_VERIFIED}
SELECT d.cr_no, d.name_en, CASE WHEN c.cr_no IS NOT NULL THEN c.address_raw ELSE d.address_raw END AS address_raw,
  CASE WHEN c.cr_no IS NOT NULL THEN CAST(0 AS DOUBLE) END AS confidence, CASE WHEN c.cr_no IS NOT NULL THEN TRUE END AS manual_review
FROM {{day1}} d LEFT JOIN c ON c.cr_no = d.cr_no"""
)
def verify_hits_master(spark, sf):
    """Master rows of updated companies have the new address and nothing that came from the old one."""
    return _verified(spark, sf).master.read().select("cr_no", "name_en", "address_raw", "confidence", "manual_review")


@query(
    f"""WITH {_VERIFIED}
SELECT d.cr_no AS brn, 'hit' AS status, CASE WHEN v.cr_no IS NOT NULL THEN '2024-03-01 00:00:00' END AS queried_at
FROM {{day1}} d LEFT JOIN v ON v.cr_no = d.cr_no"""
)
def verify_hits_queue(spark, sf):
    """Keys that were answered, changed or not, are queried anew."""
    queue = _verified(spark, sf).queue.read()
    return queue.select("brn", "status", F.col("queried_at").cast("string").alias("queried_at"))


@query(
    f"""WITH usable AS (SELECT cr_no, max(upper(code)) AS label FROM {{tag_labels}} WHERE code <> 'zz' GROUP BY cr_no)
SELECT n.cr_no, coalesce({SECTION}, label) AS industry_tag,
  CASE WHEN {SECTION} IS NOT NULL THEN 'keyword' WHEN label IS NOT NULL THEN 'llm' END AS industry_method
FROM {{names}} n LEFT JOIN usable u ON u.cr_no = n.cr_no"""
)
def tag_industries(spark, sf):
    reg = _registry(spark, "tags")
    reg.master.write(frame(spark, sf, "names"))
    flows.tag_industries(reg, keywords(spark), frame(spark, sf, "tag_labels"))
    return reg.master.read().select("cr_no", "industry_tag", "industry_method")


@query(
    """SELECT 'P' || CAST(p_partkey AS VARCHAR) AS code, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE CAST(1 + p_partkey % 3 AS INTEGER) END AS level,
'' AS name_zh, p_name AS name_en, CASE WHEN p_partkey % 6 <> 0 THEN p_type END AS parent_code FROM {part} WHERE p_partkey % 4 = 0 OR p_partkey % 7 <> 0"""
)
def load_codes(spark, sf):
    reg = _registry(spark, "codes")
    bodies = frame(spark, sf, "code_bodies")
    flows.load_codes(reg, bodies)
    return flows.load_codes(reg, bodies)


# --- streams ---


def _landed(df, spark, name, files=4):
    """The frame as files of a stream source."""
    folder = scratch_dir(spark, name) + "/in"
    df.repartition(files).write.parquet(folder)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(folder)


# Files of a part that lands in order.
FILES = 16


def _in_order(df, spark, name, column, parts=4):
    """The frame as files of a stream source that land in ``parts``, ranges of ``column`` in order, each as so many
    files and taken by one micro-batch; a step lands those of one half (0 or 1) and gives the stream.

    The frame is computed once, and many tasks write a part. A micro-batch takes a fixed number of files, so parts
    have equally many; where one has too few rows to fill them, all are one file."""
    staged, folder = scratch_dir(spark, name) + "/staged", scratch_dir(spark, name) + "/in"
    df.write.parquet(staged)
    rows = spark.read.schema(df.schema).parquet(staged)
    low, high = rows.agg(F.min(column), F.max(column)).first()
    number = F.floor((F.col(column) - F.lit(low)) * F.lit(parts) / (high - low + 1))
    place = F.pmod(F.xxhash64(column), F.lit(FILES)).cast("int")
    filled = rows.groupBy(number.alias("part")).agg(F.count_distinct(place).alias("n")).where(F.col("n") == FILES).count()
    files = FILES if filled == parts else 1

    def land(half):
        for part in range(half * parts // 2, (half + 1) * parts // 2):
            here = rows.where(number == part)
            here = here.repartitionById(files, place) if files > 1 else here.coalesce(1)
            here.write.mode("append").parquet(folder)
        return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(folder)

    return land


def _runs_of_stream(spark, sf):
    """Outcomes counted by a query that ends half way and goes on from its checkpoint."""
    land, base = _in_order(frame(spark, sf, "outcomes"), spark, "runs", "seq"), scratch_dir(spark, "runs-out")
    for half in (0, 1):
        counted = miss_run_stream(land(half), MISS_LIMIT)
        (
            counted.writeStream.format("parquet").option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        )
    return spark.read.schema(counted.schema).parquet(f"{base}/out")


@query(f"WITH {_RUNS} SELECT * FROM counted")
def stream_miss_runs(spark, sf):
    return _runs_of_stream(spark, sf).drop("queried_at")


@query(f"WITH {_RUNS} SELECT * FROM stats")
def stream_batch_stats(spark, sf):
    return scan.batch_stats(_runs_of_stream(spark, sf))


@query("SELECT brn AS cr_no, CAST(queried_at AS VARCHAR) AS fetched_at FROM {outcomes} WHERE status = 'hit'")
def stream_hits(spark, sf):
    """The hit rows of every micro-batch as the hook gets them."""
    rows = frame(spark, sf, "outcomes").withColumn("queried_at", F.col("queried_at").cast("timestamp")).withColumn("cr_no", F.col("brn"))
    base = scratch_dir(spark, "hits")

    def keep(hits, epoch):
        hits.select("cr_no", "fetched_at").write.mode("overwrite").parquet(f"{base}/hits/epoch={epoch}")

    ingest.ingest_outcomes(_landed(rows, spark, "hit-stream"), f"{base}/log", f"{base}/checkpoint", keep).awaitTermination()
    hits = spark.read.schema("cr_no string, fetched_at timestamp").parquet(f"{base}/hits")
    return hits.select("cr_no", F.col("fetched_at").cast("string").alias("fetched_at"))


@query(
    f"""WITH {_RUNS} SELECT o.brn, coalesce(c.status, 'pending') AS status, c.batch_id FROM {{outcomes}} o
LEFT JOIN (SELECT * FROM counted WHERE status <> 'pending') c ON c.brn = o.brn"""
)
def stream_scan_queue(spark, sf):
    """The queue after a streamed scan whose batches stop at the miss limit: what came later stays pending."""
    rows = frame(spark, sf, "outcomes").withColumn("queried_at", F.col("queried_at").cast("timestamp"))
    land, base = _in_order(rows, spark, "scan-stream", "seq"), scratch_dir(spark, "scan-out")
    reg = flows.Registry.at(spark, base)
    reg.queue.write(scan.enqueue(reg.queue.read(), rows))
    hits = []
    for half in (0, 1):
        ingest.ingest_outcomes(
            land(half), f"{base}/log", f"{base}/checkpoint", lambda df, epoch: hits.append(epoch), miss_limit=MISS_LIMIT
        ).awaitTermination()
        ingest.fold(reg, f"{base}/log")
    assert hits == sorted(set(hits))
    return reg.queue.read().select("brn", "status", "batch_id")


def _stream_ingest(spark, sf):
    rows = frame(spark, sf, "outcomes").select(
        F.expr("lpad(CAST(seq div 25 AS STRING), 8, '0')").alias("brn"), "status",
        F.col("queried_at").cast("timestamp").alias("queried_at"), "batch_id",
        F.expr("lpad(CAST(seq div 25 AS STRING), 8, '0')").alias("cr_no"), F.col("brn").alias("name_en"),
    )
    base = scratch_dir(spark, "ingest")
    reg = flows.Registry.at(spark, base)
    reg.queue.write(scan.enqueue(reg.queue.read(), rows))
    ingest.ingest_outcomes(_landed(rows, spark, "outcomes"), f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return ingest.fold(reg, f"{base}/log")


_KEYED_OUTCOMES = "o AS (SELECT printf('%08d', seq // 25) AS k, brn, status, queried_at, batch_id FROM {outcomes})"


@query(
    f"WITH {_KEYED_OUTCOMES} SELECT k AS cr_no, brn AS name_en, CAST(queried_at AS VARCHAR) AS fetched_at FROM o WHERE status = 'hit' "
    "QUALIFY row_number() OVER (PARTITION BY k ORDER BY queried_at DESC) = 1"
)
def stream_ingest(spark, sf):
    _, raw = _stream_ingest(spark, sf)
    return raw.select("cr_no", "name_en", F.col("fetched_at").cast("string").alias("fetched_at"))


@query(
    f"WITH {_KEYED_OUTCOMES}, d AS (SELECT * FROM o WHERE status <> 'pending' QUALIFY row_number() OVER (PARTITION BY k ORDER BY queried_at DESC) = 1) "
    "SELECT a.k AS brn, coalesce(d.status, 'pending') AS status, d.batch_id FROM (SELECT DISTINCT k FROM o) a LEFT JOIN d USING (k)"
)
def stream_queue(spark, sf):
    queue, _ = _stream_ingest(spark, sf)
    return queue.select("brn", "status", "batch_id")


def _to_parquet(stream, spark, name):
    base = scratch_dir(spark, name)
    (
        stream.writeStream.format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


@query("SELECT DISTINCT user_id FROM {events}")
def stream_dedupe(spark, sf):
    events = frame(spark, sf, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    firsts = ingest.drop_repeats(_landed(events, spark, "events"), "ts", "4000 days", "user_id")
    return _to_parquet(firsts, spark, "firsts").select("user_id")


@query(
    """WITH b AS (SELECT body_id, value FROM {registry_bodies} WHERE json_valid(value) AND json_type(value) = 'ARRAY'),
r AS (SELECT body_id, unnest(from_json(value, '["JSON"]')) AS j FROM b)
SELECT body_id, j ->> '$.Brn' AS cr_no, j ->> '$.English_Company_Name' AS name_en FROM r"""
)
def stream_records(spark, sf):
    bodies = _landed(frame(spark, sf, "registry_bodies"), spark, "bodies")
    records = columns.rename_fields(landed.registry_records(bodies))
    return _to_parquet(records.select("body_id", "cr_no", "name_en"), spark, "records")


def _stream_geocode(spark, sf):
    rows = columns.stamp(frame(spark, sf, "companies"), RUN_TS)
    base = scratch_dir(spark, "geostream")
    reg = flows.Registry.at(spark, base)
    addresses = geocode.distinct_addresses(geocode.with_clean_address(rows))
    reg.cache.write(geocode.cache_rows(addresses.join(_answers(rows), "address_hash"), RUN_TS))
    raw = _landed(rows, spark, "rawstream")
    ingest.geocode_stream(raw, reg, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return reg, f"{base}/log"


@query(_resolved("{companies}"))
def stream_geocode(spark, sf):
    _, log = _stream_geocode(spark, sf)
    return ingest.landed_log(spark, log, "master", schemas.MASTER).select(*_SHOWN)


@query(_resolved("{companies}"))
def stream_master(spark, sf):
    """Landed master rows folded into the master; folding again, from the remembered number, adds nothing."""
    reg, log = _stream_geocode(spark, sf)
    ingest.fold(reg, log)
    ingest.fold(reg, log)
    return reg.master.read().select(*_SHOWN)


# Row k is fetched k seconds after the start; an answer comes 200 to 800 seconds after its address was first met
# (hex digits of the hash), or 1000 before. Answers count from 300 seconds before a row to 500 after it.
_LATE = """cleaned AS (SELECT *, nullif(sha1(address_clean), sha1('')) AS address_hash, CAST(cr_no AS BIGINT) AS second
    FROM (SELECT *, {clean} AS address_clean FROM {{companies}}) c),
answered AS (SELECT address_hash, min(second) + CASE WHEN substr(address_hash, 4, 1) = '7' THEN -1000 ELSE 200 + 100 * (ascii(substr(address_hash, 4, 1)) % 7) END AS told
    FROM cleaned WHERE substr(address_hash, 1, 1) <= '9' GROUP BY address_hash)""".format(clean=clean_sql("address_raw"))


def _late_rows(spark, sf):
    second = lambda n: (F.lit(RUN_TS).cast("timestamp").cast("long") + n).cast("timestamp")
    rows = frame(spark, sf, "companies").withColumn("at", F.col("cr_no").cast("bigint"))
    rows = rows.withColumn("fetched_at", second(F.col("at")))
    met = rows.withColumn("address_hash", text_hash(clean_address(F.col("address_raw")))).groupBy("address_hash").agg(F.min("at").alias("met"))
    digit = F.substring("address_hash", 4, 1)
    later = F.when(digit == "7", -1000).otherwise(200 + 100 * (F.ascii(digit) % 7))
    told = _answers(rows).join(met, "address_hash").withColumn("told", F.col("met") + later)
    return rows, told.withColumn("answered_at", second(F.col("told"))).drop("met")


@query(
    f"""WITH {_LATE}
SELECT c.cr_no, CASE WHEN a.told IS NOT NULL THEN 'G' || substr(c.address_hash, 1, 6) END AS geo_address,
  CASE WHEN a.told IS NOT NULL THEN CAST(ascii(substr(c.address_hash, 2, 1)) AS DOUBLE) END AS confidence, a.told IS NULL AS pending
FROM cleaned c LEFT JOIN answered a ON a.address_hash = c.address_hash AND a.told BETWEEN c.second - 300 AND c.second + 500"""
)
def stream_late_answers(spark, sf):
    """Rows and answers as two streams, ended half way and resumed; rows without an answer in time are pending."""
    rows, told = _late_rows(spark, sf)
    land_rows, land_answers = _in_order(rows, spark, "late-rows", "at"), _in_order(told, spark, "late-answers", "told")
    base = scratch_dir(spark, "late")
    reg, log = flows.Registry.at(spark, base), f"{base}/log"
    for half in (0, 1):
        raw, answers = land_rows(half), land_answers(half)
        query_ = ingest.late_geocode_stream(
            raw.drop("at"), answers.drop("told"), log, f"{base}/checkpoint", wait="500 seconds", keep="300 seconds", delay="60 seconds"
        )
        query_.awaitTermination()
    ingest.fold(reg, log)
    found = reg.master.read().select("cr_no", "geo_address", "confidence", F.lit(False).alias("pending"))
    rest = ingest.unanswered(rows, log)
    return found.unionByName(rest.select("cr_no", F.lit(None).cast("string").alias("geo_address"), F.lit(None).cast("double").alias("confidence"), F.lit(True).alias("pending")))
