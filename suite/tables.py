"""Queries on keyed tables, snapshots, columns and re-verification."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.operators import columns, digests, keyed, verify
from rollbook.session import scratch_dir
from rollbook.sources import landed, snapshots
from rollbook.sources.bucketed import BucketedTable
from rollbook.sources.tables import KeyedTable
from suite.inputs import frame
from suite.registry import query

NOW = dt.datetime(2024, 3, 1)
NOW_TEXT = "2024-03-01 00:00:00"

_FOUR = ("cr_no", "name_zh", "name_en", "address_raw")


def _delta_sql(comparison: str) -> str:
    same = " AND ".join(f"o.{c} {comparison} n.{c}" for c in _FOUR)
    return f"SELECT * FROM {{day2}} n WHERE NOT EXISTS (SELECT 1 FROM {{day1}} o WHERE {same})"


@query(_delta_sql("="))
def snapshot_delta(spark, sf):
    return keyed.snapshot_delta(frame(spark, sf, "day2"), frame(spark, sf, "day1"))


@query(_delta_sql("IS NOT DISTINCT FROM"))
def snapshot_delta_nullsafe(spark, sf):
    return keyed.snapshot_delta(frame(spark, sf, "day2"), frame(spark, sf, "day1"), null_safe=True)


def _ranged(spark, sf, null_safe):
    base = scratch_dir(spark, "ranged")
    for day in ("day1", "day2"):
        digests.write_ranged(frame(spark, sf, day), f"{base}/{day}")
    return digests.ranged_delta(spark, f"{base}/day2", f"{base}/day1", null_safe=null_safe)


@query(_delta_sql("="))
def snapshot_delta_ranges(spark, sf):
    """Both days stored by key ranges; only ranges whose digests differ are compared."""
    return _ranged(spark, sf, False)


@query(_delta_sql("IS NOT DISTINCT FROM"))
def snapshot_delta_ranges_nullsafe(spark, sf):
    return _ranged(spark, sf, True)


def _bucketed(spark, sf, day):
    rows = frame(spark, sf, day)
    table = BucketedTable(spark, scratch_dir(spark, "bucketed"), rows.schema, "cr_no", 16)
    table.write(rows)
    return table


@query(_delta_sql("="))
def snapshot_delta_bucketed(spark, sf):
    """Both days stored in buckets of the key, compared without a shuffle."""
    return _bucketed(spark, sf, "day1").delta(_bucketed(spark, sf, "day2").read())


@query(_delta_sql("IS NOT DISTINCT FROM"))
def snapshot_delta_bucketed_nullsafe(spark, sf):
    return _bucketed(spark, sf, "day1").delta(_bucketed(spark, sf, "day2").read(), null_safe=True)


@query("SELECT cr_no, name_en FROM {day2} d WHERE NOT EXISTS (SELECT 1 FROM {day1} m WHERE m.cr_no = d.cr_no)")
def checkpoint_skip(spark, sf):
    """The second day's companies against a master built on the first day."""
    todo = keyed.without_keys(frame(spark, sf, "day2"), frame(spark, sf, "day1"))
    return todo.select("cr_no", "name_en")


@query(
    "SELECT cr_no, address_raw FROM {day2} d WHERE NOT EXISTS "
    "(SELECT 1 FROM {master} m WHERE m.cr_no = d.cr_no AND m.geo_address IS NOT NULL)"
)
def geocode_pending_rows(spark, sf):
    todo = keyed.pending_geocode(frame(spark, sf, "day2"), frame(spark, sf, "master"))
    return todo.select("cr_no", "address_raw")


@query(
    "SELECT cr_no, name_zh, name_en FROM {day1} UNION ALL SELECT cr_no, max(name_zh) AS name_zh, max(name_en) AS name_en "
    "FROM {day2} d WHERE NOT EXISTS (SELECT 1 FROM {day1} b WHERE b.cr_no = d.cr_no) GROUP BY cr_no"
)
def insert_ignore(spark, sf):
    base = frame(spark, sf, "day1").select("cr_no", "name_zh", "name_en")
    new = frame(spark, sf, "day2").select("cr_no", "name_zh", "name_en")
    return keyed.insert_ignore(base, new.unionAll(new), "cr_no")


# Two versions of some rows in one batch; the later one counts.
_BATCH = """batch AS (SELECT *, 1 AS ver FROM {day2}
UNION ALL SELECT cr_no, name_zh || '!', name_en, NULL, 2 FROM {day2} WHERE CAST(cr_no AS BIGINT) % 4 = 0),
last AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY cr_no ORDER BY ver DESC) = 1)"""


def _batch(spark, sf):
    day2 = frame(spark, sf, "day2")
    again = day2.where(F.col("cr_no").cast("bigint") % 4 == 0).select(
        "cr_no", F.concat("name_zh", F.lit("!")).alias("name_zh"), "name_en",
        F.lit(None).cast("string").alias("address_raw"), F.lit(2).alias("ver"),
    )
    return day2.withColumn("ver", F.lit(1)).unionByName(again)


_UPSERTED = f"""WITH {_BATCH}
SELECT coalesce(b.cr_no, u.cr_no) AS cr_no,
       CASE WHEN u.cr_no IS NOT NULL THEN u.name_zh ELSE b.name_zh END AS name_zh,
       CASE WHEN u.cr_no IS NOT NULL THEN u.name_en ELSE b.name_en END AS name_en,
       CASE WHEN u.cr_no IS NOT NULL THEN u.address_raw ELSE b.address_raw END AS address_raw
FROM {{day1}} b FULL JOIN last u ON b.cr_no = u.cr_no"""


@query(_UPSERTED)
def upsert_rows(spark, sf):
    return keyed.upsert(frame(spark, sf, "day1"), _batch(spark, sf), "cr_no", order_by=["ver"])


@query(_UPSERTED)
def upsert_rows_delta(spark, sf):
    return keyed.upsert(frame(spark, sf, "day1"), _batch(spark, sf), "cr_no", order_by=["ver"], form="delta")


@query(
    f"""WITH {_BATCH}
SELECT coalesce(b.cr_no, u.cr_no) AS cr_no,
       CASE WHEN b.cr_no IS NOT NULL THEN b.name_zh ELSE u.name_zh END AS name_zh,
       CASE WHEN b.cr_no IS NOT NULL THEN b.name_en ELSE u.name_en END AS name_en,
       CASE WHEN u.cr_no IS NOT NULL THEN u.address_raw ELSE b.address_raw END AS address_raw
FROM {{day1}} b FULL JOIN last u ON b.cr_no = u.cr_no"""
)
def upsert_narrow(spark, sf):
    """Known keys take the address only, as the raw table of old did."""
    return keyed.upsert(
        frame(spark, sf, "day1"), _batch(spark, sf), "cr_no", update_cols=["address_raw"], order_by=["ver"]
    )


@query(_UPSERTED)
def upsert_bucketed(spark, sf):
    """The next version of a table in buckets, written by the tasks that merged it."""
    return _bucketed(spark, sf, "day1").upsert(_batch(spark, sf), order_by=["ver"])


_UPDATED = (
    f"""WITH {_BATCH}
SELECT b.cr_no, CASE WHEN u.cr_no IS NOT NULL THEN u.name_zh ELSE b.name_zh END AS name_zh, b.name_en,
       CASE WHEN u.cr_no IS NOT NULL THEN u.address_raw ELSE b.address_raw END AS address_raw
FROM {{day1}} b LEFT JOIN last u ON b.cr_no = u.cr_no"""
)


@query(_UPDATED)
def update_bucketed(spark, sf):
    return _bucketed(spark, sf, "day1").update(_batch(spark, sf), ["name_zh", "address_raw"], order_by=["ver"])


@query(_UPDATED)
def update_by_key(spark, sf):
    return keyed.update_by_key(
        frame(spark, sf, "day1"), _batch(spark, sf), "cr_no", ["name_zh", "address_raw"], ["ver"]
    )


@query(f"WITH {_BATCH} SELECT cr_no, name_zh, name_en, address_raw, ver FROM last")
def latest_per_key(spark, sf):
    return keyed.latest_per_key(_batch(spark, sf), "cr_no", ["ver"])


# --- re-verification ---

_CLASSIFIED = """classified AS (
SELECT v.cr_no, trim(coalesce(v.name_zh, '')) AS name_zh, trim(coalesce(v.name_en, '')) AS name_en,
       trim(coalesce(v.address_raw, '')) AS address_raw,
       CASE WHEN outcome_http = 'gone' THEN 'gone' WHEN outcome_http <> 'ok' THEN 'error'
            WHEN r.cr_no IS NULL THEN 'new'
            WHEN trim(coalesce(v.name_zh, '')) <> trim(coalesce(r.name_zh, ''))
              OR trim(coalesce(v.name_en, '')) <> trim(coalesce(r.name_en, ''))
              OR trim(coalesce(v.address_raw, '')) <> trim(coalesce(r.address_raw, '')) THEN 'updated'
            ELSE 'unchanged' END AS outcome
FROM {verify_answers} v LEFT JOIN {day1} r ON v.cr_no = r.cr_no)"""


def classified(spark, sf):
    return verify.classify(frame(spark, sf, "verify_answers"), frame(spark, sf, "day1"))


@query(f"WITH {_CLASSIFIED} SELECT * FROM classified")
def classify_changes(spark, sf):
    return classified(spark, sf)


@query(
    f"WITH {_CLASSIFIED} SELECT "
    + ", ".join(f"count(*) FILTER (WHERE outcome = '{o}') AS {o}" for o in verify.OUTCOMES)
    + " FROM classified"
)
def verify_stats(spark, sf):
    return verify.verify_stats(classified(spark, sf))


@query(
    f"WITH {_CLASSIFIED} SELECT cr_no, name_zh, name_en, address_raw, '{NOW_TEXT}' AS fetched_at "
    "FROM classified WHERE outcome IN ('new', 'updated')"
)
def raw_changes(spark, sf):
    changes = verify.raw_changes(classified(spark, sf), NOW)
    return changes.withColumn("fetched_at", F.col("fetched_at").cast("string"))


def _master_full(spark, sf):
    return columns.stamp(
        columns.conform(
            frame(spark, sf, "master").withColumn("address_clean", F.upper("address_raw")), schemas.MASTER
        ),
        dt.datetime(2024, 1, 1),
        "last_updated",
    )


@query(
    f"""WITH {_CLASSIFIED}
SELECT m.cr_no, CASE WHEN c.cr_no IS NULL THEN m.address_raw ELSE c.address_raw END AS address_raw,
       CASE WHEN c.cr_no IS NULL THEN upper(m.address_raw) END AS address_clean,
       CASE WHEN c.cr_no IS NULL THEN geo_address END AS geo_address,
       CASE WHEN c.cr_no IS NULL THEN region END AS region, CASE WHEN c.cr_no IS NULL THEN district END AS district,
       CASE WHEN c.cr_no IS NULL THEN latitude END AS latitude, CASE WHEN c.cr_no IS NULL THEN longitude END AS longitude,
       CASE WHEN c.cr_no IS NULL THEN confidence ELSE 0 END AS confidence,
       CASE WHEN c.cr_no IS NULL THEN manual_review ELSE TRUE END AS manual_review,
       CASE WHEN c.cr_no IS NULL THEN '2024-01-01 00:00:00' ELSE '{NOW_TEXT}' END AS last_updated
FROM {{master}} m LEFT JOIN (SELECT * FROM classified WHERE outcome = 'updated') c ON m.cr_no = c.cr_no"""
)
def cascade_reset(spark, sf):
    reset = verify.cascade_reset(_master_full(spark, sf), classified(spark, sf), NOW)
    return reset.select(
        "cr_no", "address_raw", "address_clean", "geo_address", "region", "district", "latitude",
        "longitude", "confidence", "manual_review", F.col("last_updated").cast("string").alias("last_updated"),
    )


@query(
    f"""WITH {_CLASSIFIED}
SELECT q.brn, q.status, CASE WHEN c.cr_no IS NULL THEN CAST(q.queried_at AS VARCHAR) ELSE '{NOW_TEXT}' END AS queried_at
FROM {{queue}} q LEFT JOIN (SELECT * FROM classified WHERE outcome IN ('updated', 'unchanged')) c ON q.brn = c.cr_no"""
)
def touch_queue(spark, sf):
    touched = verify.touch_queue(frame(spark, sf, "queue"), classified(spark, sf), NOW)
    return touched.select("brn", "status", F.col("queried_at").cast("string").alias("queried_at"))


# --- columns ---


@query(
    'SELECT cr_no, name_en, coalesce(address_raw, CASE WHEN name_zh IS NULL THEN \'second\' END) AS address_raw, '
    'name_zh AS "Note-Text", CAST(NULL AS VARCHAR) AS name_zh, CAST(NULL AS VARCHAR) AS company_type, '
    "CAST(NULL AS VARCHAR) AS date_of_incorporation, CAST(NULL AS VARCHAR) AS re_domiciliation_date FROM {companies}"
)
def normalise_columns(spark, sf):
    odd = frame(spark, sf, "companies").select(
        F.col("cr_no").alias(" CompanyNo "), F.col("name_en").alias("nameEnglish"),
        F.when(F.col("name_zh").isNull(), "second").alias("registeredOfficeAddress"),
        F.col("address_raw").alias("Address"), F.col("name_zh").alias("Note-Text"),
    )
    return columns.normalise_columns(odd)


@query("SELECT cr_no, name_zh, re_domiciliation_date, cr_no AS other_field_x FROM "
       "(SELECT *, address_raw AS re_domiciliation_date FROM {companies}) d")
def rename_fields(spark, sf):
    return columns.rename_fields(
        frame(spark, sf, "companies").select(
            F.col("cr_no").alias("Brn"), F.col("name_zh").alias("Chinese_Company_Name"),
            F.col("address_raw").alias("Re-domiciliation_Date"), F.col("cr_no").alias("Other Field-X"),
        )
    )


@query('SELECT cr_no, name_en, cr_no AS "re-domiciliation_date" FROM {companies}')
def rename_verify_fields(spark, sf):
    return columns.rename_verify_fields(
        frame(spark, sf, "companies").select(
            F.col("cr_no").alias("Brn"), F.col("name_en").alias("English_Company_Name"),
            F.col("cr_no").alias("Re-domiciliation_Date"),
        )
    )


@query(
    "SELECT cr_no AS code, try_cast(substr(cr_no, 5) AS INTEGER) AS level, name_zh, name_en, "
    "CAST(NULL AS VARCHAR) AS parent_code FROM {companies} WHERE CAST(cr_no AS BIGINT) % 2 = 0 "
    "UNION ALL SELECT cr_no, NULL, name_zh, name_en, NULL FROM {companies} WHERE CAST(cr_no AS BIGINT) % 2 = 1"
)
def conform_schema(spark, sf):
    odd = F.col("cr_no").cast("bigint") % 2 == 1
    df = frame(spark, sf, "companies").select(
        "name_en", "name_zh", F.col("cr_no").alias("code"), F.lit("x").alias("extra"),
        F.when(odd, "bad").otherwise(F.substring("cr_no", 5, 4)).alias("level"),
    )
    return columns.conform(df, schemas.INDUSTRY_CODES)


@query("SELECT cr_no, '2024-03-01 00:00:00' AS fetched_at FROM {companies}")
def stamp_run(spark, sf):
    stamped = columns.stamp(frame(spark, sf, "companies").select("cr_no"), NOW)
    return stamped.select("cr_no", F.col("fetched_at").cast("string").alias("fetched_at"))


@query("SELECT cr_no, name_zh, address_raw FROM {day1} UNION ALL BY NAME SELECT name_zh, cr_no FROM {day2}")
def union_tolerant(spark, sf):
    first = frame(spark, sf, "day1").select("cr_no", "name_zh", "address_raw")
    return columns.union_all([first, frame(spark, sf, "day2").select("name_zh", "cr_no")])


# --- sources and sinks ---


@query(
    """WITH b AS (SELECT body_id, value FROM {registry_bodies} WHERE json_valid(value) AND json_type(value) = 'ARRAY'),
r AS (SELECT body_id, unnest(from_json(value, '["JSON"]')) AS j FROM b)
SELECT body_id, j ->> '$.Brn' AS cr_no, j ->> '$.Chinese_Company_Name' AS name_zh, j ->> '$.English_Company_Name' AS name_en,
       j ->> '$.Address_of_Registered_Office' AS address_raw, j ->> '$.Company_Type' AS company_type,
       j ->> '$.Date_of_Incorporation' AS date_of_incorporation, j ->> '$."Re-domiciliation_Date"' AS re_domiciliation_date FROM r"""
)
def parse_records(spark, sf):
    return columns.rename_fields(landed.registry_records(frame(spark, sf, "registry_bodies")))


_CODES = """WITH b AS (SELECT CAST(value AS JSON) AS v FROM {code_bodies}),
i AS (SELECT unnest(from_json(coalesce(CASE WHEN json_type(v) = 'ARRAY' THEN v END, v -> '$.data', v -> '$.records'), '["JSON"]')) AS j FROM b),
f AS (SELECT trim(coalesce(nullif((j ->> '$.code'), ''), (j ->> '$.sic_code'), '')) AS code, coalesce((j ->> '$.level'), '1') AS level_text,
             trim(coalesce(nullif((j ->> '$.name_zh'), ''), (j ->> '$.name_c'), '')) AS name_zh,
             trim(coalesce(nullif((j ->> '$.name_en'), ''), (j ->> '$.name_e'), '')) AS name_en,
             nullif(trim(coalesce((j ->> '$.parent_code'), '')), '') AS parent_code FROM i)
"""


@query(
    _CODES + "SELECT code, try_cast(level_text AS INTEGER) AS level, name_zh, name_en, parent_code FROM f "
    "WHERE code <> '' AND (name_zh <> '' OR name_en <> '') AND try_cast(level_text AS INTEGER) IS NOT NULL"
)
def parse_codes(spark, sf):
    return landed.classification_codes(frame(spark, sf, "code_bodies"))


@query(
    _CODES + "SELECT code, name_zh, name_en, parent_code, level_text FROM f "
    "WHERE code <> '' AND (name_zh <> '' OR name_en <> '') AND try_cast(level_text AS INTEGER) IS NULL"
)
def rejected_codes(spark, sf):
    return landed.rejected_codes(frame(spark, sf, "code_bodies"))


@query("SELECT cr_no, name_zh, name_en, address_raw FROM {companies}")
def snapshot_resume(spark, sf):
    """Write a dated snapshot, write another of the same day with resume, read back what is there."""
    base = scratch_dir(spark, "snapshots")
    snapshots.write_snapshot(frame(spark, sf, "companies"), base, "20240301")
    path = snapshots.write_snapshot(frame(spark, sf, "day2"), base, "20240301", resume=True)
    return snapshots.keep_known(snapshots.read_snapshot(spark, path))


@query("SELECT cr_no, name_zh, name_en, address_raw, CAST(NULL AS VARCHAR) AS batch FROM {companies} "
       "WHERE CAST(cr_no AS BIGINT) % 2 = 0")
def table_versions(spark, sf):
    """Write two versions of a table; read the latest under a schema with one more column."""
    day1 = frame(spark, sf, "companies")
    base = scratch_dir(spark, "table")
    table = KeyedTable(spark, base, day1.schema)
    table.write(day1)
    table.write(table.read().where(F.col("cr_no").cast("bigint") % 2 == 0))
    return KeyedTable(spark, base, schemas.columns("cr_no name_zh name_en address_raw batch")).read()


@query("SELECT cr_no AS raw_address, CASE WHEN name_en = '' THEN NULL ELSE name_en END AS expected_district FROM {companies}")
def csv_round_trip(spark, sf):
    df = frame(spark, sf, "companies").select(F.col("cr_no").alias("raw_address"), F.col("name_en").alias("expected_district"))
    return snapshots.read_address_csv(spark, snapshots.export_csv(df, scratch_dir(spark, "csv") + "/out"))
