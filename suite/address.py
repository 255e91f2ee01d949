"""Queries on addresses: cleaning, hashing, the geocode cache, geocode answers."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from rollbook.functions import text
from rollbook.functions.text import apply_corrections
from rollbook.operators import columns, geocode, reports
from rollbook.session import scratch_dir
from rollbook.sources import rules as rule_source
from suite.inputs import frame
from suite.registry import query

RUN_TS = dt.datetime(2024, 1, 2, 3, 4, 5)


def clean_sql(column: str, care_of: str = r"\bc/o\s+[^,]+") -> str:
    """The cleaning chain for ASCII text in RE2, which has no lookahead: the prefix words are
    taken off in a pass of their own and put back what follows them."""
    noise = "|".join(
        [
            r"HONG\s*KONG\s*SAR", r"HONG\s*KONG", r"\bNEW\s*KOWLOON\b", r"\bKOWLOON\b", r"\bNEW\s*TERRITORIES\b",
            r"\bISLANDS\s*DISTRICT\b", care_of, r"attn[:.]?\s*[^,]+", r"\b\d{8}\b", r"fax:?\s*[\d\-]+",
            r"tel:?\s*[\d\-]+", r"e-?mail:?\s*\S+", r"\bP\.?O\.?\s*Box\s*\d+",
        ]
    )
    out = rf"regexp_replace(coalesce({column}, ''), '^\s+|\s+$', '', 'g')"
    out = rf"regexp_replace({out}, '{noise}', ' ', 'gi')"
    out = rf"regexp_replace({out}, '\b(room|flat|unit)\s*(\d|[A-Z]\d)', ' \2', 'gi')"
    out = rf"regexp_replace({out}, ',\s*,+', ', ', 'g')"
    out = rf"regexp_replace({out}, '(\d{{1,3}}|B\d?|M|G)/F', '\1/F', 'gi')"
    for letter in "bmg":
        digit = r"\d?" if letter == "b" else ""
        out = rf"regexp_replace({out}, '{letter}({digit})/F', '{letter.upper()}\1/F', 'g')"
    return rf"trim(trim(trim(regexp_replace({out}, '\s+', ' ', 'g')), ',;./-'))"


CLEANED = "cleaned AS (SELECT *, nullif(sha1(address_clean), sha1('')) AS address_hash FROM (SELECT *, {c} AS address_clean FROM {{companies}}) d)".format(
    c=clean_sql("address_raw")
)


def cleaned(spark, sf):
    return geocode.with_clean_address(frame(spark, sf, "companies"))


@query(f"SELECT cr_no, address_raw, {clean_sql('address_raw')} AS address_clean FROM {{companies}}")
def clean_address(spark, sf):
    return cleaned(spark, sf).select("cr_no", "address_raw", "address_clean")


@query(f"SELECT cr_no, address_raw, {clean_sql('address_raw', r'c/?o\s+[^,]+')} AS address_clean FROM {{companies}}")
def clean_address_compat(spark, sf):
    df = geocode.with_clean_address(frame(spark, sf, "companies"), care_of="loose")
    return df.select("cr_no", "address_raw", "address_clean")


# Wide letters, digits, a circled digit, a ligature and half-width kana, and what NFKC makes of them.
_COMPAT, _PLAIN = "ＡＢ１２①ﬁｶﾞ", "AB121fiガ"


@query(f"SELECT doc_id, sha1('{_PLAIN} ' || nfc_normalize(text)) AS text_hash FROM {{documents}}")
def nfkc_clean(spark, sf):
    marked = F.concat(F.lit(f"{_COMPAT} "), F.col("text"))
    return frame(spark, sf, "documents").select("doc_id", F.sha1(text.nfkc(marked).cast("binary")).alias("text_hash"))


@query(f"SELECT cr_no, {clean_sql('address_raw')} AS address_clean FROM {{companies}}")
def clean_wide_address(spark, sf):
    """Addresses written with full-width digits and letters clean to the same text."""
    plain = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ,/"
    wide = "".join(chr(ord(c) + 0xFEE0) for c in plain)
    rows = frame(spark, sf, "companies").withColumn("address_raw", F.translate("address_raw", plain, wide))
    return geocode.with_clean_address(rows).select("cr_no", "address_clean")


@query(f"WITH {CLEANED} SELECT cr_no, address_hash FROM cleaned")
def address_hash(spark, sf):
    return cleaned(spark, sf).select("cr_no", "address_hash")


@query(
    f"WITH {CLEANED} SELECT address_hash, address_clean, count(*) AS n_rows FROM cleaned "
    "WHERE address_clean <> '' GROUP BY ALL"
)
def distinct_addresses(spark, sf):
    return geocode.distinct_addresses(cleaned(spark, sf))


# The stored results: one for the addresses whose hash starts with a decimal digit.
_CACHE = f"""{CLEANED},
addresses AS (SELECT address_hash, address_clean, count(*) AS n_rows FROM cleaned WHERE address_clean <> '' GROUP BY ALL),
cache AS (SELECT address_hash, address_clean, 'G' || substr(address_hash, 1, 6) AS geo_address,
                 CAST(ascii(substr(address_hash, 2, 1)) AS DOUBLE) AS score,
                 'R' || substr(address_hash, 3, 1) AS region, 'D' || substr(address_hash, 4, 2) AS district
          FROM addresses WHERE substr(address_hash, 1, 1) <= '9')"""


def cleaned_once(spark, sf):
    """Cleaned rows, written once and read by all that follows."""
    path = scratch_dir(spark, "cleaned") + "/rows"
    rows = cleaned(spark, sf)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def addresses_and_cache(spark, sf, rows=None):
    """Distinct addresses, and cache rows built from landed answers for some of them."""
    addresses = geocode.distinct_addresses(cleaned(spark, sf) if rows is None else rows)
    h = F.col("address_hash")
    answer = F.concat(
        F.lit('{"SuggestedAddress":[{"Address":{"PremisesAddress":{"GeoAddress":"G'), F.substring(h, 1, 6),
        F.lit('","ChiPremisesAddress":{"ChiRegion":"R'), F.substring(h, 3, 1),
        F.lit('","ChiDistrictBlock":{"ChiDistrict":"D'), F.substring(h, 4, 2),
        F.lit('"}}}},"ValidationInformation":{"Score":'), F.ascii(F.substring(h, 2, 1)).cast("string"), F.lit("}}]}"),
    )
    answered = addresses.where(F.substring(h, 1, 1) <= "9").withColumn("als_json", answer)
    return addresses, geocode.cache_rows(answered, RUN_TS)


@query(
    f"WITH {_CACHE} SELECT a.address_hash, a.address_clean, a.n_rows, c.address_hash IS NOT NULL AS cached "
    "FROM addresses a LEFT JOIN cache c USING (address_hash)"
)
def cache_probe(spark, sf):
    return geocode.probe_cache(*addresses_and_cache(spark, sf))


@query(
    f"WITH {_CACHE} SELECT count(*) AS distinct_addresses, count(c.address_hash) AS hits, "
    "count(*) - count(c.address_hash) AS misses FROM addresses a LEFT JOIN cache c USING (address_hash)"
)
def cache_probe_stats(spark, sf):
    return geocode.cache_stats(geocode.probe_cache(*addresses_and_cache(spark, sf)))


@query(
    f"WITH {_CACHE} SELECT address_hash, address_clean FROM addresses a "
    "WHERE NOT EXISTS (SELECT 1 FROM cache c WHERE c.address_hash = a.address_hash)"
)
def cache_misses(spark, sf):
    return geocode.cache_misses(*addresses_and_cache(spark, sf)).select("address_hash", "address_clean")


_ATTACHED = """SELECT r.cr_no, r.address_clean, c.geo_address, c.region, c.district,
       coalesce(c.score, 0) AS score, coalesce(c.score < 70, TRUE) AS manual_review
FROM cleaned r LEFT JOIN cache c USING (address_hash)"""


@query(f"WITH {_CACHE} {_ATTACHED}")
def attach_geocode(spark, sf):
    rows = cleaned_once(spark, sf)
    addresses, cache = addresses_and_cache(spark, sf, rows)
    attached = geocode.attach_geocode(rows, cache, addresses)
    return attached.select("cr_no", "address_clean", "geo_address", "region", "district", "score", "manual_review")


@query(f"WITH {_CACHE} {_ATTACHED}")
def attach_geocode_heavy(spark, sf):
    """The same with the frequent addresses dealt over salts (low bound, so that it happens here)."""
    rows = cleaned_once(spark, sf)
    _, cache = addresses_and_cache(spark, sf, rows)
    attached = geocode.attach_geocode(rows, cache, min_rows=50)
    return attached.select("cr_no", "address_clean", "geo_address", "region", "district", "score", "manual_review")


@query(
    f"""WITH {_CACHE}
SELECT cr_no, name_zh, name_en, address_raw, address_clean, geo_address, region, district,
       CAST(NULL AS VARCHAR) AS street_name, CAST(NULL AS VARCHAR) AS building_name,
       CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude,
       coalesce(score, 0) AS confidence, coalesce(score < 70, TRUE) AS manual_review,
       'LIMITED' AS company_type, CAST(NULL AS VARCHAR) AS date_of_incorporation,
       CAST(NULL AS VARCHAR) AS re_domiciliation_date, '2024-01-02 03:04:05' AS last_updated
FROM (SELECT * FROM cleaned) r LEFT JOIN (SELECT address_hash, geo_address, region, district, score FROM cache) c USING (address_hash)"""
)
def build_master(spark, sf):
    once = cleaned_once(spark, sf)
    addresses, cache = addresses_and_cache(spark, sf, once)
    rows = columns.normalise_columns(once.withColumn("company_type", F.lit("LIMITED")))
    built = geocode.build_master(geocode.attach_geocode(rows, cache, addresses), RUN_TS)
    return built.withColumn("last_updated", F.col("last_updated").cast("string"))


@query(
    f"""WITH {_CACHE}, attached AS ({_ATTACHED})
SELECT region, district, count(*) AS n, count(*) FILTER (WHERE manual_review) AS n_review,
       count(*) FILTER (WHERE manual_review) / count(*) AS review_share
FROM attached GROUP BY region, district"""
)
def district_review(spark, sf):
    """Flagship: companies and review share by district, from raw rows."""
    rows = cleaned_once(spark, sf)
    addresses, cache = addresses_and_cache(spark, sf, rows)
    return reports.district_review(geocode.attach_geocode(rows, cache, addresses))


@query(
    """WITH parsed AS (
  SELECT cr_no, CASE WHEN json_valid(als_json) THEN CAST(als_json AS JSON) END AS j FROM {geo_answers}),
top AS (SELECT cr_no, j -> '$.SuggestedAddress[0].Address.PremisesAddress' AS p,
               CASE WHEN (j -> '$.SuggestedAddress[0]') IS NOT NULL
                    THEN try_cast(coalesce(j ->> '$.SuggestedAddress[0].ValidationInformation.Score', '0') AS DOUBLE) END AS s FROM parsed),
block AS (SELECT *, coalesce(p -> '$.ChiPremisesAddress', p -> '$.EngPremisesAddress') AS b FROM top),
area AS (SELECT *, coalesce(b -> '$.ChiDistrictBlock', b -> '$.EngDistrictBlock') AS d FROM block)
SELECT cr_no, coalesce(s, 0) AS score,
  CASE WHEN s IS NOT NULL THEN p ->> '$.GeoAddress' END AS geo_address,
  CASE WHEN s IS NOT NULL THEN coalesce(nullif((b ->> '$.ChiRegion'), ''), b ->> '$.EngRegion') END AS region,
  CASE WHEN s IS NOT NULL THEN coalesce(nullif((d ->> '$.ChiDistrict'), ''), d ->> '$.EngDistrict') END AS district,
  CASE WHEN s IS NOT NULL THEN coalesce(nullif((b ->> '$.StreetBlock.ChiStreetName'), ''), b ->> '$.StreetBlock.EngStreetName') END AS street_name,
  CASE WHEN s IS NOT NULL THEN coalesce(nullif((b ->> '$.BuildingBlock.ChiBuildingName'), ''), b ->> '$.BuildingBlock.EngBuildingName') END AS building_name,
  CASE WHEN s IS NOT NULL THEN try_cast(p ->> '$.GeospatialInformation.Latitude' AS DOUBLE) END AS latitude,
  CASE WHEN s IS NOT NULL THEN try_cast(p ->> '$.GeospatialInformation.Longitude' AS DOUBLE) END AS longitude,
  coalesce(s, 0) < 70 AS manual_review
FROM area"""
)
def parse_geocode(spark, sf):
    parsed = geocode.parse_answers(frame(spark, sf, "geo_answers")).drop("als_json")
    return parsed.withColumn("manual_review", geocode.needs_review(F.col("score")))


# Alias rules come after the built-in ones of their length; the comment and the key with letters are skipped.
_ALIASES = {"_note": "x", "鰂漁涌站": "鰂魚涌港鐵站", "中環皇后": "皇后", "ABC": "y", "彌頓": "never", "皇后道": "皇后大道"}


def _corrected(column, rules):
    for wrong, right in rules:
        column = f"replace({column}, '{wrong}', '{right}')"
    return column


@query(
    "SELECT cr_no, "
    + _corrected(
        "address_zh",
        [("九廣鐵路", ""), ("鰂漁涌站", "鰂魚涌港鐵站"), ("中環皇后", "皇后"), ("鰂漁涌", "鰂魚涌"), ("皇后道", "皇后大道"),
         ("汪角", "旺角"), ("佐頓", "佐敦"), ("彌頓", "彌敦")],
    )
    + " AS address FROM {zh_addresses}"
)
def correct_zh_addresses(spark, sf):
    """Built-in corrections and those of an alias document, longest wrong form first."""
    document = spark.createDataFrame([(json.dumps(_ALIASES, ensure_ascii=False),)], "value string")
    rules = rule_source.correction_rules(rule_source.alias_rules(document))
    return frame(spark, sf, "zh_addresses").select("cr_no", apply_corrections(F.col("address_zh"), rules).alias("address"))
