"""Registry-shaped inputs derived from the given tables.

Each input is one SQL text valid in Spark and in DuckDB, so that a query and its check start from the
same rows. ``{name}`` stands for a given table or for another input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# A third of the companies share one address, as the clients of a large agent do.
_ADDRESS = """
    CASE WHEN c_custkey % 59 = 0 THEN NULL
         WHEN c_custkey % 53 = 0 THEN '   '
         WHEN c_custkey % 3 = 0 THEN '  Room 801, 8/f, CENTRAL PLAZA,, 18 HARBOUR ROAD, HONG KONG'
         WHEN c_custkey % 47 = 0 THEN 'c/o AGENT ' || CAST(c_custkey AS STRING) || ', ' || n_name || ' COURT, HONG KONG SAR'
         WHEN c_custkey % 43 = 0 THEN 'Flat B2, m/f, ' || n_name || ' HOUSE Tel: 2345-6789, NEW TERRITORIES'
         WHEN c_custkey % 37 = 0 THEN 'MARCO POLO HOUSE, ' || r_name || ' CO LTD, attn: Sales, KOWLOON'
         WHEN c_custkey % 11 = 0 THEN 'Unit ' || CAST(c_custkey % 40 AS STRING) || ', b1/f, P.O. Box 1234, ' || n_name || ' TOWER, 12345678'
         ELSE 'Room ' || CAST(c_custkey % 40 AS STRING) || ', ' || CAST(c_custkey % 30 AS STRING) || '/f, ' || n_name
              || ' TOWER,, ' || CAST(c_custkey % 97 AS STRING) || ' ' || r_name || ' ROAD, HONG KONG' END"""

INPUTS = {
    # Registry records of all companies.
    "companies": f"""
        SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS cr_no,
               CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE 'Z' || c_mktsegment END AS name_zh,
               c_name || ' ' || c_mktsegment || ' LIMITED' AS name_en,
               {_ADDRESS} AS address_raw
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey""",
    # Those of the first day: some come on the second day only.
    "day1": "SELECT * FROM {companies} WHERE CAST(cr_no AS BIGINT) % 23 <> 0",
    # zh addresses with wrong and old wording.
    "zh_addresses": """
        SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS cr_no,
               CASE c_custkey % 6 WHEN 0 THEN '九龍汪角彌頓道' || CAST(c_custkey AS STRING) || '號'
                    WHEN 1 THEN '佐頓九廣鐵路站' WHEN 2 THEN '鰂漁涌站' || c_mktsegment WHEN 3 THEN '鰂漁涌' || c_mktsegment || '佐頓'
                    WHEN 4 THEN NULL ELSE '中環皇后道' || CAST(c_custkey AS STRING) END AS address_zh
        FROM {customer}""",
    # The second day: some changed, some gone, some new, some with a name nulled.
    "day2": f"""
        SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS cr_no,
               CASE WHEN c_custkey % 31 = 0 OR c_custkey % 41 = 0 THEN NULL ELSE 'Z' || c_mktsegment END AS name_zh,
               c_name || ' ' || c_mktsegment || ' LIMITED' AS name_en,
               CASE WHEN c_custkey % 17 = 0 THEN 'Shop ' || CAST(c_custkey % 5 AS STRING) || ', g/f, ' || n_name || ' ARCADE'
                    ELSE {_ADDRESS} END AS address_raw
        FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
        WHERE c_custkey % 29 <> 0""",
    # Master rows with geocode results and review flags.
    "master": """
        SELECT d.cr_no, d.name_zh, d.name_en, d.address_raw,
               CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE 'G' || d.cr_no END AS geo_address,
               r_name AS region, n_name AS district,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 180 AS DOUBLE) / 2 END AS latitude,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 360 AS DOUBLE) / 2 END AS longitude,
               c_acctbal / 100 AS confidence,
               c_acctbal / 100 < 70 AS manual_review,
               CASE WHEN c_custkey % 4 = 0 THEN 'K' WHEN c_custkey % 4 = 1 THEN 'F' ELSE NULL END AS industry_tag,
               CASE WHEN c_custkey % 8 = 0 THEN 'set' ELSE NULL END AS industry_name_zh,
               CASE WHEN c_custkey % 8 = 0 THEN 'set' ELSE NULL END AS industry_name_en,
               CASE WHEN c_custkey % 4 = 0 THEN CAST(0.75 AS DOUBLE) WHEN c_custkey % 4 = 1 THEN CAST(1 AS DOUBLE) ELSE NULL END AS industry_conf,
               CASE WHEN c_custkey % 4 = 0 THEN TRUE WHEN c_custkey % 4 = 1 THEN FALSE ELSE NULL END AS industry_review
        FROM {companies} d JOIN {customer} ON lpad(CAST(c_custkey AS STRING), 8, '0') = d.cr_no
        JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # The scan queue.
    "queue": """
        SELECT lpad(CAST(o_orderkey AS STRING), 8, '0') AS brn,
               CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'hit' ELSE 'miss' END AS status,
               CASE WHEN o_orderstatus = 'O' OR o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END AS queried_at,
               CASE WHEN o_orderstatus = 'O' THEN NULL ELSE 'b' || CAST(o_custkey % 100 AS STRING) END AS batch_id
        FROM {orders}""",
    # Outcomes in the order they came in.
    "outcomes": """
        SELECT 'b' || CAST(user_id AS STRING) AS batch_id, user_id AS batch_no, event_id AS seq,
               lpad(CAST(event_id AS STRING), 8, '0') AS brn,
               CASE event_type WHEN 'purchase' THEN 'hit' WHEN 'error' THEN 'miss' WHEN 'view' THEN 'miss' ELSE 'pending' END AS status,
               ts AS queried_at
        FROM {events}""",
    # Geocoder answers in all the shapes they come in.
    "geo_answers": """
        SELECT lpad(CAST(c_custkey AS STRING), 8, '0') AS cr_no,
               CASE WHEN c_custkey % 19 = 0 THEN '{"SuggestedAddress":[]}'
                    WHEN c_custkey % 17 = 0 THEN '{"SuggestedAddress":[{"Address":'
                    WHEN c_custkey % 13 = 0 THEN NULL
                    ELSE '{"SuggestedAddress":[{"Address":{"PremisesAddress":{"GeoAddress":"G' || CAST(c_custkey AS STRING) || '","'
                      || CASE WHEN c_custkey % 5 = 0 THEN 'EngPremisesAddress' ELSE 'ChiPremisesAddress' END
                      || '":{"ChiRegion":"' || CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'Z' || r_name END || '","EngRegion":"' || r_name
                      || '","' || CASE WHEN c_custkey % 3 = 0 THEN 'EngDistrictBlock' ELSE 'ChiDistrictBlock' END
                      || '":{"EngDistrict":"' || n_name || '"},"StreetBlock":{"ChiStreetName":"' || c_mktsegment || ' ROAD"}'
                      || CASE WHEN c_custkey % 6 = 0 THEN '' ELSE ',"BuildingBlock":{"EngBuildingName":"' || c_name || '"}' END
                      || '},"GeospatialInformation":{"Latitude":"' || CAST(c_custkey % 90 AS STRING) || '.5","Longitude":' || CAST(c_custkey % 180 AS STRING) || '}}}'
                      || ',"ValidationInformation":{' || CASE WHEN c_custkey % 9 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN '"Score":"high"'
                           WHEN c_custkey % 23 = 0 THEN '"Score":"85f"' WHEN c_custkey % 29 = 0 THEN '"Score":"1d"'
                           ELSE '"Score":' || CAST(c_custkey % 100 AS STRING) END || '}},{"Address":{}}]}' END AS als_json
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey""",
    # Registry response bodies: lists of records, lone objects, empty lists, cut-off text.
    "registry_bodies": """
        SELECT s_suppkey AS body_id,
               CASE WHEN s_suppkey % 7 = 0 THEN '{"Brn":"x"}'
                    WHEN s_suppkey % 5 = 0 THEN '[]'
                    WHEN s_suppkey % 11 = 0 THEN '[{"Brn":"'
                    ELSE '[{"Brn":"' || lpad(CAST(s_suppkey AS STRING), 8, '0') || '","English_Company_Name":"' || s_name
                      || '","Re-domiciliation_Date":"2024-01-0' || CAST(1 + s_suppkey % 9 AS STRING) || '"},{"Brn":"S'
                      || CAST(s_suppkey AS STRING) || '","Chinese_Company_Name":"' || n_name || '"}]' END AS value
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey""",
    # Code table documents in the three layouts.
    "code_bodies": """
        SELECT p_partkey AS body_id,
               CASE WHEN p_partkey % 3 = 0 THEN '[' WHEN p_partkey % 3 = 1 THEN '{"data":[' ELSE '{"records":[' END
               || '{"' || CASE WHEN p_partkey % 2 = 0 THEN 'code' ELSE 'sic_code' END || '":" P' || CAST(p_partkey AS STRING) || ' ","'
               || CASE WHEN p_partkey % 5 = 0 THEN 'name_e' ELSE 'name_en' END || '":"' || p_name || '"'
               || CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN ',"level":"x"' ELSE ',"level":' || CAST(1 + p_partkey % 3 AS STRING) END
               || CASE WHEN p_partkey % 6 = 0 THEN ',"parent_code":""' ELSE ',"parent_code":"' || p_type || '"' END
               || '},{"code":"","name_zh":"no code"},{"code":"N' || CAST(p_partkey AS STRING) || '"}]'
               || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '}' END AS value
        FROM {part}""",
    # Names to tag.
    "names": """
        SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS cr_no,
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_name END AS name_zh,
               p_brand || ' ' || p_type AS name_en
        FROM {part}""",
    # Second-tier labels: mixed case, unknown codes, several for a key.
    "tag_labels": """
        SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS cr_no,
               CASE WHEN toxic = 1 THEN 'zz' WHEN quality = 1 THEN 'k' ELSE 'M' END AS code FROM {labels}
        UNION ALL
        SELECT lpad(CAST(doc_id AS STRING), 8, '0') AS cr_no, CASE WHEN toxic = 1 THEN 'g' ELSE 'G' END AS code FROM {labels} WHERE doc_id % 5 = 0""",
    # Names to search by prefix; a tenth share their first words, some are null, some go on with a blank.
    "search_names": """
        SELECT lpad(CAST(p_partkey AS STRING), 8, '0') AS cr_no,
               CASE WHEN p_partkey % 97 = 0 THEN NULL
                    WHEN p_partkey % 10 = 3 THEN 'MEGA TRADING ' || CAST(p_partkey AS STRING)
                    ELSE substr(upper(p_name), 1, 1) || reverse(CAST(p_partkey AS STRING)) || ' ' || upper(p_name) END AS name_en
        FROM {part}""",
    # Answers of a search that went down to four characters: up to a page of names for each prefix.
    "prefix_answers": """
        SELECT prefix, CAST(length(prefix) - 1 AS INT) AS depth, CAST(pos AS BIGINT) AS pos, cr_no, name_en
        FROM (
            SELECT prefix, cr_no, name_en, row_number() OVER (PARTITION BY prefix ORDER BY cr_no) AS pos
            FROM (
                SELECT substr(name_en, 1, 1) AS prefix, cr_no, name_en FROM {search_names} WHERE name_en IS NOT NULL
                UNION ALL SELECT substr(name_en, 1, 2) AS prefix, cr_no, name_en FROM {search_names} WHERE length(name_en) >= 2
                UNION ALL SELECT substr(name_en, 1, 3) AS prefix, cr_no, name_en FROM {search_names} WHERE length(name_en) >= 3
                UNION ALL SELECT substr(name_en, 1, 4) AS prefix, cr_no, name_en FROM {search_names} WHERE length(name_en) >= 4
            ) every_prefix
        ) ranked
        WHERE pos <= 20""",
    # Every name under each of its prefixes, without a page limit.
    "prefix_keys": """
        SELECT prefix, CAST(length(prefix) - 1 AS INT) AS depth,
               ascii(substr(prefix, 1, 1)) * 1000000 + ascii(substr(prefix || ' ', 2, 1)) * 1000 + ascii(substr(prefix || '  ', 3, 1)) AS prefix_ord,
               CAST(pos AS BIGINT) AS pos, cr_no, name_en
        FROM (
            SELECT prefix, cr_no, name_en, row_number() OVER (PARTITION BY prefix ORDER BY cr_no, name_en) AS pos
            FROM (
                SELECT substr(upper(p_name), 1, 1) AS prefix, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE lpad(CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS STRING), 8, '0') END AS cr_no, p_name AS name_en FROM {part}
                UNION ALL
                SELECT substr(upper(p_name), 1, 2) AS prefix, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE lpad(CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS STRING), 8, '0') END AS cr_no, p_name AS name_en FROM {part}
                UNION ALL
                SELECT substr(upper(p_name), 1, 3) AS prefix, CASE WHEN p_partkey % 50 = 0 THEN '' ELSE lpad(CAST(CAST(floor(p_partkey / 2) AS BIGINT) AS STRING), 8, '0') END AS cr_no, p_name AS name_en FROM {part}
            ) every_prefix
        ) ranked""",
    # Re-verification answers.
    "verify_answers": """
        SELECT cr_no, CASE WHEN k % 19 = 0 THEN 'gone' WHEN k % 37 = 0 THEN 'error' ELSE 'ok' END AS outcome_http,
               CASE WHEN k % 6 = 0 AND name_zh IS NULL THEN '' ELSE name_zh END AS name_zh,
               CASE WHEN k % 7 = 0 THEN ' ' || name_en || ' ' ELSE name_en END AS name_en, address_raw
        FROM (SELECT CAST(cr_no AS BIGINT) AS k, cr_no, name_zh, name_en, address_raw FROM {day2}) d""",
}

_PLACE = re.compile(r"\{([a-z][a-z_0-9]*)\}")


def needed(sql: str) -> list[str]:
    return list(dict.fromkeys(_PLACE.findall(sql)))


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is looked up in the file once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table or a derived input as a DataFrame."""
    if name in TABLES:
        return table(spark, sf_dir, name)
    return run(spark, sf_dir, INPUTS[name])


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = needed(sql)
    for name in names:
        frame(spark, sf_dir, name).createOrReplaceTempView(f"suite_{name}")
    return spark.sql(_PLACE.sub(lambda m: f"suite_{m.group(1)}", sql))


def check_sql(sql: str) -> str:
    """SQL for DuckDB with the inputs it uses as leading common table expressions."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in needed(text):
            if name in INPUTS and name not in order:
                visit(INPUTS[name])
                order.append(name)

    def plain(text: str) -> str:
        return _PLACE.sub(lambda m: m.group(1), text)

    visit(sql)
    ctes = [f"{name} AS ({plain(INPUTS[name])})" for name in order]
    body = plain(sql).strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
