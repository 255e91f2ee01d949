"""Queries on industry tags, term mining and the reports over the master."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.terms import bigrams, english_words
from rollbook.operators import mining, reports, tagging, top_terms, trigrams
from rollbook.plans.registry import enrich_keywords as enrich
from rollbook.session import scratch_dir
from rollbook.sources import rules as rule_source
from suite.inputs import frame
from suite.registry import query

# Section order and keyword order both matter: "ring" beats "red", "red" beats "ECO".
KEYWORDS = {
    "C": ["ring", "old"],
    "F": ["red", "bolt", "Brand#1"],
    "G": ["ECO", "gizmo", ""],
    "K": ["large", "PROMO", "Brand#12"],
}
_NAME = "coalesce(name_zh, '') || ' ' || coalesce(name_en, '')"


def keywords(spark):
    body = spark.createDataFrame([(json.dumps(KEYWORDS),)], ["value"])
    return rule_source.keyword_rules(body)


def _case(result, fold=lambda text: text, words=None):
    arms = [
        f"WHEN contains({fold(_NAME)}, '{word if fold(_NAME) == _NAME else word.lower()}') THEN {result(section, word)}"
        for section, listed in (words or KEYWORDS).items()
        for word in listed
        if word
    ]
    return "CASE " + " ".join(arms) + " END"


SECTION = _case(lambda section, word: f"'{section}'")
KEYWORD = _case(lambda section, word: f"'{word}'")

_LONGEST = sorted(((s, w) for s, ws in KEYWORDS.items() for w in ws if w), key=lambda sw: -len(sw[1]))
LONGEST = "CASE " + " ".join(f"WHEN contains({_NAME}, '{w}') THEN '{s}'" for s, w in _LONGEST) + " END"


@query(f"SELECT cr_no, {SECTION} AS section FROM {{names}}")
def tag_keyword(spark, sf):
    return tagging.with_keyword_section(frame(spark, sf, "names"), keywords(spark)).select("cr_no", "section")


@query(f"SELECT cr_no, {_case(lambda s, w: repr(s), lambda t: f'lower({t})')} AS section FROM {{names}}")
def tag_keyword_ignore_case(spark, sf):
    tagged = tagging.with_keyword_section(frame(spark, sf, "names"), keywords(spark), ignore_case=True)
    return tagged.select("cr_no", "section")


@query(f"SELECT cr_no, {LONGEST} AS section FROM {{names}}")
def tag_keyword_longest(spark, sf):
    tagged = tagging.with_keyword_section(frame(spark, sf, "names"), keywords(spark), longest_match=True)
    return tagged.select("cr_no", "section")


@query(
    "SELECT cr_no, CASE WHEN regexp_matches(n, '\\b(ring|old)\\b') THEN 'C' WHEN regexp_matches(n, '\\b(red|bolt|Brand#1)\\b') THEN 'F' "
    "WHEN regexp_matches(n, '\\b(ECO|gizmo)\\b') THEN 'G' WHEN regexp_matches(n, '\\b(large|PROMO|Brand#12)\\b') THEN 'K' END AS section "
    f"FROM (SELECT cr_no, {_NAME} AS n FROM {{names}}) t"
)
def tag_keyword_words(spark, sf):
    tagged = tagging.with_keyword_section(frame(spark, sf, "names"), keywords(spark), word_boundary=True)
    return tagged.select("cr_no", "section")


_EXPLAINED = f"SELECT cr_no, {SECTION} AS section, {KEYWORD} AS keyword FROM {{names}} WHERE {SECTION} IS NOT NULL"


@query(_EXPLAINED)
def tag_explain(spark, sf):
    return tagging.tag_explain(frame(spark, sf, "names"), keywords(spark))


@query(_EXPLAINED)
def tag_explain_join(spark, sf):
    """With a keyword for every order besides, which no name holds."""
    more = frame(spark, sf, "orders").select(
        F.lit("Z").alias("section"), F.lit(99).alias("section_ord"), F.col("o_orderkey").cast("int").alias("kw_ord"),
        F.format_string("Order %d Ltd", F.col("o_orderkey")).alias("keyword"),
    )
    return tagging.tag_explain(frame(spark, sf, "names"), keywords(spark).unionByName(more))


_TWO_TIER = f"""usable AS (SELECT cr_no, max(upper(code)) AS label FROM {{tag_labels}} WHERE upper(code) BETWEEN 'A' AND 'S' AND length(code) = 1 GROUP BY cr_no),
tags AS (SELECT cr_no, coalesce(section, label) AS industry_tag, CASE WHEN section IS NOT NULL THEN 'keyword' ELSE 'llm' END AS industry_method,
  CASE WHEN section IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0.75 AS DOUBLE) END AS industry_conf, section IS NULL AS industry_review
  FROM (SELECT cr_no, {SECTION} AS section FROM {{names}}) n LEFT JOIN usable USING (cr_no) WHERE coalesce(section, label) IS NOT NULL)"""


def _tags(spark, sf):
    sections = rule_source.section_table(spark)
    return tagging.tags_for(frame(spark, sf, "names"), keywords(spark), sections, frame(spark, sf, "tag_labels"))


@query(f"WITH {_TWO_TIER} SELECT * FROM tags")
def tag_two_tier(spark, sf):
    return _tags(spark, sf).drop("industry_name_zh", "industry_name_en")


@query(
    f"WITH {_TWO_TIER} SELECT count(*) AS total_tagged, count(*) FILTER (WHERE industry_method = 'llm') AS llm_tagged, "
    "count(*) FILTER (WHERE industry_method = 'llm' AND industry_review) AS low_confidence FROM tags"
)
def tag_stats(spark, sf):
    return tagging.tag_stats(_tags(spark, sf))


@query("SELECT cr_no, upper(code) AS code FROM {tag_labels} WHERE code = 'zz'")
def unknown_labels(spark, sf):
    return tagging.unknown_labels(frame(spark, sf, "tag_labels"), rule_source.section_table(spark))


@query(
    "SELECT cr_no, industry_tag, CASE WHEN industry_name_zh IS NULL AND industry_tag = 'K' THEN '金融及保險業' "
    "WHEN industry_name_zh IS NULL AND industry_tag = 'F' THEN '建造業' ELSE industry_name_zh END AS industry_name_zh, "
    "CASE WHEN industry_name_zh IS NULL AND industry_tag = 'K' THEN 'Finance and Insurance' "
    "WHEN industry_name_zh IS NULL AND industry_tag = 'F' THEN 'Construction' ELSE industry_name_en END AS industry_name_en FROM {master}"
)
def tag_names(spark, sf):
    named = tagging.with_section_names(frame(spark, sf, "master"), rule_source.section_table(spark))
    return named.select("cr_no", "industry_tag", "industry_name_zh", "industry_name_en")


@query("SELECT cr_no, name_zh, name_en FROM {master} WHERE industry_tag IS NULL")
def untagged_rows(spark, sf):
    return tagging.untagged(frame(spark, sf, "master")).select("cr_no", "name_zh", "name_en")


@query(
    f"""WITH tags AS (SELECT cr_no, {SECTION} AS section FROM {{names}})
SELECT m.cr_no, coalesce(CASE WHEN m.industry_tag IS NULL THEN t.section END, m.industry_tag) AS industry_tag,
       CASE WHEN m.industry_tag IS NULL AND t.section IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE m.industry_conf END AS industry_conf
FROM {{master}} m LEFT JOIN tags t ON t.cr_no = m.cr_no"""
)
def write_tags(spark, sf):
    """Tags found for other names of the same keys, written into the untagged master rows only."""
    master = tagging.ensure_tag_columns(frame(spark, sf, "master"))
    todo = tagging.untagged(master).select("cr_no").join(frame(spark, sf, "names"), "cr_no")
    tags = tagging.tags_for(todo, keywords(spark), rule_source.section_table(spark))
    return tagging.write_tags(master, tags).select("cr_no", "industry_tag", "industry_conf")


# --- mining ---

_BIGRAMS = """bigrams AS (SELECT term, count(*) AS n FROM (
  SELECT unnest(list_transform(range(1, len(chars)), lambda i: chars[i] || chars[i + 1])) AS term FROM (
    SELECT regexp_extract_all(regexp_replace({column}, '[\\s（）()【】《》\\-—,，.。、]', '', 'g'), '(?s).') AS chars FROM {{{table}}}) c) b GROUP BY term)"""
_WORDS = """words AS (SELECT term, count(*) AS n FROM (
  SELECT upper(w[1]) || lower(w[2:]) AS term FROM (SELECT unnest(regexp_extract_all({column}, '[A-Za-z]{{3,}}')) AS w FROM {{{table}}}) t) b GROUP BY term)"""


@query("WITH " + _BIGRAMS.format(column="text", table="documents") + " SELECT term, n FROM bigrams ORDER BY n DESC, term LIMIT 200")
def mine_bigrams(spark, sf):
    return mining.top_terms(mining.bigram_counts(frame(spark, sf, "documents"), "text"), 200)


@query("WITH " + _WORDS.format(column="text", table="documents") + " SELECT term, n FROM words")
def mine_words(spark, sf):
    return mining.word_counts(frame(spark, sf, "documents"), "text")


@query("WITH " + _WORDS.format(column="text", table="documents") + " SELECT term, n FROM words ORDER BY n DESC, term LIMIT 50")
def top_words(spark, sf):
    return mining.top_terms(mining.word_counts(frame(spark, sf, "documents"), "text"), 50)


def _by_day(spark, counted, name, size):
    """Counts of each day's rows stored one day after the other; ``counted`` gives a day's."""
    base = scratch_dir(spark, name)
    for day in range(5):
        top_terms.write_day(counted(day), base, str(day), size)
    return base


@query("WITH " + _WORDS.format(column="text", table="documents") + " SELECT term, n FROM words ORDER BY n DESC, term LIMIT 100")
def top_words_by_day(spark, sf):
    """Documents come in five lots; the first terms of all are kept up to date by their small tables."""
    docs = frame(spark, sf, "documents")
    base = _by_day(spark, lambda day: mining.word_counts(docs.where(F.col("doc_id") % 5 == day), "text"), "words", top_terms.SIZE)
    return top_terms.top_terms(spark, base, 100)


@query("WITH " + _BIGRAMS.format(column="name_zh", table="names") + " SELECT term, n FROM bigrams ORDER BY n DESC, term LIMIT 60")
def top_bigrams_by_day(spark, sf):
    """Small tables too small to tell: the days' counts are read again down to a share of the border."""
    names = frame(spark, sf, "names")
    lot = F.col("cr_no").cast("bigint") % 5
    base = _by_day(spark, lambda day: mining.bigram_counts(names.where(lot == day)), "bigrams", 20)
    return top_terms.top_terms(spark, base, 60)


@query(
    "SELECT cr_no, upper(w[1]) || lower(w[2:]) AS word FROM (SELECT cr_no, unnest(regexp_extract_all(name_en, '[A-Za-z]{3,}')) AS w FROM {names}) t"
)
def name_words(spark, sf):
    return frame(spark, sf, "names").select("cr_no", F.explode(english_words(F.col("name_en"))).alias("word"))


@query(
    "SELECT cr_no, unnest(list_transform(range(1, length(s)), lambda i: substr(s, i, 2))) AS term FROM "
    "(SELECT cr_no, regexp_replace(name_zh, '[\\s\\-,.]', '', 'g') AS s FROM {names}) t"
)
def name_bigrams(spark, sf):
    return frame(spark, sf, "names").select("cr_no", F.explode(bigrams(F.col("name_zh"))).alias("term"))


@query("SELECT cr_no, name_zh, name_en FROM {master} WHERE industry_tag IS NULL ORDER BY cr_no LIMIT 500")
def mining_sample(spark, sf):
    return mining.mining_sample(tagging.untagged(frame(spark, sf, "master")), 500)


_RULE_ROWS = ", ".join(
    f"('{s}', {si}, {ki}, '{w}')" for si, (s, ws) in enumerate(KEYWORDS.items()) for ki, w in enumerate(ws)
)
_RULES = f"rules(section, section_ord, kw_ord, keyword) AS (VALUES {_RULE_ROWS})"


@query(
    f"""WITH {_RULES}, mined AS (SELECT p_name AS word, min(p_partkey) AS ord,
  CASE min(p_partkey) % 5 WHEN 0 THEN 'c' WHEN 1 THEN 'G' WHEN 2 THEN 'zz' WHEN 3 THEN 'K' ELSE 'f' END AS code FROM {{part}} GROUP BY p_name
  UNION ALL SELECT 'ring', 0, 'c' UNION ALL SELECT 'large', 0, 'K')
SELECT * FROM rules UNION ALL
SELECT section, section_ord, CAST(last + row_number() OVER (PARTITION BY section ORDER BY ord, word) AS INTEGER) AS kw_ord, word FROM (
  SELECT upper(code) AS section, word, ord FROM mined m WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.section = upper(m.code) AND r.keyword = m.word)) f
JOIN (SELECT section, min(section_ord) AS section_ord, max(kw_ord) AS last FROM rules GROUP BY section) e USING (section)"""
)
def merge_keywords(spark, sf):
    mined = frame(spark, sf, "part").groupBy(F.col("p_name").alias("word")).agg(F.min("p_partkey").alias("ord"))
    code = F.element_at(F.array(*map(F.lit, ["c", "G", "zz", "K", "f"])), (F.col("ord") % 5 + 1).cast("int"))
    known = spark.createDataFrame([("ring", 0, "c"), ("large", 0, "K")], "word string, ord bigint, code string")
    return tagging.merge_keywords(keywords(spark), mined.withColumn("code", code).unionByName(known))


@query(
    f"""WITH {_RULES}, {_WORDS.format(column="name_en", table="names")}, {_BIGRAMS.format(column="name_zh", table="names")},
zh AS (SELECT term, n, 0 AS en FROM bigrams ORDER BY n DESC, term LIMIT 20), en AS (SELECT term, n, 1 AS en FROM words ORDER BY n DESC, term LIMIT 20),
mined AS (SELECT term AS word, CASE WHEN term < 'a' THEN 'K' ELSE 'c' END AS code, n, en FROM (SELECT * FROM zh UNION ALL SELECT * FROM en) t)
SELECT * FROM rules UNION ALL
SELECT section, section_ord, CAST(last + row_number() OVER (PARTITION BY section ORDER BY en, n DESC, word) AS INTEGER) AS kw_ord, word FROM (
  SELECT upper(code) AS section, word, n, en FROM mined m WHERE NOT EXISTS (SELECT 1 FROM rules r WHERE r.section = upper(m.code) AND r.keyword = m.word)) f
JOIN (SELECT section, min(section_ord) AS section_ord, max(kw_ord) AS last FROM rules GROUP BY section) e USING (section)"""
)
def enrich_keywords(spark, sf):
    """Mine names, give the terms a section by a label table, merge, store and load again."""
    from rollbook.plans.registry import mine_terms

    terms = mine_terms(frame(spark, sf, "names"), 20)
    labels = terms.select(F.col("term").alias("word"), F.when(F.col("term") < "a", "K").otherwise("c").alias("code"))
    return enrich(keywords(spark), terms, labels, scratch_dir(spark, "keywords") + "/k")


# --- reports ---


@query(
    """SELECT count(*) AS master_total, count(*) FILTER (WHERE manual_review) AS manual_review, (SELECT count(*) FROM {geo_answers}) AS cache_size,
  1 - count(*) FILTER (WHERE manual_review) / count(*) AS hit_rate, avg(confidence) FILTER (WHERE confidence > 0) AS avg_confidence FROM {master}"""
)
def master_summary(spark, sf):
    summary = reports.master_summary(frame(spark, sf, "master"), frame(spark, sf, "geo_answers"))
    return summary.drop("hit_rate_text", "avg_confidence_text")


@query(
    """SELECT printf('%.1f%%', 100 * (1 - count(*) FILTER (WHERE manual_review) / count(*))) AS hit_rate_text,
  printf('%.1f', avg(confidence) FILTER (WHERE confidence > 0)) AS avg_confidence_text FROM {master}"""
)
def master_summary_text(spark, sf):
    summary = reports.master_summary(frame(spark, sf, "master"), frame(spark, sf, "geo_answers"))
    return summary.select("hit_rate_text", "avg_confidence_text")


@query("SELECT region, district, count(*) AS n FROM {master} GROUP BY region, district")
def district_counts(spark, sf):
    return reports.district_counts(frame(spark, sf, "master"))


@query("SELECT cr_no, name_zh, address_raw, confidence FROM {master} WHERE manual_review ORDER BY confidence NULLS LAST, cr_no LIMIT 20")
def review_queue(spark, sf):
    return reports.review_queue(frame(spark, sf, "master"))


@query("SELECT cr_no, name_zh, industry_tag, industry_conf FROM {master} WHERE industry_review ORDER BY industry_conf NULLS LAST, cr_no LIMIT 20")
def tag_review_queue(spark, sf):
    return reports.tag_review_queue(frame(spark, sf, "master"))


@query("SELECT cr_no, name_zh, name_en, address_raw, district FROM {master} WHERE name_zh LIKE '%MACH%' ORDER BY cr_no LIMIT 20")
def name_search(spark, sf):
    return reports.name_search(frame(spark, sf, "master"), "MACH")


_PATTERNS = ("TRADING 12", "7", "MEGA", "D AN", "99 ", "no such")


@query(
    "SELECT pattern, cr_no, name_en FROM {search_names}, (SELECT unnest(["
    + ", ".join(f"'{p}'" for p in _PATTERNS)
    + "]) AS pattern) p WHERE contains(name_en, pattern)"
)
def name_search_index(spark, sf):
    """All names that hold a pattern, by an index of trigrams."""
    path = scratch_dir(spark, "trigrams") + "/index"
    trigrams.write_index(frame(spark, sf, "search_names"), path, "name_en")
    found = [trigrams.search(spark, path, p, "name_en").select(F.lit(p).alias("pattern"), "cr_no", "name_en") for p in _PATTERNS]
    return reduce(DataFrame.unionAll, found)


@query("SELECT cr_no, name_zh, district, latitude, longitude FROM {master} WHERE district = 'NATION_7'")
def district_slice(spark, sf):
    return reports.in_district(frame(spark, sf, "master"), "NATION_7", ["cr_no", "name_zh", "district", "latitude", "longitude"])


@query("SELECT cr_no, latitude, longitude FROM {master} WHERE latitude IS NOT NULL")
def geocoded_slice(spark, sf):
    return reports.with_coordinates(frame(spark, sf, "master"), ["cr_no", "latitude", "longitude"])


@query("SELECT cr_no, name_en, district FROM {master} WHERE NOT manual_review")
def reviewed_slice(spark, sf):
    return reports.reviewed_only(frame(spark, sf, "master"), ["cr_no", "name_en", "district"])
