"""Industry tags from ordered keyword rules, with a table of labels as second tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions import fixed_values as fv
from rollbook.functions.keys import full_name
from rollbook.operators.columns import conform
from rollbook.operators.keyed import update_by_key
from rollbook.operators.matching import with_best_match

# Section tables of up to this many rows are broadcast.
MAX_BROADCAST_SECTIONS = 10_000

def _if_any(value: Column) -> Column:
    """One element, or none for null. Exploding it keeps the rows with a value and computes the value
    once; a filter on it would be pushed down and compute it twice."""
    return F.array_compact(F.array(value))


def _matched(names: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """``names`` with ``_match``; the options are those of ``matching.with_best_match``."""
    return with_best_match(names, "_match", full_name(F.col("name_zh"), F.col("name_en")), rules, **options)


def tag_explain(names: DataFrame, rules: DataFrame, key: str = "cr_no", **options) -> DataFrame:
    """``key, section, keyword`` of every row that matches."""
    found = _matched(names.select(key, "name_zh", "name_en"), rules, **options)
    return found.select(key, F.inline(_if_any(F.col("_match")))).select(key, "section", "keyword")


def with_keyword_section(names: DataFrame, rules: DataFrame, **options) -> DataFrame:
    """Adds ``section``, null where no keyword matches."""
    return _matched(names, rules, **options).withColumn("section", F.col("_match.section")).drop("_match")


def _small(sections: DataFrame) -> DataFrame:
    """A section table for a join: broadcast if a bounded count shows that it is small."""
    return F.broadcast(sections) if len(sections.take(MAX_BROADCAST_SECTIONS + 1)) <= MAX_BROADCAST_SECTIONS else sections


def usable_labels(labels: DataFrame, sections: DataFrame, key: str = "cr_no") -> DataFrame:
    """Labels with a known code, upper-cased, one per key (the greatest code of several)."""
    upper = labels.select(key, F.upper(F.trim("code")).alias("code"))
    known = upper.join(_small(sections.select("code")), "code", "left_semi")
    return known.groupBy(key).agg(F.max("code").alias("label"))


def unknown_labels(labels: DataFrame, sections: DataFrame, key: str = "cr_no") -> DataFrame:
    upper = labels.select(key, F.upper(F.trim("code")).alias("code"))
    return upper.join(_small(sections.select("code")), "code", "left_anti").select(key, "code")


def tags_for(
    untagged: DataFrame,
    rules: DataFrame,
    sections: DataFrame,
    labels: DataFrame | None = None,
    review_below: float = fv.TAG_REVIEW_BELOW,
    **options,
) -> DataFrame:
    """Tag columns by ``cr_no`` for the rows that get a tag: by keyword, else by label."""
    found = with_keyword_section(untagged.select("cr_no", "name_zh", "name_en"), rules, **options)
    if labels is None:
        found = found.withColumn("section", F.explode(_if_any(F.col("section")))).withColumn(
            "label", F.lit(None).cast("string")
        )
    else:
        found = found.join(usable_labels(labels, sections), "cr_no", "left")
    by_keyword = F.col("section").isNotNull()
    conf = F.when(by_keyword, F.lit(1.0)).otherwise(F.lit(fv.LABEL_CONFIDENCE))
    tagged = found.select(
        "cr_no",
        F.coalesce("section", "label").alias("industry_tag"),
        F.when(by_keyword, fv.METHOD_KEYWORD).otherwise(fv.METHOD_LABEL).alias("industry_method"),
        conf.alias("industry_conf"),
        (~by_keyword & (conf < F.lit(review_below))).alias("industry_review"),
    ).where(F.col("industry_tag").isNotNull())
    return with_section_names(tagged, sections)


def with_section_names(tagged: DataFrame, sections: DataFrame) -> DataFrame:
    """Section names where the zh name is missing.

    The section table is broadcast where it is small, so rows are not dealt out by their few tags; a table
    of finer codes may be passed too.
    """
    names = _small(
        sections.select(F.col("code").alias("industry_tag"), F.col("name_zh").alias("_zh"), F.col("name_en").alias("_en"))
    )
    have = [c for c in ("industry_name_zh", "industry_name_en") if c in tagged.columns]
    joined = tagged.join(names, "industry_tag", "left")
    kept = [c for c in tagged.columns if c not in have]
    if not have:
        return joined.select(*kept, F.col("_zh").alias("industry_name_zh"), F.col("_en").alias("industry_name_en"))
    fill = F.col("industry_name_zh").isNull() & F.col("_zh").isNotNull()
    return joined.select(
        *kept,
        F.when(fill, F.col("_zh")).otherwise(F.col("industry_name_zh")).alias("industry_name_zh"),
        F.when(fill, F.col("_en")).otherwise(F.col("industry_name_en")).alias("industry_name_en"),
    )


def untagged(master: DataFrame) -> DataFrame:
    return master.where(F.col("industry_tag").isNull())


def ensure_tag_columns(master: DataFrame) -> DataFrame:
    return conform(master, schemas.MASTER_TAGGED)


def write_tags(master: DataFrame, tags: DataFrame) -> DataFrame:
    """The master with the tags written in, and names filled in for rows tagged before."""
    return update_by_key(master, tags, "cr_no", [f.name for f in schemas.TAG_COLUMNS])


def tag_stats(tags: DataFrame) -> DataFrame:
    by_label = F.col("industry_method") == fv.METHOD_LABEL
    return tags.agg(
        F.count("*").alias("total_tagged"),
        F.count_if(by_label).alias("llm_tagged"),
        F.count_if(by_label & F.col("industry_review")).alias("low_confidence"),
    )


def merge_keywords(rules: DataFrame, assigned: DataFrame, allow_new_codes: bool = False) -> DataFrame:
    """Rules with assigned words ``ord, word, code`` appended to their sections.

    Codes are upper-cased. Words a section has are skipped; so are codes without a section, unless
    ``allow_new_codes`` (then sections are added after the last, in code order).
    """
    words = (
        assigned.where(F.col("word") != "")
        .groupBy(F.upper("code").alias("section"), F.col("word").alias("keyword"))
        .agg(F.min("ord").alias("ord"))
    )
    fresh = words.join(rules.select("section", "keyword"), ["section", "keyword"], "left_anti")
    ends = rules.groupBy("section").agg(F.max("section_ord").alias("section_ord"), F.max("kw_ord").alias("_last"))
    placed = fresh.join(ends, "section", "left" if allow_new_codes else "inner")
    if allow_new_codes:
        after = rules.agg(F.coalesce(F.max("section_ord"), F.lit(-1))).scalar()
        new_sections = fresh.select("section").join(ends, "section", "left_anti").distinct()
        order = new_sections.withColumn("_new", F.row_number().over(Window.orderBy("section")))
        placed = placed.join(order, "section", "left").withColumn(
            "section_ord", F.coalesce(F.col("section_ord"), after + F.col("_new"))
        )
    rank = F.row_number().over(Window.partitionBy("section").orderBy("ord", "keyword"))
    appended = placed.select(
        "section",
        F.col("section_ord").cast("int").alias("section_ord"),
        (F.coalesce("_last", F.lit(-1)) + rank).cast("int").alias("kw_ord"),
        "keyword",
    )
    return rules.select("section", "section_ord", "kw_ord", "keyword").unionByName(appended)
