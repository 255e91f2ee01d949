"""Rule sources: address corrections, section keywords, the built-in section table.

Rules are small frames, one JSON document each. Those that are compiled into column expressions pass
through the driver; where a form for many rules exists, their number is checked first (``collect_rules``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.functions import fixed_values as fv

_STRING_MAP = T.MapType(T.StringType(), T.StringType())
_STRING_LISTS = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def collect_rules(rules: DataFrame, limit: int) -> list | None:
    """The rules as rows, or None where there are more than ``limit`` of them."""
    rows = rules.take(limit + 1)
    return rows if len(rows) <= limit else None


def json_document(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def alias_rules(document: DataFrame, body: str = "value") -> DataFrame:
    """``ord, wrong, right`` of a JSON object; comment keys and keys with ASCII letters are skipped."""
    entries = document.select(
        F.posexplode(F.from_json(F.col(body), _STRING_MAP)).alias("ord", "wrong", "right")
    )
    return entries.where(~F.col("wrong").startswith("_") & ~F.col("wrong").rlike("[A-Za-z]"))


def correction_rules(aliases: DataFrame | None = None) -> list[tuple[str, str]]:
    """Built-in corrections followed by the alias rules, longest wrong form first."""
    rules = list(fv.ZH_CORRECTIONS)
    if aliases is not None:
        rules += [(row["wrong"], row["right"]) for row in aliases.orderBy("ord").collect()]
    return sorted(rules, key=lambda rule: len(rule[0]), reverse=True)


def keyword_rules(document: DataFrame, body: str = "value") -> DataFrame:
    """``section, section_ord, kw_ord, keyword`` of a JSON object section -> list of keywords."""
    sections = document.select(
        F.posexplode(F.from_json(F.col(body), _STRING_LISTS)).alias(
            "section_ord", "section", "keywords"
        )
    )
    return sections.select(
        "section", "section_ord", F.posexplode("keywords").alias("kw_ord", "keyword")
    )


def keyword_frame(spark: SparkSession, keywords: dict[str, Sequence[str]]) -> DataFrame:
    rows = [
        (section, section_ord, kw_ord, keyword)
        for section_ord, (section, words) in enumerate(keywords.items())
        for kw_ord, keyword in enumerate(words)
    ]
    schema = schemas.columns("section section_ord:int kw_ord:int keyword")
    return spark.createDataFrame(rows, schema)


def section_table(spark: SparkSession) -> DataFrame:
    """Sections as level-1 rows of the code table."""
    rows = [(code, 1, zh, en, None) for code, zh, en in fv.SECTIONS]
    return spark.createDataFrame(rows, schemas.INDUSTRY_CODES)


def default_keywords(spark: SparkSession) -> DataFrame:
    """Keywords by rule, for use without a keyword file: the parts of the section names.

    zh names are split at the list mark and at the word "and", en names at anything but letters;
    en parts shorter than four letters are left out. A curated list is a parameter: pass its JSON
    through ``keyword_rules``.
    """
    sections = spark.createDataFrame(
        [(ord_, *section) for ord_, section in enumerate(fv.SECTIONS)],
        schemas.columns("section_ord:int section name_zh name_en"),
    )
    zh = F.split("name_zh", "[、及]")
    en = F.filter(F.split("name_en", "[^A-Za-z]+"), lambda word: F.length(word) >= 4)
    return sections.select(
        "section", "section_ord", F.posexplode(F.concat(zh, en)).alias("kw_ord", "keyword")
    ).where(F.col("keyword") != "")


def save_keywords(rules: DataFrame, path: str) -> str:
    """One JSON line per section with its keywords in order."""
    (
        rules.groupBy("section", "section_ord")
        .agg(F.array_sort(F.collect_list(F.struct("kw_ord", "keyword"))).alias("items"))
        .select("section", "section_ord", F.col("items.keyword").alias("keywords"))
        .write.mode("overwrite")
        .json(path)
    )
    return path


def load_saved_keywords(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("section", T.StringType()),
            T.StructField("section_ord", T.IntegerType()),
            T.StructField("keywords", T.ArrayType(T.StringType())),
        ]
    )
    return spark.read.schema(schema).json(path).select(
        "section", "section_ord", F.posexplode("keywords").alias("kw_ord", "keyword")
    )
