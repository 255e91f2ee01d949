"""Landed JSON responses -> rows. Every function takes batch and streaming frames alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.functions.keys import non_empty


def read_bodies(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file, column ``value``."""
    return spark.read.text(path, wholetext=True)


def stream_bodies(spark: SparkSession, path: str, **options) -> DataFrame:
    return spark.readStream.options(**options).text(path, wholetext=True)


def _is_list(body: Column) -> Column:
    return F.json_array_length(body).isNotNull()


def registry_records(
    bodies: DataFrame, body: str = "value", fields: T.StructType = schemas.REGISTRY_RECORD
) -> DataFrame:
    """Registry records of response bodies, other columns kept.

    A body that is not a JSON list has no records: ``from_json`` alone would take a lone object for
    a list of one.
    """
    keep = [name for name in bodies.columns if name != body]
    records = F.explode(F.from_json(F.col(body), T.ArrayType(fields)))
    return (
        bodies.where(_is_list(F.col(body)))
        .select(*keep, records.alias("record"))
        .select(*keep, "record.*")
    )


def _code_items(bodies: DataFrame, body: str) -> DataFrame:
    items = T.ArrayType(schemas.CODE_ITEM)
    text = F.col(body)
    wrapped = F.from_json(text, schemas.nested(data=items, records=items))
    listed = F.when(_is_list(text), F.from_json(text, items)).otherwise(
        F.coalesce(wrapped["data"], wrapped["records"])
    )
    item = bodies.select(F.explode(listed).alias("item"))

    def first_of(*names: str) -> Column:
        filled = [non_empty(F.col(f"item.{name}")) for name in names]
        return F.trim(F.coalesce(*filled, F.lit("")))

    level_text = F.coalesce(F.col("item.level"), F.lit("1"))
    return item.select(
        first_of("code", "sic_code").alias("code"),
        level_text.try_cast("int").alias("level"),
        first_of("name_zh", "name_c").alias("name_zh"),
        first_of("name_en", "name_e").alias("name_en"),
        non_empty(first_of("parent_code")).alias("parent_code"),
        level_text.alias("level_text"),
    ).where((F.col("code") != "") & ((F.col("name_zh") != "") | (F.col("name_en") != "")))


def classification_codes(bodies: DataFrame, body: str = "value") -> DataFrame:
    """Code table rows of a list, or of the list under ``data``, else under ``records``."""
    return _code_items(bodies, body).where(F.col("level").isNotNull()).drop("level_text")


def rejected_codes(bodies: DataFrame, body: str = "value") -> DataFrame:
    """Items whose level is no whole number."""
    return _code_items(bodies, body).where(F.col("level").isNull()).drop("level")
