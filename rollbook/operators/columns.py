"""Column renaming, padding and alignment."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rollbook import schemas
from rollbook.functions import fixed_values as fv
from rollbook.functions.keys import snake_header


def quoted(name: str) -> Column:
    """A column by its exact name, dots and hyphens included."""
    return F.col("`" + name.replace("`", "``") + "`")


def rename_fields(
    df: DataFrame, fields: Mapping[str, str] = fv.REGISTRY_FIELDS, other=snake_header
) -> DataFrame:
    """Known fields to their column names, the others through ``other`` (snake case)."""
    return df.select(*[quoted(c).alias(fields.get(c) or other(c)) for c in df.columns])


def rename_verify_fields(df: DataFrame) -> DataFrame:
    """Field names of re-verification responses; other names are lower-cased only."""
    return rename_fields(df, fv.VERIFY_FIELDS, str.lower)


def normalise_columns(
    df: DataFrame,
    aliases: Mapping[str, str] = fv.HEADER_ALIASES,
    required: Sequence[str] = schemas.REQUIRED_COLUMNS + schemas.EXTRA_COLUMNS,
) -> DataFrame:
    """Header aliases to column names, missing required columns as null strings.

    Several source columns for one target are merged, first non-null value in alias order.
    """
    rank = {alias: pos for pos, alias in enumerate(aliases)}
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(aliases.get(name.lower().strip(), name), []).append(name)
    out = []
    for target, names in sources.items():
        names.sort(key=lambda n: rank.get(n.lower().strip(), -1))
        merged = quoted(names[0]) if len(names) == 1 else F.coalesce(*map(quoted, names))
        out.append(merged.alias(target))
    out += [F.lit(None).cast("string").alias(c) for c in required if c not in sources]
    return df.select(*out)


def stamp(df: DataFrame, run_ts: dt.datetime | Column, column: str = "fetched_at") -> DataFrame:
    """One timestamp for the whole run; it is an argument so that a rerun gives the same rows."""
    value = run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    return df.withColumn(column, value.cast("timestamp"))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, in its order: cast where needed (null where that fails),
    null where missing, extras dropped."""
    have = {field.name: field.dataType for field in df.schema}

    def column(field: T.StructField) -> Column:
        if field.name not in have:
            return F.lit(None).cast(field.dataType).alias(field.name)
        if have[field.name] == field.dataType:
            return quoted(field.name)
        return quoted(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[column(field) for field in schema])


def union_all(frames: Sequence[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Union by column name, missing columns null; conformed to ``schema`` where one is given."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged if schema is None else conform(merged, schema)
