"""Keys, null-safe text comparison, conversions and display strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv
from rollbook.functions.text import strip_blanks


def text_hash(text: Column) -> Column:
    """sha1 hex of the UTF-8 text, the key of the geocode table."""
    return F.sha1(text.cast("binary"))


def numeric_key(number: Column) -> Column:
    """8-digit zero-padded key (longer numbers stay whole)."""
    return F.format_string(fv.KEY_FORMAT, number)


def key_kind(key: Column) -> Column:
    return F.when(F.upper(F.trim(key)).rlike(r"^\d+\z"), "numeric").otherwise("alpha")


def same_text(left: Column, right: Column) -> Column:
    """Equal after blanks are taken off both ends, null counted as empty."""
    return strip_blanks(left) == strip_blanks(right)


def full_name(name_zh: Column, name_en: Column) -> Column:
    """zh name, a blank, en name; never null."""
    return F.concat(F.coalesce(name_zh, F.lit("")), F.lit(" "), F.coalesce(name_en, F.lit("")))


def non_empty(text: Column) -> Column:
    """Null instead of an empty string."""
    return F.nullif(text, F.lit(""))


def percent_text(share: Column) -> Column:
    return F.when(share.isNotNull(), F.format_string("%.1f%%", share * 100))


def one_decimal_text(value: Column) -> Column:
    return F.when(value.isNotNull(), F.format_string("%.1f", value))


def snake_header(name: str) -> str:
    return name.lower().replace(" ", "_").replace("-", "_")
