"""Frequent terms of company names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.functions.terms import bigrams, english_words


def bigram_counts(df: DataFrame, column: str = "name_zh") -> DataFrame:
    """Number of occurrences of each 2-character window."""
    return df.select(F.explode(bigrams(F.col(column))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def word_counts(df: DataFrame, column: str = "name_en") -> DataFrame:
    """Number of occurrences of each English word."""
    return df.select(F.explode(english_words(F.col(column))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def top_terms(counts: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` most frequent terms, equal counts in term order."""
    return counts.orderBy(F.desc("n"), "term").limit(n)


def mining_sample(untagged: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Names to mine: all of them, or the first ``max_rows`` by key where a bound is asked for."""
    names = untagged.select("cr_no", "name_zh", "name_en")
    return names if max_rows is None else names.orderBy("cr_no").limit(max_rows)
