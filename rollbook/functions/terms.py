"""Terms of company names for keyword mining."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv


def bigrams(text: Column) -> Column:
    """All 2-character windows of the text without blanks and listed punctuation.

    One regex pass: the lookahead captures the window, the match itself moves on by one code point,
    so the cost is linear in the length of the text.
    """
    kept = F.regexp_replace(text, f"(?U){fv.NGRAM_SKIP}", "")
    return F.regexp_extract_all(kept, F.lit("(?s)(?=(..))."), F.lit(1))


def english_words(text: Column) -> Column:
    """English words of three letters and more, title-cased."""
    found = F.regexp_extract_all(text, F.lit(fv.ENGLISH_TERM), F.lit(0))
    return F.transform(found, lambda word: F.initcap(F.lower(word)))
