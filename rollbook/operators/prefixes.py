"""A name-prefix search run to its end over a whole table of names.

The search service gives one page per prefix. A full page hides names, so the prefix is asked again with
every character of an alphabet appended, down to a greatest depth. Here all prefixes of a depth are one level:
the names still open are paged by an aggregate and a ranking per prefix, and only those under full prefixes
go on to the next level, which starts from a written table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv
from rollbook.operators.scan import expansion_characters, prefix_counts
from rollbook.sources.scratch import staged


@dataclass
class PrefixSearch:
    """``pages``: every answered row with ``prefix, depth, pos`` (place on its page, from 0); ``prefixes``:
    every prefix with an answer, its row count ``n`` and whether it was ``saturated``, ``expanded`` or, at the
    greatest depth, ``truncated``; ``levels``: per depth how many prefixes were asked and what came back."""

    pages: DataFrame
    prefixes: DataFrame
    levels: DataFrame

    def records(self, keep_parent_rows: bool = False) -> DataFrame:
        """Rows that count as found. Those of an expanded prefix are in the pages of its extensions, but for
        names that end there or go on with a character outside the alphabet; ``keep_parent_rows`` saves
        such of them as stood on its first page."""
        if keep_parent_rows:
            return self.pages
        return self.pages.join(self.prefixes.where("expanded").select("prefix"), "prefix", "left_anti")

    def complete(self) -> bool:
        """Whether no prefix was cut short at the greatest depth."""
        return self.prefixes.where("truncated").isEmpty()


def prefix_order(prefix: Column, characters: Sequence[str] | None = None) -> Column:
    """Places of a prefix's characters in the alphabet: an order in which an extension follows its prefix."""
    alphabet = F.array(*map(F.lit, characters or expansion_characters()))
    return F.transform(F.split(prefix, ""), lambda c: F.array_position(alphabet, c).cast("int"))


def _first_rows(opened: DataFrame, ranking: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows of each prefix with their place, from 0. The bound stands on the ranking itself,
    so that every task cuts its rows to ``n`` a prefix before they meet."""
    place = F.row_number().over(Window.partitionBy("prefix").orderBy(*ranking))
    return opened.withColumn("_place", place).where(F.col("_place") <= n).withColumn("pos", F.col("_place") - 1).drop("_place")


def search_to_end(
    names: DataFrame,
    column: str = "name_en",
    order_by: Sequence[str] = ("cr_no",),
    seeds: Sequence[str] | None = None,
    page_limit: int = fv.PREFIX_PAGE_LIMIT,
    max_depth: int = fv.PREFIX_MAX_DEPTH,
    characters: Sequence[str] | None = None,
) -> PrefixSearch:
    """Ask for all ``seeds`` (default: the alphabet), then for the extensions of every full prefix.

    A page has the first ``page_limit`` names by ``order_by``, then by the whole row. ``seeds`` have depth 0
    and one length. Null and empty names begin with no prefix; repeated rows count as often as they come.
    Each level works on the names below the full prefixes of the one before, not on the whole table, and a
    prefix with very many names is cut to a page in each task before its rows meet.
    """
    alphabet = list(dict.fromkeys(characters or expansion_characters()))
    asked = list(dict.fromkeys(seeds or alphabet))
    widths = {len(s) for s in asked}
    if len(widths) != 1 or 0 in widths or page_limit < 1 or max_depth < 0:
        raise ValueError("seeds must be of one length, the page limit 1 or more, the greatest depth 0 or more")
    width = widths.pop()
    clash = {"prefix", "depth", "pos"} & {c.lower() for c in names.columns}
    if clash:
        raise ValueError(f"names has columns of the result: {', '.join(sorted(clash))}")
    ranking = [*order_by, *[c for c in names.columns if c not in order_by]]
    first = F.substring(F.col(column), 1, width)
    opened = names.withColumn("prefix", first).where(first.isin(asked))
    pages, prefixes, levels, n_asked = [], [], [], len(asked)
    for depth in range(max_depth + 1):
        page = _first_rows(opened, ranking, page_limit).withColumn("depth", F.lit(depth))
        page = staged(page.select("prefix", "depth", "pos", *names.columns), "prefix-page")
        counts = staged(prefix_counts(page, page_limit, max_depth), "prefix-counts")
        pages.append(page)
        prefixes.append(counts)
        levels.append(
            counts.agg(
                F.lit(depth).alias("depth"), F.lit(n_asked).cast("bigint").alias("asked"), F.count("*").alias("answered"),
                F.count_if("saturated").alias("saturated"), F.count_if("truncated").alias("truncated"),
                F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            )
        )
        full = counts.where("expanded").select("prefix")
        n_full = full.count()
        if not n_full:
            break
        n_asked = n_full * len(alphabet)
        below = opened.join(full, "prefix", "left_semi").drop("prefix")
        longer = F.substring(F.col(column), 1, width + depth + 1)
        goes_on = F.substring(F.col(column), width + depth + 1, 1).isin(alphabet)
        opened = staged(below.where(goes_on).withColumn("prefix", longer), "prefix-open")
    union = lambda frames: reduce(DataFrame.unionByName, frames)
    return PrefixSearch(union(pages), union(prefixes), union(levels))
