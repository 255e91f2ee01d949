"""The prefix search against a recursive one over a list of names."""

import random

import pytest
from pyspark.sql import functions as F

from rollbook.operators import prefixes
from tests.conftest import as_set


def recursive(names, seeds, limit, depth_limit, alphabet):
    """Pages, and the truncated prefixes, of a search that asks one prefix after the other."""
    pages, truncated, found = {}, set(), []

    def ask(prefix, depth):
        page = sorted((cr, n) for cr, n in names if n is not None and n.startswith(prefix))[:limit]
        if page:
            pages[prefix] = (depth, page)
        if len(page) < limit or depth >= depth_limit:
            if len(page) == limit:
                truncated.add(prefix)
            found.extend(page)
            return
        for c in alphabet:
            ask(prefix + c, depth + 1)

    for s in seeds:
        ask(s, 0)
    return pages, truncated, sorted(found)


@pytest.mark.parametrize(("limit", "depth"), [(1, 2), (3, 0), (3, 3), (7, 6)])
def test_search_against_recursion(spark, limit, depth):
    draw = random.Random(limit * 10 + depth)
    alphabet = ["A", "B", "中", "2"]
    names = [("".join(draw.choice("0123456789") for _ in range(4)), "".join(draw.choice("AAB中2 c") for _ in range(draw.randint(0, 7)))) for _ in range(200)]
    names += [(f"h{i}", "AAAAAAAAA" + str(i)) for i in range(40)] + [("x", None), ("same", "AB"), ("same", "AB")]
    df = spark.createDataFrame(names, "cr_no string, name_en string")
    search = prefixes.search_to_end(df, page_limit=limit, max_depth=depth, characters=alphabet)
    pages, truncated, found = recursive(names, alphabet, limit, depth, alphabet)
    got = {}
    for r in search.pages.orderBy("prefix", "pos").collect():
        got.setdefault(r["prefix"], (r["depth"], []))[1].append((r["cr_no"], r["name_en"]))
    assert got == pages
    assert {r[0] for r in as_set(search.prefixes.where("truncated").select("prefix"))} == truncated
    assert search.complete() == (not truncated)
    assert sorted(map(tuple, search.records().select("cr_no", "name_en").collect())) == found
    assert search.records(keep_parent_rows=True).count() == sum(len(p) for _, p in pages.values())
    assert search.levels.agg(F.sum("answered")).first()[0] == len(pages)


def test_longer_seeds_and_empty_names(spark):
    df = spark.createDataFrame([("1", "ABC"), ("2", "ABD"), ("3", "AC")], "cr_no string, name_en string")
    search = prefixes.search_to_end(df, seeds=["AB", "ZZ"], page_limit=2, max_depth=1, characters=["C", "D"])
    assert as_set(search.records().select("prefix", "cr_no")) == [("ABC", "1"), ("ABD", "2")]
    assert as_set(search.levels) == [(0, 2, 1, 1, 0, 2), (1, 2, 2, 0, 0, 2)]
    none = prefixes.search_to_end(df.limit(0), page_limit=2)
    assert none.pages.isEmpty() and none.complete() and as_set(none.levels.select("asked", "n_rows")) == [(66, 0)]
    for seeds, limit in ((["A", "AB"], 2), ([""], 2), (["A"], 0)):
        with pytest.raises(ValueError):
            prefixes.search_to_end(df, seeds=seeds, page_limit=limit)
    with pytest.raises(ValueError):
        prefixes.search_to_end(df.withColumn("Prefix", F.lit(1)))


def test_a_page_is_cut_before_its_rows_meet(spark):
    df = spark.createDataFrame([(str(i), "A") for i in range(30)], "cr_no string, prefix string")
    page = prefixes._first_rows(df, ["cr_no"], 2)
    assert page.count() == 2
    plan = page._jdf.queryExecution().executedPlan().treeString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")
