"""Top terms kept day by day against counting everything."""

import random
from collections import Counter

import pytest

from rollbook.operators import top_terms


def stored(spark, base, days, size):
    for day, counts in days.items():
        frame = spark.createDataFrame(list(counts.items()), "term string, n bigint")
        top_terms.write_day(frame, base, day, size)


def want(days, n):
    total = Counter()
    for counts in days.values():
        total.update(counts)
    return sorted(total.items(), key=lambda x: (-x[1], x[0].encode()))[:n]


def got(spark, base, n, days=None):
    return [tuple(r) for r in top_terms.top_terms(spark, base, n, days).collect()]


@pytest.mark.parametrize("seed, size, n", [(1, 30, 10), (2, 5, 10), (3, 1, 3), (4, 400, 50), (5, 10, 1000)])
def test_top_terms_are_those_of_the_full_count(spark, tmp_path, seed, size, n):
    draw = random.Random(seed)
    days = {}
    for d in range(5):
        words = [f"w{int(draw.paretovariate(0.8)) % 300}" for _ in range(1500)] + [f"only{d}"] * draw.randrange(90)
        days[f"2024010{d}"] = Counter(words)
    stored(spark, str(tmp_path), days, size)
    assert got(spark, str(tmp_path), n) == want(days, n)
    some = {d: days[d] for d in list(days)[1:3]}
    assert got(spark, str(tmp_path), n, list(some)) == want(some, n)


def test_bounds_that_force_a_second_pass(spark, tmp_path):
    """A term that is in no day's small table is the most frequent of all."""
    days = {str(d): Counter({f"big{d}_{k}": 10 for k in range(3)} | {"spread": 9}) for d in range(4)}
    stored(spark, f"{tmp_path}/a", days, 3)
    assert top_terms.second_pass_needed(spark, f"{tmp_path}/a", 1)
    assert got(spark, f"{tmp_path}/a", 1) == [("spread", 36)]
    stored(spark, f"{tmp_path}/b", days, 4)
    assert not top_terms.second_pass_needed(spark, f"{tmp_path}/b", 1)
    assert got(spark, f"{tmp_path}/b", 2) == want(days, 2)


def test_wide_enough_tables_need_no_second_pass(spark, tmp_path):
    days = {str(d): Counter({"first": 500, "second": 300, **{f"t{d}_{k}": 5 + k % 3 for k in range(40)}}) for d in range(3)}
    stored(spark, str(tmp_path), days, 10)
    assert not top_terms.second_pass_needed(spark, str(tmp_path), 2)
    assert got(spark, str(tmp_path), 2) == [("first", 1500), ("second", 900)]


def test_days_empty_null_and_repeated(spark, tmp_path):
    base = str(tmp_path)
    assert got(spark, base, 5) == []
    top_terms.write_day(spark.createDataFrame([], "term string, n bigint"), base, "1")
    top_terms.write_day(spark.createDataFrame([(None, 9), ("", 2), ("a", 2)], "term string, n bigint"), base, "2", 1)
    assert top_terms.stored_days(spark, base) == ["1", "2"]
    assert got(spark, base, 5) == [("", 2), ("a", 2)] and got(spark, base, 0) == []
    with pytest.raises(ValueError):
        top_terms.write_day(spark.createDataFrame([("a", 1)], "term string, n bigint"), base, "2")
