"""Bitmap queues against sets of keys."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.operators import bitmaps, scan
from tests.conftest import as_set


def keys(df):
    got = [r[0] for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


EDGES = [0, 1, 31, 32, 32_766, 32_767, 32_768, 65_535, 65_536, 99_999_999, 100_000_000, 123_456_789_012]


def test_keys_round_trip(spark, rows):
    plain = [f"{n:08d}" for n in EDGES] + ["C0", "C32767", "C32768", "G1000000", "ZZ7"]
    odd = ["", "c1", "12", "C01", "000000012", "A B1", "1C", "X", "C1234567890123456789", None, "１２３４５６７８"]
    df = rows([(k,) for k in [*plain, *odd, *plain]], "brn string")
    assert keys(bitmaps.keys_in(bitmaps.key_bits(df))) == set(plain)
    assert as_set(bitmaps.numbered(df).where("number IS NULL").select("brn")) == sorted(((k,) for k in odd), key=str)


@pytest.mark.parametrize(("start", "end"), [(0, 0), (5, 4), (0, 32_767), (1, 32_768), (32_767, 98_304), (40_000, 41_000), (-1, 3)])
def test_ranges(spark, start, end):
    want = {f"{n:08d}" for n in range(start, end + 1)} if 0 <= start <= end else set()
    bits = bitmaps.range_bits(spark, start, end)
    assert keys(bitmaps.keys_in(bits)) == want and bitmaps.count(bits).first()[0] == len(want)
    if want and len(want) < 5000:
        got = keys(bitmaps.keys_in(bitmaps.range_bits(spark, start, end, ("C", "G"))))
        assert got == {f"{p}{n}" for p in "CG" for n in range(start, end + 1)}


def test_set_operations(spark, rows):
    draw = random.Random(4)
    a, b = ({draw.randint(0, 70_000) for _ in range(2_000)} | set(range(k, k + 3_000)) for k in (100, 33_000))
    made = [bitmaps.key_bits(rows([(f"{n:08d}",) for n in s], "brn string")) for s in (a, b)]
    names = lambda s: {f"{n:08d}" for n in s}
    assert keys(bitmaps.keys_in(bitmaps.union(*made))) == names(a | b)
    assert keys(bitmaps.keys_in(bitmaps.minus(*made))) == names(a - b)
    assert bitmaps.minus(*made).select(F.length("bits")).distinct().collect() == [(4096,)]


def test_queue_of_the_whole_key_space_stays_small(spark):
    every = bitmaps.candidate_bits(spark)
    assert every.count() == 3_052 + 11 * 93
    queue = bitmaps.BitmapQueue.of(spark.createDataFrame([("00000007", "hit"), ("C1000000", "miss")], "brn string, status string"))
    twice = queue.enqueue(every).enqueue(every)
    assert twice.queued.count() == every.count()
    assert twice.progress().first()[:] == (100_000_000 + 33_000_011 - 2, 1, 1)
    assert [r[0] for r in twice.next_pending(9).collect()] == [f"{n:08d}" for n in (0, 1, 2, 3, 4, 5, 6, 8, 9)]


def test_queue_as_the_row_form(spark, rows):
    draw = random.Random(8)
    time = dt.datetime(2024, 1, 1)
    data = [(f"{n:08d}", draw.choice(["pending", "hit", "miss"]), None, None) for n in draw.sample(range(40_000), 300)]
    queue = rows(data, schemas.SCAN_QUEUE)
    outcomes = rows(
        [(f"{draw.randint(0, 40_500):08d}", draw.choice(["hit", "miss", "pending"]), time + dt.timedelta(seconds=i), "x") for i in range(4_000)],
        schemas.SCAN_QUEUE,
    )
    new = scan.numeric_candidates(spark, 30_000, 40_100)
    by_rows = scan.apply_outcomes(scan.enqueue(queue, new), outcomes)
    bits = bitmaps.BitmapQueue.of(queue).enqueue(bitmaps.range_bits(spark, 30_000, 40_100)).apply(outcomes)
    assert as_set(bits.rows()) == as_set(by_rows.select("brn", "status"))
    assert bits.progress().first()[:] == scan.scan_progress(by_rows).select("pending", "hit", "miss").first()[:]
    pending = sorted(r[0] for r in by_rows.where("status = 'pending'").select("brn").collect())
    for n in (0, 1, 250, len(pending) + 5):
        assert [r[0] for r in bits.next_pending(n).collect()] == pending[:n]


def test_empty_queue(spark):
    none = bitmaps.BitmapQueue.of(spark.createDataFrame([], schemas.SCAN_QUEUE))
    assert none.progress().first()[:] == (0, 0, 0) and none.rows().isEmpty() and none.next_pending(3).isEmpty()
