"""The scan queue of a dense key space as bitmaps.

Candidate keys are ranges of numbers, with or without a letter prefix. A set of them is a table
``prefix, bucket, bits`` with a row for every 32,768 numbers: 100 million keys are some 3,000 rows of 4 KB, and
queueing them again is a union of those rows. Keys of another form (leading zeros too few or too many, other
characters) have no number; ``numbered`` tells them apart, they stay rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rollbook.functions import fixed_values as fv
from rollbook.functions.keys import numeric_key
from rollbook.operators.keyed import latest_per_key
from rollbook.operators.scan import decided

#: Numbers to a row, and those to a word of 32 bits in it.
BUCKET = 32_768
_WORDS = BUCKET // 32
_KEY = ["prefix", "bucket"]


def _number(key: Column) -> Column:
    return F.try_to_number(F.regexp_extract(key, r"^[A-Z]*(\d{1,18})$", 1), F.lit("9" * 18)).cast("bigint")


def _prefix(key: Column) -> Column:
    return F.regexp_extract(key, "^([A-Z]*)", 1)


def key_of(prefix: Column, number: Column) -> Column:
    """The key of a number: eight digits or more without a prefix, else the prefix and its digits."""
    return F.when(prefix == "", numeric_key(number)).otherwise(F.concat(prefix, number.cast("string")))


def numbered(keys: DataFrame, column: str = "brn") -> DataFrame:
    """``keys`` with ``prefix`` and ``number``, null where the key is not the one of its number."""
    key = F.col(column)
    own = F.coalesce(key_of(_prefix(key), _number(key)) == key, F.lit(False))
    return keys.withColumns({"prefix": F.when(own, _prefix(key)), "number": F.when(own, _number(key))})


def key_bits(keys: DataFrame, column: str = "brn") -> DataFrame:
    """The set of all numbered keys; others, and null, are left out."""
    # Spark's buckets begin at 1; moved by one, number 0 is the first bit of a bucket.
    moved = F.col("number") + 1
    placed = numbered(keys, column).where(F.col("number").isNotNull())
    return placed.groupBy("prefix", F.bitmap_bucket_number(moved).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(moved)).alias("bits")
    )


def range_bits(spark: SparkSession, start: int, end: int, prefixes: Sequence[str] = ("",)) -> DataFrame:
    """The set of numbers start..end for each prefix, both included. Whole buckets are made as such, no row
    per key; only the first and the last may be made of their numbers."""
    if start < 0 or end < start:
        return spark.createDataFrame([], "prefix string, bucket bigint, bits binary")
    low, high = start // BUCKET, end // BUCKET
    first = F.greatest(F.col("id") * BUCKET, F.lit(start)) % BUCKET
    last = F.least(F.col("id") * BUCKET + (BUCKET - 1), F.lit(end)) % BUCKET
    buckets = spark.range(low, high + 1).select((F.col("id") + 1).alias("bucket"), first.alias("first"), last.alias("last"))
    partly = (F.col("first") > 0) | (F.col("last") < BUCKET - 1)
    edges = buckets.where(partly).select("bucket", F.explode(F.sequence("first", "last")).alias("at"))
    edges = edges.groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))
    whole = buckets.where(~partly).select("bucket", F.unhex(F.repeat(F.lit("F"), BUCKET // 4)).alias("bits"))
    letters = F.explode(F.array(*map(F.lit, prefixes))).alias("prefix")
    return whole.unionByName(edges).select(letters, "bucket", "bits")


def union(*sets: DataFrame) -> DataFrame:
    every = reduce(DataFrame.unionByName, [s.select(*_KEY, "bits") for s in sets])
    return every.groupBy(*_KEY).agg(F.bitmap_or_agg("bits").alias("bits"))


def _words(bits: Column) -> Column:
    """The bits as numbers of 32 bits, the first byte the highest."""
    text = F.rpad(F.coalesce(F.hex(bits), F.lit("")), BUCKET // 4, "0")
    return F.transform(F.sequence(F.lit(0), F.lit(_WORDS - 1)), lambda i: F.conv(F.substring(text, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint"))


def _without(bits: Column, others: Column) -> Column:
    return F.zip_with(_words(bits), _words(others), lambda a, b: a.bitwiseAND(F.bitwise_not(b)))


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Keys of ``left`` that ``right`` lacks. Buckets that ``right`` has nothing of stay as they are."""
    other = right.select(*_KEY, F.col("bits").alias("_other"))
    words = F.transform(_without(F.col("bits"), F.col("_other")), lambda w: F.lpad(F.hex(w), 8, "0"))
    rest = F.when(F.col("_other").isNull(), F.col("bits")).otherwise(F.unhex(F.array_join(words, "")))
    return left.select(*_KEY, "bits").join(other, _KEY, "left").select(*_KEY, rest.alias("bits"))


def count(bits: DataFrame) -> DataFrame:
    return bits.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))


def keys_in(bits: DataFrame, column: str = "brn") -> DataFrame:
    """A row per key of a set."""
    words = bits.select(*_KEY, F.posexplode(_words(F.col("bits"))).alias("word", "value")).where(F.col("value") != 0)
    # Place t of a word is bit t % 8 of its byte t / 8.
    shift = lambda t: (F.lit(24) - F.floor(t / 8) * 8 + t % 8).cast("int")
    is_set = lambda t: F.call_function("shiftright", F.col("value"), shift(t)).bitwiseAND(F.lit(1)) == 1
    placed = words.select(*_KEY, "word", F.explode(F.filter(F.sequence(F.lit(0), F.lit(31)), is_set)).alias("place"))
    number = (F.col("bucket") - 1) * BUCKET + F.col("word") * 32 + F.col("place")
    return placed.select(key_of(F.col("prefix"), number).alias(column))


@dataclass
class BitmapQueue:
    """A queue of numbered keys: those queued, and of them the hits and the misses."""

    queued: DataFrame
    hit: DataFrame
    miss: DataFrame

    @classmethod
    def of(cls, queue: DataFrame) -> BitmapQueue:
        """From queue rows ``brn, status``, a key each once; keys without a number are not in it."""
        return cls(key_bits(queue), *[key_bits(queue.where(F.col("status") == s)) for s in ("hit", "miss")])

    def enqueue(self, more: DataFrame) -> BitmapQueue:
        """With the set ``more`` queued as well; keys that are there keep their status."""
        return BitmapQueue(union(self.queued, more), self.hit, self.miss)

    def apply(self, outcomes: DataFrame, order_by: Sequence[str] = ("queried_at",)) -> BitmapQueue:
        """With decided outcomes written in, the latest of each key; keys that are not queued are ignored."""
        known = latest_per_key(decided(outcomes).select("brn", "status", *order_by), "brn", order_by)
        hits, misses = (key_bits(known.where(F.col("status") == s)) for s in ("hit", "miss"))
        hit = union(minus(self.hit, misses), self._within(hits))
        miss = union(minus(self.miss, hits), self._within(misses))
        return BitmapQueue(self.queued, hit, miss)

    def _within(self, bits: DataFrame) -> DataFrame:
        return minus(bits, minus(bits, self.queued))

    def pending(self) -> DataFrame:
        return minus(self.queued, union(self.hit, self.miss))

    def next_pending(self, n: int) -> DataFrame:
        """The first ``n`` pending keys by prefix and number. Counts per bucket find the buckets they lie in;
        only these are turned into keys."""
        open_ = self.pending().withColumn("n", F.bitmap_count("bits"))
        before = Window.orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, -1)
        # Rows of buckets, without their bits, in one place: one for 32,768 keys.
        counted = open_.select(*_KEY, "n").withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        near = open_.join(counted.where((F.col("before") < n) & (F.col("n") > 0)).select(*_KEY), _KEY, "left_semi")
        keys = numbered(keys_in(near))
        return keys.orderBy("prefix", "number").limit(n).select("brn")

    def progress(self) -> DataFrame:
        """``pending, hit, miss``: keys by status, from counts of bits."""
        sets = {"queued": self.queued, "done": union(self.hit, self.miss), "hit": self.hit, "miss": self.miss}
        counts = [s.select(F.lit(c).alias("of"), F.bitmap_count("bits").alias("n")) for c, s in sets.items()]
        total = lambda c: F.coalesce(F.sum(F.when(F.col("of") == c, F.col("n"))), F.lit(0))
        return reduce(DataFrame.unionByName, counts).agg(
            (total("queued") - total("done")).alias("pending"), total("hit").alias("hit"), total("miss").alias("miss")
        )

    def rows(self) -> DataFrame:
        """``brn, status`` of every key."""
        parts = [keys_in(s).withColumn("status", F.lit(c)) for c, s in (("pending", self.pending()), ("hit", self.hit), ("miss", self.miss))]
        return reduce(DataFrame.unionByName, parts)


def candidate_bits(
    spark: SparkSession,
    numbers: tuple[int, int] = fv.KEY_NUMERIC_RANGE,
    prefixes: Sequence[str] = fv.KEY_PREFIXES,
    prefixed: tuple[int, int] = fv.KEY_PREFIX_RANGE,
) -> DataFrame:
    """The whole key space of the registry: plain numbers and every prefix with its range."""
    return range_bits(spark, *numbers).unionByName(range_bits(spark, *prefixed, prefixes))
