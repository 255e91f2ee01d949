"""SimHash fingerprints of documents and search within a Hamming radius.

Terms are three words in a row (shorter at the end of a text), weighted by the length of their first word.
Each term's hash votes with its weight for or against each bit; the signs of the sums are the fingerprint.
Near fingerprints are found by block tables: two fingerprints within the radius are within a smaller one, of two
bits at most, on some block, so tables keyed by each block and asked for all bits that near miss none.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import let, text_or_empty, words, written

#: Bits of a fingerprint: two hashes of 64.
BITS = 128
TERM_WORDS = 3
#: Term lengths at which the weight rises by one.
WEIGHT_STEPS = (4, 8, 12)
#: Two counters share a long, 32 bits each: a text may have 2^30 terms of the greatest weight.
LANES = 32
#: Documents of a range in neighbour search, on average; ranges at most.
RANGE_ROWS = 500
MOST_RANGES = 10_000
#: Chosen Hamming radius.
RADIUS = 12
#: Bits of a block that a search flips at most, and keys a task makes.
MOST_FLIPPED = 2
TASK_KEYS = 500_000
#: Bits that a block may have: its number is kept above them.
KEY_BITS = 56


def terms(text: Column) -> Column:
    """Array of (a, b, c): every word with the two after it, null past the end."""
    return let(
        words(text),
        lambda w: F.arrays_zip(
            w.alias("a"), F.slice(w, F.lit(2), F.size(w)).alias("b"), F.slice(w, F.lit(3), F.size(w)).alias("c")
        ),
    )


def with_fingerprints(rows: DataFrame, keys: list[str], text_column: str = "text") -> DataFrame:
    """``keys`` of each row with ``fingerprint`` (hex string) of its text.

    ``keys`` must tell rows apart; a partitioning by some of them is used as it is. The votes are sums over
    exploded terms, so they run in generated code and shrink to a row a text before any shuffle. A text
    without words has no votes and the fingerprint of zeros; a tie of votes is a 0.
    """
    exploded = rows.select(*keys, F.explode_outer(terms(F.col(text_column))).alias("t"))
    length = F.char_length(F.coalesce("t.a", F.lit("")))
    weight = reduce(lambda a, b: a + b, [F.when(length >= n, 1).otherwise(0) for n in WEIGHT_STEPS], F.lit(1)).cast("long")
    hashed = exploded.select(
        *keys,
        F.when(F.col("t.a").isNull(), F.lit(0)).otherwise(weight).cast("long").alias("w"),
        F.xxhash64("t.a", "t.b", "t.c").alias("h0"),
        F.xxhash64(F.lit(1), "t.a", "t.b", "t.c").alias("h1"),
    )
    lane, low = (1 << 32) + 1, (1 << 32) - 1
    votes = [
        F.sum(F.shiftright(F.col(f"h{k}"), i).bitwiseAND(F.lit(lane)) * F.col("w")).alias(f"v{k}_{i}")
        for k in range(BITS // 64)
        for i in range(LANES)
    ]
    summed = hashed.groupBy(*keys).agg(F.sum("w").alias("total"), *votes)

    def half(k: int, high: bool) -> Column:
        # Bit i of a half is set if its votes for it are more than half of all.
        bits = []
        for i in range(LANES):
            v = F.col(f"v{k}_{i}")
            v = F.shiftrightunsigned(v, 32) if high else v.bitwiseAND(F.lit(low))
            bits.append(F.when(v * 2 > F.col("total"), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
        return F.lpad(F.hex(reduce(lambda a, b: a + b, bits)), 8, "0")

    parts = [half(k, high) for k in range(BITS // 64) for high in (True, False)]
    return summed.select(*keys, F.lower(F.concat(*parts)).alias("fingerprint"))


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs`` (``doc_id, text``), in rows of their own however often an
    id comes, null ids too: a fingerprint is that of a text, found once for each text of an id."""
    rows = docs.select("doc_id", "text", F.sha2(text_or_empty(F.col("text")), 256).alias("th"))
    texts = rows.groupBy("doc_id", "th").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    printed = with_fingerprints(texts, ["doc_id", "th", "copies"])
    return printed.select("doc_id", "fingerprint", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def _halves(fingerprint: Column) -> list[Column]:
    return [F.conv(F.substring(fingerprint, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(BITS // 32)]


def hamming(a: Column, b: Column) -> Column:
    """Number of bits in which two fingerprints differ."""
    return reduce(lambda x, y: x + y, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(_halves(a), _halves(b), strict=True)])


def likeness(a: Column, b: Column) -> Column:
    """Part of the bits in which two fingerprints agree: 1 for equal texts, about a half for unrelated ones."""
    return 1 - hamming(a, b) / F.lit(float(BITS))


def _n_below(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below a value: a binary search folded over powers of two."""
    if not bounds:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    powers = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])

    def step(found: Column, power: Column) -> Column:
        return F.when((found + power <= len(bounds)) & (F.get(table, found + power - 1) < value), found + power).otherwise(found)

    return F.aggregate(powers, F.lit(0), step)


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, next_text, range, place``: each document with the one next below its doc_id; after
    the last comes the first.

    Documents are sorted inside ranges of doc_id (null last); only the head of each range looks past it.
    Rows with one doc_id are ordered by text.
    """
    rows = docs.select("doc_id", text_or_empty(F.col("text")).alias("text"))
    n_ranges = max(1, min(MOST_RANGES, docs.count() // RANGE_ROWS))
    marks = [i / n_ranges for i in range(1, n_ranges)]
    bounds = docs.agg(F.percentile_approx("doc_id", marks, 20 * n_ranges).alias("b")).first()["b"] if marks else []
    bounds = sorted({int(b) for b in bounds or []})
    # Ranges descend as the order does; null ids are in the last.
    place = F.lit(len(bounds)) - _n_below(F.col("doc_id"), bounds)
    ranged = rows.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(place).cast("int"))
    order = (F.col("doc_id").isNull(), F.col("doc_id").desc(), F.col("text"))
    inside = Window.partitionBy("range").orderBy(*order)
    placed = ranged.withColumns({"place": F.row_number().over(inside), "lead_text": F.lead("text").over(inside)})
    heads = ranged.groupBy("range").agg(
        F.min_by("text", F.struct(F.col("doc_id").isNull(), -F.col("doc_id"), "text")).alias("head")
    )
    every = Window.partitionBy().orderBy("range")
    heads = heads.withColumn(
        "after",
        F.coalesce(F.lead("head").over(every), F.first("head").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))),
    ).select(F.col("range").alias("r"), "after")
    return placed.join(heads, (F.col("range") == F.col("r")) & F.col("lead_text").isNull(), "left").select(
        "doc_id", "text", F.coalesce("lead_text", "after").alias("next_text"), "range", "place"
    )


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has its last floor(n / 2) code points replaced by the first as many (or all) of the next
    document. One document alone is its own next. Null text is empty; repeated rows are rows of their own.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    keys = ["range", "place", "doc_id", "n_chars", "edited_sha256"]
    rows = with_next(docs).withColumn("edited", edited).select(
        *keys[:3],
        n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.posexplode(F.array("text", "edited")).alias("which", "shown"),
    )
    printed = with_fingerprints(rows, [*keys, "which"], "shown").groupBy(*keys).agg(
        *[F.max(F.when(F.col("which") == i, F.col("fingerprint"))).alias(c) for i, c in enumerate(("fingerprint", "edited_fingerprint"))]
    )
    out = written(printed, "simhash")
    inside = Window.partitionBy("range").orderBy("place")
    every = Window.partitionBy().orderBy("range")
    heads = out.filter("place = 1").select("range", "fingerprint")
    whole = every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.select(
        F.col("range").alias("r"),
        F.coalesce(F.lead("fingerprint").over(every), F.first("fingerprint").over(whole)).alias("after"),
    )
    placed = out.withColumn("lead_fp", F.lead("fingerprint").over(inside))
    following = F.coalesce("lead_fp", "after")
    return placed.join(heads, F.col("range") == F.col("r"), "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), following).alias("near_next"),
    )


def _ball(width: int, most: int) -> list[int]:
    """All numbers of ``width`` bits with at most ``most`` of them set."""
    return [sum(1 << i for i in bits) for k in range(most + 1) for bits in combinations(range(width), k)]


def blocks_for(n_queries: int, n_fingerprints: int, radius: int) -> list[tuple[int, int, int]]:
    """Blocks ``start, stop, most`` of the bits for a search: two fingerprints within the radius differ by at most
    ``most`` bits in some block, as they would differ by more than the radius in all if they differed by one more in each.

    Few wide blocks are asked for under many keys, many narrow ones meet many fingerprints by chance. The choice
    with least rows joined and compared is taken, so blocks widen with the tables; it changes no result.
    """

    def layout(n: int) -> list[tuple[int, int, int]]:
        cuts = [round(i * BITS / n) for i in range(n + 1)]
        each, more = divmod(radius + 1, n)
        return [(lo, hi, each - 1 + (i < more)) for i, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)) if each or i < more]

    def work(blocks: list[tuple[int, int, int]]) -> float:
        keys = [(sum(comb(hi - lo, k) for k in range(most + 1)), hi - lo) for lo, hi, most in blocks]
        met = sum(n / 2**width for n, width in keys)
        return n_fingerprints * len(blocks) + n_queries * sum(n for n, _ in keys) + n_queries * n_fingerprints * met

    fewest = max(3, -(-(radius + 1) // (MOST_FLIPPED + 1)))
    return min((layout(n) for n in range(fewest, max(fewest, radius + 1) + 1)), key=work)


def own_blocks(radius: int) -> list[tuple[int, int, int]]:
    """Blocks ``start, stop, most`` (2 or 0) for a search of fingerprints among themselves; as in ``blocks_for``, two
    within the radius differ by at most ``most`` bits in some block.

    Both sides ask and are stored under the same keys, their bits with none or one flipped, so two that differ by two
    bits meet under 1 + width keys a block instead of half its square. As many blocks as can are of that kind; the cut
    before the others is where fewest meet by chance. Keys a fingerprint are the same in tables of any size.
    """
    wide, narrow = divmod(radius + 1, 3)

    def even(start: int, stop: int, n: int, most: int) -> list[tuple[int, int, int]]:
        cuts = [start + round(i * (stop - start) / n) for i in range(n + 1)] if n else []
        return [(lo, min(hi, lo + KEY_BITS), most) for lo, hi in zip(cuts, cuts[1:], strict=False)]

    def met(blocks: list[tuple[int, int, int]]) -> float:
        return sum((1 + (hi - lo) * (most > 0)) ** 2 / 2 ** (hi - lo) for lo, hi, most in blocks)

    cuts = range(2 * wide, BITS - narrow + 1) if wide and narrow else [BITS if wide else 0]
    return min(([*even(0, cut, wide, 2), *even(cut, BITS, narrow, 0)] for cut in cuts), key=met)


def _bits(high: Column, low: Column, start: int, stop: int) -> Column:
    """Bits ``start`` to ``stop`` (less than 64) of a fingerprint given as two longs."""
    if stop <= 64:
        shifted = F.shiftrightunsigned(high, 64 - stop)
    elif start >= 64:
        shifted = F.shiftrightunsigned(low, 128 - stop)
    else:
        shifted = F.shiftleft(high, stop - 64).bitwiseOR(F.shiftrightunsigned(low, 128 - stop))
    return shifted.bitwiseAND(F.lit((1 << (stop - start)) - 1).cast("long"))


def _block(flip: Column) -> Column:
    """The number of the block that a flip is for."""
    return F.shiftrightunsigned(flip, KEY_BITS).cast("int")


def _as_longs(df: DataFrame) -> DataFrame:
    """The bits of the distinct fingerprints, ``high, low``."""
    rows = df.select("fingerprint").filter(F.col("fingerprint").isNotNull()).distinct()
    a, b, c, d = _halves(F.col("fingerprint"))
    return rows.select(F.shiftleft(a, 32).bitwiseOR(b).alias("high"), F.shiftleft(c, 32).bitwiseOR(d).alias("low"))


def _as_hex(high: Column, low: Column) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(part), 16, "0") for part in (high, low)]))


def candidates(queries: DataFrame, fingerprints: DataFrame, radius: int) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """Pairs that are near in some block, once for each such ``block``, with the blocks. The bits of a pair are
    ``query_high, query_low, fingerprint_high, fingerprint_low``.

    Fingerprints are stored under the bits of each block and queries ask under all bits that are near enough to theirs.
    If both are one frame, they meet under the keys of ``own_blocks``.
    """
    own = queries.sameSemantics(fingerprints)
    stored = written(_as_longs(fingerprints), "simhash-index")
    asked = stored if own else written(_as_longs(queries), "simhash-queries")
    n_stored = stored.count()
    n_asked = n_stored if own else asked.count()
    blocks = own_blocks(radius) if own else blocks_for(n_asked, n_stored, radius)

    def keyed(rows: DataFrame, n: int, name: str, most_flipped: list[int]) -> DataFrame:
        # A flip is a block's number and the bits to turn in it; the key has the number too.
        flips = [i << KEY_BITS | m for i, most in enumerate(most_flipped) for m in _ball(blocks[i][1] - blocks[i][0], most)]
        # Rows are dealt first, as few of them make many keys.
        spread = rows.repartition(max(1, n * len(flips) // TASK_KEYS), "high", "low")
        bits = F.array(*[_bits(F.col("high"), F.col("low"), lo, hi) for lo, hi, _ in blocks])
        flip = F.explode(F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>"))
        made = spread.select("high", "low", bits.alias("bits"), flip.alias("flip"))
        key = F.col("flip").bitwiseXOR(F.get("bits", _block(F.col("flip"))))
        return made.select(key.alias("key"), *[F.col(c).alias(f"{name}_{c}") for c in ("high", "low", "flip")])

    most = [b[2] for b in blocks]
    left = keyed(asked, n_asked, "query", [m // 2 for m in most] if own else most)
    right = keyed(stored, n_stored, "fingerprint", [m // 2 if own else 0 for m in most])
    # Sizes of tables are guessed without the keys a row makes: a side is not to be broadcast for that.
    pairs = left.hint("merge").join(right, "key")
    if own:
        # Equal bits meet under every key, others under two: the unflipped ones and one order of the flips count.
        a, b = F.col("query_flip"), F.col("fingerprint_flip")
        pairs = pairs.filter((a < b) | ((a == b) & (a == F.shiftleft(_block(a).cast("long"), KEY_BITS))))
    return pairs.withColumn("block", _block(F.col("query_flip"))), blocks


def near_fingerprints(queries: DataFrame, fingerprints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``query, fingerprint, distance``: for each distinct fingerprint of ``queries`` all distinct ones of
    ``fingerprints`` within ``radius`` bits, itself included; both have a column ``fingerprint`` (lower-case hex).

    Bits are cut into blocks (``blocks_for``; ``own_blocks`` if both are one frame) and fingerprints meet where
    their bits of a block are near enough. A pair that is near in several blocks is taken at the first of them only.
    Null fingerprints match nothing.
    """
    pairs, blocks = candidates(queries, fingerprints, radius)
    high, low = (F.col(f"query_{part}").bitwiseXOR(F.col(f"fingerprint_{part}")) for part in ("high", "low"))
    apart = F.bit_count(high) + F.bit_count(low)
    first = F.lit(True)
    for i, (lo, hi, most) in enumerate(blocks[:-1]):
        first = first & ((F.col("block") <= i) | (F.bit_count(_bits(high, low, lo, hi)) > most))
    bits = [f"{name}_{part}" for name in ("query", "fingerprint") for part in ("high", "low")]
    # Written, as filters on what comes after would part the two sides, which share a shuffle if they are one frame.
    near = written(pairs.filter((apart <= radius) & first).select(*bits, apart.cast("int").alias("distance")), "simhash-near")
    return near.select(
        _as_hex(*map(F.col, bits[:2])).alias("query"), _as_hex(*map(F.col, bits[2:])).alias("fingerprint"), "distance"
    )
