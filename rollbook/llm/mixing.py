"""Mixing sources to target weights.

Documents get hash-random keys; within each source they are ordered by key over many ranges; prefix
sums of their sizes are formed inside the ranges and over the ranges; the order is cut where the
source's budget is reached, after as many whole epochs as fit into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import BLANK_CLASS, free_name, n_words, written

#: Sources take these weights in turn.
WEIGHTS = (3, 1, 2)
#: The mix has so many hundredths of all words; no source is taken more often than this.
SHARE_PERCENT = 150
MOST_EPOCHS = 2
#: Keys of a range, on average, and summaries of ranges in a block of them.
RANGE_ROWS = 4096
#: More sources than these are joined by shuffle instead of broadcast.
BROADCAST_SOURCES = 4096
SALTS = 64


def source_targets(
    sources: DataFrame, weights: tuple = WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_EPOCHS
) -> DataFrame:
    """``source, source_size`` (a row a source) with ``target`` (double) and ``weight``.

    Sources by code point, null last, get the weights in turn and share ``share_percent`` of all words.
    A target stops at ``most`` times its source's size; what is over goes to the others by weight, until
    none is above. Solved at one stroke: in the order of ``most * size / weight`` the stopped sources
    come first, so the level is that of the first prefix after which the next source is not stopped.
    """
    every = Window.partitionBy()
    order = F.col("source").isNull(), F.col("source")
    cases = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int"))
    by_ratio = every.orderBy(F.expr(f"source_size * {most} / double(weight)"), *order)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sources.withColumn("turn", F.row_number().over(every.orderBy(*order)) - 1)
        .withColumn("weight", cases.cast("long"))
        .withColumn("all_size", F.sum("source_size").over(every))
        .withColumn("all_weight", F.sum("weight").over(every))
        .withColumn("capped", F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)))
        .withColumn("open_weight", F.col("all_weight") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        # Level if this source and all after it stay below their stop: (share - capped) / open_weight.
        .withColumn("rest", F.col("all_size") * share_percent - F.col("capped") * 100)
        .withColumn("fits", F.col("rest").cast("double") * F.col("weight") <= F.col("source_size").cast("double") * (100 * most) * F.col("open_weight"))
    )
    level = ranked.withColumn(
        "at", F.min(F.when(F.col("fits"), F.struct("capped", F.col("open_weight").alias("w"), "rest"))).over(every)
    )
    share = F.col("at.rest") * F.col("weight") / (F.col("at.w") * F.lit(100.0))
    stop = (F.col("source_size") * most).cast("double")
    return level.select("source", "source_size", "weight", F.least(stop, F.coalesce(share, stop)).alias("target"))


def _key(seed: str, id_column: Column, text_hash: Column) -> Column:
    return F.md5(F.concat(F.lit(seed), F.coalesce(id_column.cast("string"), text_hash)))


def mix(
    docs: DataFrame,
    size: str | None = None,
    seed: str = "mix:",
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    weights: tuple = WEIGHTS,
    share_percent: int = SHARE_PERCENT,
    most: int = MOST_EPOCHS,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``size, source_size, target, taken``.

    ``size`` names a column of sizes; without it the words of the text are counted (null text: 0).
    ``taken`` is how many words the mix takes of the row: whole epochs of the source, and in the last
    one rows in the order of their keys up to the budget, which the row at the cut meets with its first
    words only. So the words taken of a source are its target, rounded down.

    Null source: a source of its own, last in order. Null id: the key comes from the text. Rows with one
    key (repeated rows) stand or fall together; at the cut each takes its share of what is left, rounded
    down. Empty table: no rows. Result columns that ``docs`` has already are replaced.
    """
    made = ("size", "source_size", "target", "taken")
    names = docs.columns
    kept = [c for c in names if c.lower() not in made]
    key, src, words_of = (free_name(n, names) for n in ("mix_key", "mix_source", "mix_size"))
    text_hash = F.md5(F.coalesce(F.col(text_column), F.lit(""))) if text_column in names else F.lit("")
    sized = docs.withColumns(
        {
            words_of: (n_words(F.col(text_column)) if size is None else F.col(size).cast("long")),
            key: _key(seed, F.col(id_column), text_hash),
            src: F.col(source_column),
        }
    )
    slim = written(
        sized.groupBy(F.col(src).alias("source"), F.col(key).alias("key")).agg(
            F.sum(words_of).alias("size"), F.count(F.lit(1)).alias("n")
        ),
        "mixing",
    )
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_keys"))
    sources = written(
        source_targets(sources, weights, share_percent, most)
        .join(sources.select(F.col("source").alias("s"), "n_keys"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s", "weight"),
        "mixing-sources",
    )
    few = sources.count() <= BROADCAST_SOURCES
    cuts = _cuts(slim, sources, few)

    budget = F.floor("cut.target").cast("long")
    whole = F.floor(budget / F.greatest(F.col("cut.source_size"), F.lit(1)))
    rest = budget - whole * F.col("cut.source_size")
    part = (
        F.when(F.col(key) < F.col("cut.key"), F.col(words_of))
        .when(F.col(key) == F.col("cut.key"), F.floor(F.col(words_of) * (rest - F.col("cut.before")) / F.col("cut.key_size")))
        .otherwise(F.lit(0))
    )
    cuts = cuts.select(F.struct(*cuts.columns).alias("cut"))
    same = F.col(src).eqNullSafe(F.col("cut.source"))
    if few:
        joined = sized.join(F.broadcast(cuts), same)
    else:
        salt = free_name("mix_salt", names)
        joined = sized.withColumn(salt, F.pmod(F.hash(key), F.lit(SALTS))).join(
            cuts.withColumn("cut_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))),
            same & (F.col(salt) == F.col("cut_salt")),
        )
    return joined.select(
        *kept,
        F.col(words_of).alias("size"),
        F.col("cut.source_size").alias("source_size"),
        F.col("cut.target").alias("target"),
        (whole * F.col(words_of) + part).cast("long").alias("taken"),
    )


def _cuts(slim: DataFrame, sources: DataFrame, few: bool) -> DataFrame:
    """Of each source: the key at which the budget of its last epoch ends, its size, the sum before it.

    Keys are uniform, so equal ranges of them hold like numbers of rows. Sums of ranges are added up over
    blocks of ranges first, so no window sees more than a block's ranges or a source's blocks.
    """
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")  # 0 .. 2^32 - 1
    ranges = F.greatest(F.lit(1), F.ceil(F.col("n_keys") / RANGE_ROWS)).cast("long")
    info = sources.select(F.col("source").alias("s"), "n_keys")
    info = F.broadcast(info) if few else info
    ranged = (
        slim.join(info, F.col("source").eqNullSafe(F.col("s")))
        .withColumn("range", F.shiftright(place * ranges, 32))
        .withColumn("block", F.floor(F.col("range") / RANGE_ROWS))
        .drop("s", "n_keys")
    )
    prior = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    sums = ranged.groupBy("source", "block", "range").agg(F.sum("size").alias("range_size"))
    blocks = sums.groupBy("source", "block").agg(F.sum("range_size").alias("block_size"))
    blocks = blocks.withColumn(
        "block_before", zero(F.sum("block_size").over(prior(Window.partitionBy("source").orderBy("block"))))
    ).select(F.col("source").alias("bs"), F.col("block").alias("bb"), "block_before")
    sums = (
        sums.withColumn(
            "in_block", zero(F.sum("range_size").over(prior(Window.partitionBy("source", "block").orderBy("range"))))
        )
        .join(blocks, F.col("source").eqNullSafe(F.col("bs")) & (F.col("block") == F.col("bb")))
        .select(
            F.col("source").alias("rs"), F.col("range").alias("rr"), (F.col("in_block") + F.col("block_before")).alias("start")
        )
    )
    summed = ranged.withColumn(
        "in_range", zero(F.sum("size").over(prior(Window.partitionBy("source", "range").orderBy("key"))))
    ).join(sums, F.col("source").eqNullSafe(F.col("rs")) & (F.col("range") == F.col("rr")))
    target = sources.select(F.col("source").alias("ts"), "source_size", "target")
    target = F.broadcast(target) if few else target
    budget = F.floor("target").cast("long")
    rest = budget - F.floor(budget / F.greatest(F.col("source_size"), F.lit(1))) * F.col("source_size")
    return (
        summed.join(target, F.col("source").eqNullSafe(F.col("ts")))
        .withColumn("before", F.col("start") + F.col("in_range"))
        .groupBy("ts", "source_size", "target")
        # The key in which the rest of the budget ends; without a rest none: before the first key.
        .agg(
            F.max(
                F.when(
                    (F.col("before") < rest) & (F.col("before") + F.col("size") >= rest),
                    F.struct("key", "before", "size"),
                )
            ).alias("at")
        )
        .select(
            F.col("ts").alias("source"),
            "source_size",
            "target",
            F.coalesce("at.key", F.lit("")).alias("key"),
            F.coalesce("at.before", F.lit(0)).alias("before"),
            F.greatest(F.coalesce("at.size", F.lit(1)), F.lit(1)).alias("key_size"),
        )
    )


def repeat_documents(mixed: DataFrame, columns: list[str], text_column: str = "text") -> DataFrame:
    """The mix itself: each row as often as whole epochs take it, and the row at a cut with the first
    words it gives, blanks before and between them as they were. Rows of which nothing is taken go."""
    size = F.greatest(F.col("size"), F.lit(1))
    whole = F.floor(F.col("taken") / size).cast("int")
    rest = (F.col("taken") - whole * F.col("size")).cast("int")
    copy = free_name("mix_copy", mixed.columns)
    left = free_name("mix_left", mixed.columns)
    parts = F.concat(
        F.array_repeat(F.lit(-1), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>"))
    )
    pieces = F.regexp_extract_all(F.col(text_column), F.lit(f"{BLANK_CLASS}*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    text = F.when(F.col(copy) == -1, F.col(text_column)).otherwise(F.array_join(F.slice(pieces, F.lit(1), F.col(copy)), ""))
    out = mixed.filter(F.col("taken") > 0).withColumn(left, parts).withColumn(copy, F.explode(left))
    return out.select(*[text.alias(c) if c == text_column else F.col(c) for c in columns])
