"""Quality rules and robust multivariate outliers.

Each text gets base statistics and a base rule. Transformed statistics make a vector; of each language and
source the minimum-covariance-determinant estimate of place and scatter is found by concentration steps,
and vectors far from it by their Mahalanobis distance are rejected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import BLANKS, BLANK_CLASS, WORD_CLASS, free_name, let, text_or_empty, written

#: Base rule: fewer words than these, or more than this percentage of them in repeated windows, fail.
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
WINDOW = 3
#: Part of a group that the estimate must fit; concentration steps; least rows of a group of its own.
SUPPORT = 0.75
STEPS = 4
LEAST_GROUP = 200
#: Squared distances above this are rejected: twice the 0.99999 point of chi-square with 5 degrees of
#: freedom (30.9), since clean text has longer tails than a normal law. Distances are scaled down only, so
#: in groups more even than FLOOR the same cutoff lets more pass.
CUTOFF = 60.0
#: Least standard deviation of a transformed statistic: differences below it say nothing.
FLOOR = 0.3
#: Statistics are rounded to this grid, so that sums don't depend on the order of rows.
GRID = 1024.0
#: Models of up to so many groups are broadcast (a few hundred bytes each); more are joined by shuffle.
BROADCAST_GROUPS = 10_000
#: Bins of a doubling of the distance, in which distances are counted for the quantile.
BINS = 8
VECTOR = ("q_length", "q_word", "q_symbols", "q_lines", "q_repeat")


def _word_list(text: Column) -> Column:
    return F.filter(F.split(F.btrim(text, F.lit(BLANKS)), BLANK_CLASS + "+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in windows of three words that the text has twice or more."""

    def covered(places: Column) -> Column:
        # Each repeated window adds its words up to where the next one starts.
        steps = F.zip_with(places, F.slice(places, F.lit(2), F.size(places)), lambda a, b: F.least(b - a, F.lit(WINDOW)))
        return F.aggregate(steps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(WINDOW)))

    def repeated(sorted_windows: Column) -> Column:
        # Sorted by hash, equal windows stand side by side.
        shifted = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), sorted_windows)
        linked = F.zip_with(shifted, sorted_windows, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
        return F.sort_array(F.array_distinct(F.flatten(F.filter(linked, lambda x: x.isNotNull()))))

    def with_hashes(hashes: Column) -> Column:
        numbered = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            let(repeated(F.sort_array(numbered)), covered)
        )

    def windows(w: Column) -> Column:
        n = F.size(w) - (WINDOW - 1)
        triples = F.arrays_zip(
            F.slice(w, F.lit(1), n).alias("a"), F.slice(w, F.lit(2), n).alias("b"), F.slice(w, F.lit(3), n).alias("c")
        )
        return F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))

    return F.when(F.size(words) < WINDOW + 1, F.lit(0)).otherwise(let(windows(words), with_hashes))


def text_statistics(text: Column) -> Column:
    """Struct of ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long) of a text."""

    def of(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_CLASS))
        dup = let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        symbols = F.char_length(t) - F.char_length(F.regexp_replace(t, r"[#*$%&|<>]", ""))
        return let(
            _word_list(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                symbols.cast("long").alias("n_symbols"),
                dup.cast("long").alias("n_dup_lines"),
                _repeat_words(w).cast("long").alias("n_repeat_words"),
            ),
        )

    return let(text_or_empty(text), of)


def _vector() -> dict[str, Column]:
    """Statistics made comparable for texts of all lengths; on a grid."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    shrunk = lambda part, prior: F.col(part) / (n + prior)  # noqa: E731  rates of short texts lean to 0
    raw = {
        "q_length": F.log2(n) / 4,
        "q_word": F.log2(F.greatest(F.col("word_chars") / n, F.lit(0.5))) * 4,
        "q_symbols": F.log2(1 + 32 * shrunk("n_symbols", 20)),
        "q_lines": F.log2(1 + 32 * shrunk("n_dup_lines", 20)),
        "q_repeat": F.log2(1 + 8 * shrunk("n_repeat_words", 20)),
    }
    return {k: F.round(v * GRID) / GRID for k, v in raw.items()}


def _estimate(rows: DataFrame, keys: list[str], vector: tuple, floor: float) -> DataFrame:
    """Means and the lower triangle L of the Cholesky factor of the covariance, a row per group."""
    p = range(len(vector))
    sums = [F.avg(vector[i]).alias(f"m{i}") for i in p]
    sums += [F.avg(F.col(vector[i]) * F.col(vector[j])).alias(f"s{i}{j}") for i in p for j in p if j <= i]
    out = rows.groupBy(*keys).agg(*sums)
    for i in p:
        for j in p:
            if j > i:
                continue
            c = F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}") + (floor * floor if i == j else 0.0)
            c = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), c)
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(c, F.lit(1e-9))) if i == j else c / F.col(f"l{j}{j}"))
    return out.select(*keys, *[f"m{i}" for i in p], *[f"l{i}{j}" for i in p for j in p if j <= i])


def _distance(rows: DataFrame, model: DataFrame, keys: list[str], vector: tuple, name: str, few: bool) -> DataFrame:
    """Squared Mahalanobis distance by forward substitution; null where a group has no model."""
    given = rows.columns
    renamed = model.select(*[F.col(k).alias(f"model_{k}") for k in keys], *[c for c in model.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"model_{k}")) for k in keys])
    out = rows.join(F.broadcast(renamed) if few else renamed, on, "left")
    for i in range(len(vector)):
        y = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"y{k}"), range(i), F.col(vector[i]) - F.col(f"m{i}"))
        out = out.withColumn(f"y{i}", y / F.col(f"l{i}{i}"))
    total = reduce(lambda a, i: a + F.col(f"y{i}") * F.col(f"y{i}"), range(len(vector)), F.lit(0.0))
    return out.select(*given, total.alias(name))


def robust_distances(
    rows: DataFrame,
    keys: list[str],
    vector: tuple,
    support: float = SUPPORT,
    steps: int = STEPS,
    least_group: int = LEAST_GROUP,
    floor: float = FLOOR,
    fall_back: bool = False,
) -> DataFrame:
    """``rows`` (a written table) with ``distance``: squared robust Mahalanobis distance in its group.

    Groups are the distinct ``keys`` (null is a value). With ``fall_back`` every row has a model: a group with
    fewer than ``least_group`` rows takes that of all rows that agree on its keys without the last one, and
    so on to the model of all rows, however few. Without it, small groups of equal keys but for the last are
    pooled with each other only, and where the pool is still small the distance is null. The first
    estimate is of ranks about the coordinate medians; each concentration step fits the ``support`` part
    of the group that lies nearest. Where ties stand at the border all of their bin go in. The covariance
    gets ``floor`` squared added on its diagonal, so constant statistics give no division by zero. Distances
    of a group whose median is above that of chi-square are scaled down to it; they are never scaled up,
    since the floor makes those of even texts small for no fault of the texts.
    """
    given = rows.columns
    if fall_back:
        group = free_name("model_group", given)
        pooled, train = _with_fallback(rows, keys, group, vector, least_group)
    else:
        group = free_name(f"pool_{keys[0]}", given)
        pooled = train = _pooled(rows, keys, group, least_group)
    wide = train.groupBy(group).agg(F.count(F.lit(1)).alias("n"), *[F.percentile_approx(v, 0.5, 1000).alias(f"med_{v}") for v in vector])
    wide = written(wide if fall_back else wide.filter(F.col("n") >= least_group), "quality-groups")
    few = wide.count() <= BROADCAST_GROUPS
    model_start = _start(train, wide, group, vector, floor, few)
    model = written(model_start, "quality-step")
    for _ in range(steps):
        near = _nearest(_distance(train, model, [group], vector, "distance", few), group, support, few)
        model = written(_estimate(near, [group], vector, floor), "quality-step")
    fitted = _distance(train, model, [group], vector, "distance", few)
    scale = _quantile(fitted, group, 0.5).select(F.col(group).alias("scale_group"), F.col("bin_top").alias("median"))
    measured = _distance(pooled, model, [group], vector, "distance", few)
    # 4.351: median of chi-square with 5 degrees of freedom; in general p * (1 - 2 / (9 p)) ** 3.
    p = len(vector)
    normal = p * (1 - 2 / (9 * p)) ** 3
    return (
        measured.join(F.broadcast(scale) if few else scale, F.col(group) == F.col("scale_group"), "left")
        .withColumn("distance", F.col("distance") / F.greatest(F.col("median") / normal, F.lit(1.0)))
        .select(*given, "distance")
    )


def _with_fallback(rows: DataFrame, keys: list[str], group: str, vector: tuple, least_group: int) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``group``, the name of the model each takes; and ``group`` and vector of the rows each
    model is made of: all rows of its keys, also those that have a narrower model of their own."""
    # Level k leaves the last k keys out; as JSON, null is no name and lists of other lengths never clash.
    levels = [F.to_json(F.array(*[F.col(k).cast("string") for k in keys[: len(keys) - i]])) if i < len(keys) else F.lit("[]") for i in range(len(keys) + 1)]
    named = [f"level_{i}" for i in range(len(levels))]
    counts = rows.groupBy(*[v.alias(n) for v, n in zip(levels, named, strict=True)]).agg(F.count(F.lit(1)).alias("rows_0"))
    counts = written(counts, "quality-counts")
    marks = counts
    for i in range(1, len(keys)):
        wider = counts.groupBy(F.col(named[i]).alias("of")).agg(F.sum("rows_0").alias(f"rows_{i}"))
        marks = marks.join(wider, F.col(named[i]) == F.col("of")).drop("of")
    enough = [F.when(F.col(f"rows_{i}") >= least_group, F.col(named[i])) for i in range(len(keys))]
    marks = written(marks.select(F.col(named[0]).alias("of"), F.coalesce(*enough, F.col(named[-1])).alias(group)), "quality-marks")
    few = marks.count() <= BROADCAST_GROUPS
    pooled = written(rows.join(F.broadcast(marks) if few else marks, levels[0] == F.col("of")).drop("of"), "quality-pooled")
    needed = marks.select(group).distinct()
    train = rows.select(F.explode(F.array(*levels)).alias(group), *vector)
    return pooled, written(train.join(F.broadcast(needed) if few else needed, group, "left_semi"), "quality-train")


def _pooled(rows: DataFrame, keys: list[str], group: str, least_group: int) -> DataFrame:
    """``rows`` with ``group``: their keys, or for small groups a name shared by those of equal keys but the last."""
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("pool_n"))
    # Small groups: the last key becomes a mark shared by all small groups of the keys before it.
    marks = counts.select(
        *[F.col(k).alias(f"count_{k}") for k in keys], (F.col("pool_n") < least_group).alias("pool_small")
    )
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"count_{k}")) for k in keys])
    marks = written(marks, "quality-counts")
    pooled = rows.join(F.broadcast(marks) if marks.count() <= BROADCAST_GROUPS else marks, on).drop(*[f"count_{k}" for k in keys])
    name = F.concat_ws("\x1f", *[F.when(F.col(k).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(k).cast("string"))) for k in keys[:-1]])
    last = F.when(F.col(keys[-1]).isNull(), "n").otherwise(F.concat(F.lit("v"), F.col(keys[-1]).cast("string")))
    pooled = pooled.withColumn(group, F.concat_ws("\x1e", name, F.when(F.col("pool_small"), F.lit("")).otherwise(last)))
    return written(pooled.drop("pool_small"), "quality-pooled")


def _start(rows: DataFrame, wide: DataFrame, group: str, vector: tuple, floor: float, few: bool) -> DataFrame:
    """Diagonal first estimate: medians, and mean absolute differences to them as scales."""
    med = wide.select(F.col(group).alias("g"), *[f"med_{v}" for v in vector])
    spread = rows.join(F.broadcast(med) if few else med, F.col(group) == F.col("g")).groupBy(group).agg(
        *[F.first(f"med_{v}").alias(f"m{i}") for i, v in enumerate(vector)],
        *[(F.avg(F.abs(F.col(v) - F.col(f"med_{v}"))) * 1.2533 + floor).alias(f"l{i}{i}") for i, v in enumerate(vector)],
    )
    n = range(len(vector))
    return spread.select(
        group, *[f"m{i}" for i in n], *[F.col(f"l{i}{j}") if i == j else F.lit(0.0).alias(f"l{i}{j}") for i in n for j in n if j <= i]
    )


def _bin(distance: Column) -> Column:
    return F.floor(F.log2(distance + 1e-3) * BINS).cast("int")


def _quantile(measured: DataFrame, group: str, part: float) -> DataFrame:
    """Per group the smallest bin at which ``part`` of its rows is reached, and the bin's upper end.

    Distances are counted in bins, so the hottest group brings a few hundred rows together."""
    bins = measured.filter("distance IS NOT NULL").groupBy(group, _bin(F.col("distance")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(group)
    return (
        bins.withColumn("upto", F.sum("n").over(w.orderBy("bin")))
        .withColumn("all_n", F.sum("n").over(w))
        .filter(F.col("upto") >= F.col("all_n") * part)
        .groupBy(group)
        .agg(F.min("bin").alias("bin"))
        .withColumn("bin_top", F.pow(F.lit(2.0), (F.col("bin") + 1) / BINS) - 1e-3)
    )


def _nearest(measured: DataFrame, group: str, part: float, few: bool) -> DataFrame:
    border = _quantile(measured, group, part).select(F.col(group).alias("border_group"), F.col("bin").alias("border"))
    return measured.join(F.broadcast(border) if few else border, F.col(group) == F.col("border_group")).filter(_bin(F.col("distance")) <= F.col("border"))


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    keys: tuple[str, ...] = ("lang", "source"),
    cutoff: float = CUTOFF,
    least_group: int = LEAST_GROUP,
    fall_back: bool = False,
) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance`` and ``kept`` of every row.

    Null and empty texts have statistics 0 and fail the base rule. Estimates are made of the rows that
    pass it. With ``fall_back`` rows of groups too small for an estimate are judged by that of their first keys,
    or of all rows; without it they are kept unless the base rule fails, pooled ones included, and their
    distance is null. Repeated rows are rows of their own. Null keys are a group.
    """
    stats = docs.select(
        F.col(id_column).alias("doc_id"),
        *[F.col(k).cast("string").alias(f"key_{i}") for i, k in enumerate(keys)],
        text_statistics(F.col(text_column)).alias("s"),
    ).select("doc_id", *[f"key_{i}" for i in range(len(keys))], "s.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEAT_PERCENT * F.col("n_words"))
    stats = written(stats.withColumn("base_failed", failed).withColumns(_vector()), "quality")
    names = [f"key_{i}" for i in range(len(keys))]
    passed = robust_distances(stats.filter("NOT base_failed"), names, VECTOR, least_group=least_group, fall_back=fall_back)
    verdict = F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    both = passed.withColumn("kept", verdict).unionByName(
        stats.filter("base_failed").withColumns({"distance": F.lit(None).cast("double"), "kept": F.lit(False)})
    )
    return both.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance", *VECTOR, *names
    )
