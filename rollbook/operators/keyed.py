"""Operators on tables with a key: difference, insert, upsert, update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook import schemas


def latest_per_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by the whole row.

    An aggregate rather than a window, so that many copies of one key shrink before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    ranking = [*order_by, *[c for c in rest if c not in order_by]]
    best = df.groupBy(key).agg(F.max(F.struct(*ranking)).alias("_best"))
    return best.select(*[F.col(c) if c == key else F.col(f"_best.{c}") for c in df.columns])


def first_per_key(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key: the least by ``order_by``, then by the whole row. Rows whose key is null or
    empty are all kept; they are dealt out by the whole row. The input is evaluated once."""
    rest = [c for c in df.columns if c != key]
    ranking = [*order_by, *[c for c in rest if c not in order_by]]
    # Rows without a key get groups by their hash; each group counts its copies, so none is lost.
    has_key = F.coalesce(F.col(key), F.lit("")) != ""
    row = F.struct(*ranking)
    loose = F.when(~has_key, F.struct(F.col(key).alias("key"), row.alias("row")))
    best = df.groupBy(F.when(has_key, F.col(key)).alias("_key"), loose.alias("_loose")).agg(
        F.min(row).alias("_best"), F.count("*").alias("_n")
    )
    once = best.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_key").isNull(), F.col("_n")).otherwise(1).cast("int"))))
    return once.select(*[F.coalesce("_key", "_loose.key").alias(c) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns])


def without_keys(df: DataFrame, done: DataFrame, key: str = "cr_no") -> DataFrame:
    """Rows whose key is not in ``done``."""
    return df.join(done.select(key), key, "left_anti")


def pending_geocode(raw: DataFrame, master: DataFrame, key: str = "cr_no") -> DataFrame:
    """Raw rows that have no master row with a geo address yet."""
    return without_keys(raw, master.where(F.col("geo_address").isNotNull()), key)


def snapshot_delta(
    new: DataFrame,
    old: DataFrame,
    keep: Sequence[str] = schemas.REQUIRED_COLUMNS,
    null_safe: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``new`` without an identical row in ``old``, on the kept columns both have.

    By default null equals nothing, so rows holding a null are always in the delta. Columns named in
    ``carry`` come along without being compared.
    """
    left = new.select(*[c for c in (*keep, *carry) if c in new.columns])
    common = [c for c in keep if c in left.columns and c in old.columns]
    if not common:
        raise ValueError(f"no kept column ({', '.join(keep)}) is in both frames")
    right = old.select(*[F.col(c).alias(f"_old_{c}") for c in common])

    def same(column: str) -> Column:
        was = F.col(f"_old_{column}")
        return F.col(column).eqNullSafe(was) if null_safe else F.col(column) == was

    return left.join(right, reduce(Column.__and__, map(same, common)), "left_anti")


def keyed_delta(
    new: DataFrame, old: DataFrame, key: str = "cr_no", keep: Sequence[str] = schemas.REQUIRED_COLUMNS, null_safe: bool = False
) -> DataFrame:
    """``snapshot_delta`` joined on the key alone, so that two tables bucketed by it meet without a shuffle.

    The other kept columns are compared row by row inside the join. Rows without a key are compared with each
    other by ``snapshot_delta``, which spreads them by all their columns.
    """
    left = new.select(*[c for c in keep if c in new.columns])
    rest = [c for c in left.columns if c in old.columns and c != key]
    if key not in left.columns or key not in old.columns:
        raise ValueError(f"{key} is not in both frames")
    right = old.select(*[F.col(c).alias(f"_old_{c}") for c in (key, *rest)])

    def differs(column: str) -> Column:
        here, was = F.col(column), F.col(f"_old_{column}")
        return F.when(here.eqNullSafe(was) if null_safe else here == was, 0).otherwise(1)

    # A sum of both sides is no equality Spark could take for a join key, which bucketing by the key would not serve.
    matched = (F.col(key) == F.col(f"_old_{key}")) & (reduce(Column.__add__, map(differs, rest), F.lit(0)) == 0)
    if not null_safe:
        return left.join(right, matched, "left_anti")
    keyless = snapshot_delta(left.where(F.col(key).isNull()), old.where(F.col(key).isNull()), keep, null_safe=True)
    return left.where(F.col(key).isNotNull()).join(right, matched, "left_anti").unionByName(keyless)


def insert_ignore(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``base`` plus one row for each key it lacks. Doing it twice changes nothing."""
    fresh = without_keys(latest_per_key(new.where(F.col(key).isNotNull()), key), base, key)
    return base.unionByName(fresh, allowMissingColumns=True)


def _marked(updates: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One update per key, columns prefixed, with a flag telling that there is an update."""
    latest = latest_per_key(updates.where(F.col(key).isNotNull()), key, order_by)
    renamed = [F.col(c).alias(f"_new_{c}") for c in updates.columns if c != key]
    return latest.select(key, F.lit(True).alias("_given"), *renamed)


def _applies(newer_by: str | None) -> Column:
    """Whether a row has an update that is not older than itself."""
    if newer_by is None:
        return F.col("_given")
    return F.col("_given") & ~F.coalesce(F.col(newer_by) > F.col(f"_new_{newer_by}"), F.lit(False))


def upsert(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    form: str = "outer",
    newer_by: str | None = None,
) -> DataFrame:
    """Update known keys, insert unknown ones; the result has the columns of ``base``.

    ``update_cols`` (default: all that ``updates`` has) are overwritten for known keys, by nulls too.
    Of several updates of a key the latest by ``order_by`` counts. Rows without a key are left out. With
    ``newer_by``, a column of both, a known key whose row has a later value keeps its row.

    ``form='outer'`` is one full outer join, each side evaluated and shuffled once. ``form='delta'`` is
    for updates that are written already and much smaller than the base: they may be broadcast to both
    passes over the base, which then needs no shuffle, but base and updates are read more than once.
    """
    offered = [c for c in updates.columns if c != key and c in base.columns]
    updatable = set(offered if update_cols is None else update_cols) & set(offered)
    new = _marked(updates.select(key, *offered, *[c for c in order_by if c not in offered and c != key]),
                  key, order_by)

    def given(column: str) -> Column:
        if column in offered:
            return F.col(f"_new_{column}")
        return F.lit(None).cast(base.schema[column].dataType)

    def merged(column: str) -> Column:
        if column == key:
            return F.col(key)
        if column not in updatable:
            return F.col(column)
        return F.when(_applies(newer_by), given(column)).otherwise(F.col(column)).alias(column)

    if form == "outer":
        both = base.withColumn("_known", F.lit(True)).join(new, key, "full_outer")
        return both.select(
            *[
                F.col(c)
                if c == key
                else F.when(F.col("_known"), merged(c)).otherwise(given(c)).alias(c)
                for c in base.columns
            ]
        )
    if form != "delta":
        raise ValueError(f"form must be 'delta' or 'outer', not {form!r}")
    kept = base.join(new, key, "left").select(*[merged(c) for c in base.columns])
    known = base.select(key).join(new.select(key), key, "left_semi")
    added = new.join(known, key, "left_anti").select(
        *[F.col(c) if c == key else given(c).alias(c) for c in base.columns]
    )
    return kept.unionByName(added)


def update_by_key(
    base: DataFrame,
    updates: DataFrame,
    key: str,
    update_cols: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    newer_by: str | None = None,
) -> DataFrame:
    """Overwrite columns of known keys; unknown keys are ignored, and with ``newer_by`` updates older than the row."""
    offered = [c for c in updates.columns if c != key and c in base.columns]
    chosen = offered if update_cols is None else list(update_cols)
    new = _marked(updates, key, order_by)
    return base.join(new, key, "left").select(
        *[
            F.when(_applies(newer_by), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            if c in chosen
            else F.col(c)
            for c in base.columns
        ]
    )


def set_where_key(
    base: DataFrame, keys: DataFrame, key: str, values: Mapping[str, Column]
) -> DataFrame:
    """Set columns to the given values in the rows whose key is listed.

    Values may use columns of ``base`` and of ``keys`` (which must not share names besides the key).
    """
    marked = latest_per_key(keys, key).withColumn("_given", F.lit(True))
    return base.join(marked, key, "left").select(
        *[
            F.when(F.col("_given"), values[c]).otherwise(F.col(c)).alias(c)
            if c in values
            else F.col(c)
            for c in base.columns
        ]
    )
