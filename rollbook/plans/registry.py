"""The tables of one registry and the flows that maintain them.

Each flow builds lazy plans and ends in versioned writes; what a later step reads is a written table,
so a lost executor costs the running stage only.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook import schemas
from rollbook.functions import fixed_values as fv
from rollbook.operators import columns, geocode, keyed, mining, reports, scan, tagging, verify
from rollbook.sources import landed, rules as rule_source
from rollbook.sources.paths import remove_folder
from rollbook.sources.tables import KeyedTable

# Left alone when rows come from the raw table, which does not hold them.
_FROM_SNAPSHOT_ONLY = schemas.EXTRA_COLUMNS


@dataclass
class Registry:
    """Keyed tables under one shared folder."""

    spark: SparkSession
    base: str
    raw: KeyedTable
    cache: KeyedTable
    master: KeyedTable
    queue: KeyedTable
    codes: KeyedTable
    folds: KeyedTable

    @classmethod
    def at(cls, spark: SparkSession, base: str) -> Registry:
        base = base.rstrip("/")
        return cls(
            spark,
            base,
            raw=KeyedTable(spark, f"{base}/companies_raw", schemas.COMPANIES_RAW),
            cache=KeyedTable(spark, f"{base}/address_cache", schemas.ADDRESS_CACHE),
            master=KeyedTable(spark, f"{base}/master", schemas.MASTER_TAGGED),
            queue=KeyedTable(spark, f"{base}/scan_queue", schemas.SCAN_QUEUE),
            codes=KeyedTable(spark, f"{base}/industry_codes", schemas.INDUSTRY_CODES),
            folds=KeyedTable(spark, f"{base}/folds", schemas.columns("log_base epoch:long"), keep_versions=2),
        )

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """The frame written beside the tables and read back: computed once, used many times."""
        path = f"{self.base}/staging/{name}-{uuid.uuid4().hex[:12]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def clear_staging(self) -> None:
        """Remove staged frames. For the end of a run: frames that flows returned may read them."""
        remove_folder(self.spark, f"{self.base}/staging")


def _geocode_into_master(
    registry: Registry,
    rows: DataFrame,
    responses: DataFrame,
    run_ts: dt.datetime,
    keep: tuple[str, ...] = (),
    **cleaning,
) -> DataFrame:
    """Clean, resolve the addresses the cache lacks, and write cache and master.

    ``responses`` are landed geocoder answers ``address_hash, als_json``; an address without an
    answer stays unresolved. Master columns named in ``keep`` are not overwritten.
    """
    # Cleaning is the costly step, and a snapshot may come as one file: its rows are dealt over the tasks first.
    dealt = rows.repartition("cr_no", "address_raw")
    cleaned = registry.stage(geocode.with_clean_address(dealt, **cleaning), "cleaned")
    addresses = registry.stage(geocode.distinct_addresses(cleaned), "addresses")
    missing = geocode.cache_misses(addresses, registry.cache.read())
    answered = missing.join(
        keyed.latest_per_key(responses.select("address_hash", "als_json"), "address_hash"), "address_hash"
    )
    # Only addresses the cache lacks get here, each once: the cache grows by a plain union.
    cache = registry.cache.write(
        registry.cache.read().unionByName(geocode.cache_rows(answered, run_ts))
    )
    attached = geocode.attach_geocode(cleaned, cache, addresses)
    built = registry.stage(geocode.build_master(attached, run_ts), "master")
    overwritten = [c for c in built.columns if c != "cr_no" and c not in keep]
    return registry.master.write(keyed.upsert(registry.master.read(), built, "cr_no", overwritten))


def _summary(registry: Registry) -> DataFrame:
    return reports.master_summary(registry.master.read(), registry.cache.read())


def full_refresh(
    registry: Registry, snapshot: DataFrame, responses: DataFrame, run_ts: dt.datetime, **cleaning
) -> DataFrame:
    """Take in a whole snapshot; companies the master has already are not geocoded again."""
    rows = columns.stamp(columns.normalise_columns(snapshot), run_ts)
    raw_rows = columns.conform(rows, schemas.COMPANIES_RAW)
    registry.raw.write(keyed.upsert(registry.raw.read(), raw_rows, "cr_no", form="outer"))
    todo = keyed.without_keys(rows, registry.master.read())
    _geocode_into_master(registry, todo, responses, run_ts, **cleaning)
    return _summary(registry)


def delta_refresh(
    registry: Registry,
    today: DataFrame,
    yesterday: DataFrame,
    responses: DataFrame,
    run_ts: dt.datetime,
    **cleaning,
) -> DataFrame:
    """Take in the rows that are new or changed since yesterday."""
    changed = keyed.snapshot_delta(
        columns.normalise_columns(today), columns.normalise_columns(yesterday), null_safe=True, carry=_FROM_SNAPSHOT_ONLY
    )
    rows = registry.stage(columns.stamp(columns.normalise_columns(changed), run_ts), "delta")
    raw_rows = columns.conform(rows, schemas.COMPANIES_RAW)
    registry.raw.write(keyed.upsert(registry.raw.read(), raw_rows, "cr_no", form="delta"))
    absent = tuple(c for c in _FROM_SNAPSHOT_ONLY if c not in today.columns)
    _geocode_into_master(registry, rows, responses, run_ts, keep=absent, **cleaning)
    return _summary(registry)


def geocode_pending(
    registry: Registry, responses: DataFrame, run_ts: dt.datetime, **cleaning
) -> DataFrame:
    """Geocode raw rows that have no master row with a geo address."""
    todo = keyed.pending_geocode(registry.raw.read(), registry.master.read())
    _geocode_into_master(registry, todo, responses, run_ts, keep=_FROM_SNAPSHOT_ONLY, **cleaning)
    return _summary(registry)


def record_scan(
    registry: Registry,
    candidates: DataFrame,
    log: DataFrame,
    miss_limit: int = fv.MISS_LIMIT,
) -> tuple[DataFrame, DataFrame]:
    """Queue the candidates, count an outcome log under the miss limit, write its outcomes.

    ``log`` has ``batch_id, seq, brn, status, queried_at``. Returns batch statistics and progress.
    """
    queue = scan.enqueue(registry.queue.read(), candidates)
    counted = registry.stage(scan.miss_runs(log, miss_limit), "outcomes")
    queue = registry.queue.write(scan.apply_outcomes(queue, counted))
    return scan.batch_stats(counted), scan.scan_progress(queue)


def verify_hits(registry: Registry, responses: DataFrame, now: dt.datetime) -> DataFrame:
    """Bring raw, master and queue in line with refreshed records; returns the outcome counts."""
    classified = registry.stage(verify.classify(responses, registry.raw.read()), "verified")
    changes = verify.raw_changes(classified, now)
    registry.raw.write(keyed.upsert(registry.raw.read(), changes, "cr_no"))
    registry.master.write(verify.cascade_reset(registry.master.read(), classified, now))
    registry.queue.write(verify.touch_queue(registry.queue.read(), classified, now))
    return verify.verify_stats(classified)


def tag_industries(
    registry: Registry,
    keyword_rules: DataFrame,
    labels: DataFrame | None = None,
    review_below: float = fv.TAG_REVIEW_BELOW,
    **options,
) -> DataFrame:
    """Tag the untagged companies in one pass; returns the tagging statistics."""
    sections = rule_source.section_table(registry.spark)
    master = registry.master.read()
    found = tagging.tags_for(
        tagging.untagged(master), keyword_rules, sections, labels, review_below, **options
    )
    tags = registry.stage(found, "tags")
    registry.master.write(tagging.with_section_names(tagging.write_tags(master, tags), sections))
    return tagging.tag_stats(tags)


def mine_terms(untagged: DataFrame, n: int = 200, max_rows: int | None = None) -> DataFrame:
    """The most frequent zh and en terms of untagged names: ``kind, term, n``."""
    names = mining.mining_sample(untagged, max_rows)
    zh = mining.top_terms(mining.bigram_counts(names), n).select(F.lit("zh").alias("kind"), "term", "n")
    en = mining.top_terms(mining.word_counts(names), n).select(F.lit("en").alias("kind"), "term", "n")
    return zh.unionByName(en)


def enrich_keywords(
    keyword_rules: DataFrame, terms: DataFrame, word_labels: DataFrame, path: str | None = None
) -> DataFrame:
    """Keyword rules extended by mined terms that a landed table ``word, code`` assigns a section.

    Terms come in order of kind (zh first) and frequency. With ``path`` the result is stored there.
    """
    ranked = terms.select(
        F.col("term").alias("word"),
        F.struct((F.col("kind") != "zh").alias("en"), (-F.col("n")).alias("n"), F.col("term").alias("t")).alias("ord"),
    )
    merged = tagging.merge_keywords(keyword_rules, ranked.join(word_labels, "word"))
    if path is not None:
        rule_source.save_keywords(merged, path)
        return rule_source.load_saved_keywords(keyword_rules.sparkSession, path)
    return merged


def load_codes(registry: Registry, bodies: DataFrame | None = None, builtin: bool = False) -> DataFrame:
    """Upsert a landed code table; without usable rows it fails. The built-in sections only on request."""
    if builtin:
        rows = rule_source.section_table(registry.spark)
    else:
        rows = landed.classification_codes(bodies)
        if rows.isEmpty():
            raise ValueError("no usable classification codes in the landed files")
    return registry.codes.write(keyed.upsert(registry.codes.read(), rows, "code"))
