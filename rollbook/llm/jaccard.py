"""N-gram Jaccard self-join by rare-first prefix filtering.

Each text is the set of its word n-grams. N-grams are ordered rare first: those that one text alone has,
then the others by how often their bucket is hit. Two sets that are alike enough share one of their first
few n-grams, so only these are joined. Length and positional filters drop pairs at the join, a suffix
filter over parts of the sets drops more, and each pair left is verified once on its texts.

Frequencies come from tables of bounded size; any order gives the same links, only the work differs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import free_name, give_back_memory, text_or_empty, written
from rollbook.llm.components import components
from rollbook.llm.hashing import blocks, column_bytes, mixed, runs, sliced, word_hashes
from rollbook.llm.sketch import is_shared, shared_bits, table_bits, text_bytes

GRAM = 4
#: Least similarity in hundredths: 100 * common >= THRESHOLD * united.
THRESHOLD = 85
#: Buckets for frequencies, and parts of a set that the suffix filter compares.
COUNT_BITS = 18
PARTS = 16
#: Sets of a block when all pairs of a component are counted, and n-grams of a block compared at once.
BLOCK = 256
COLUMNS = 4096
_U = np.uint64


def gram_sets(column: pa.Array, gram: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the word n-grams of each row; fewer words than ``gram``: one, of all."""
    data, offsets = column_bytes(column)
    for lo, hi in blocks(offsets):
        part = offsets[lo : hi + 1]
        h, _, _, at = word_hashes(data[part[0] : part[-1]], part - part[0], lower)
        grams = runs(h, gram)
        for i in range(hi - lo):
            n = at[i + 1] - at[i]
            if n >= gram:
                yield np.unique(grams[at[i] : at[i] + n - gram + 1])
            elif n:
                yield mixed(np.array([np.bitwise_xor.reduce(runs(h[at[i] : at[i + 1]], int(n))) + _U(n)], _U))
            else:
                yield np.zeros(0, _U)


def prefix_length(n: int, threshold: int) -> int:
    """So many n-grams of a set of ``n`` that a set alike enough holds one of them."""
    return n - -(-threshold * n // 100) + 1


def least_common(n: Column, m: Column, threshold: int) -> Column:
    """Least size of the intersection of sets of these sizes that are alike enough."""
    return F.ceil((n + m) * threshold / F.lit(100.0 + threshold) - 1e-9)


def _keys(s: np.ndarray) -> tuple[int, int]:
    """Two order-free hashes of a set, as longs."""
    return int(s.sum(dtype=_U).view(np.int64)), int(mixed(s ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U).view(np.int64))


def _signatures(docs: DataFrame, gram: int) -> DataFrame:
    """``doc_id, n, k1, k2, parts``: set size, two order-free hashes of the set, sizes of its parts."""

    def sign(batches):
        for batch in sliced(batches, 1):
            n, k1, k2, parts = [], [], [], []
            for s in gram_sets(batch.column(1), gram):
                n.append(len(s))
                one, two = _keys(s)
                k1.append(one)
                k2.append(two)
                parts.append(np.bincount((s >> _U(60)).astype(np.int64), minlength=PARTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array([p.tolist() for p in parts], pa.list_(pa.int32()))],
                ["doc_id", "n", "k1", "k2", "parts"],
            )
        give_back_memory()

    return docs.mapInArrow(sign, "doc_id long, n long, k1 long, k2 long, parts array<int>")


def _counts(docs: DataFrame, gram: int) -> np.ndarray:
    """How often each of 2 ** COUNT_BITS buckets of n-grams is hit."""

    def count(batches):
        total = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for s in gram_sets(batch.column(1), gram):
                total += np.bincount((s & _U((1 << COUNT_BITS) - 1)).astype(np.int64), minlength=1 << COUNT_BITS) if len(s) > 5000 else 0
                if len(s) <= 5000:
                    np.add.at(total, (s & _U((1 << COUNT_BITS) - 1)).astype(np.int64), 1)
        places = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(total[places], pa.int64())], ["bucket", "n"])
        give_back_memory()

    summed = docs.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << COUNT_BITS, np.int64)
    for batch in summed.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return out


def _tables(docs: DataFrame, gram: int, bits: int) -> Broadcast:
    """The bit table of n-grams that two texts have, and the counts: of bounded size."""
    (shared,) = shared_bits(docs, lambda batch: gram_sets(batch.column(1), gram), bits)
    return docs.sparkSession.sparkContext.broadcast((shared, _counts(docs, gram)))


def _prefixes(docs: DataFrame, gram: int, threshold: int, tables: Broadcast, bits: int) -> DataFrame:
    """``token, doc_id, n, k1, k2, place``: the n-grams of a prefix that other texts may have, by the broadcast
    bit table and counts."""

    def rows(batches):
        table, often = tables.value
        for batch in sliced(batches, 1):
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            out: list[list[np.ndarray]] = []
            for doc, s in zip(ids, gram_sets(batch.column(1), gram), strict=True):
                if not len(s):
                    continue
                known = is_shared(table, s, bits)
                p, alone = prefix_length(len(s), threshold), int((~known).sum())
                if alone >= p:
                    continue
                rest = s[known]
                order = np.lexsort((rest, often[(rest & _U((1 << COUNT_BITS) - 1)).astype(np.int64)]))[: p - alone]
                k1, k2 = _keys(s)
                t = rest[order].view(np.int64)
                full = lambda v, m=len(t): np.full(m, v, np.int64)
                out.append([t, full(doc), full(len(s)), full(k1), full(k2), alone + np.arange(len(t))])
            if out:
                columns = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["token", "doc_id", "n", "k1", "k2", "place"])
        give_back_memory()

    return docs.mapInArrow(rows, "token long, doc_id long, n long, k1 long, k2 long, place long")


def _alike(batches, gram: int, threshold: int):
    """Pairs whose texts' sets are alike enough. Consecutive pairs often share a text: its set is kept. Rows of
    one id may have several texts, so the texts are compared and not the ids."""
    for batch in batches:
        a, b, left, right = (batch.column(i) for i in range(4))
        keep, left_set = [], None
        right_sets = gram_sets(right, gram)
        again = [False, *pc.equal(left.slice(1), left.slice(0, max(0, len(left) - 1))).to_pylist()]
        for i, other in enumerate(right_sets):
            if not again[i]:
                left_set = next(gram_sets(left.slice(i, 1), gram))
            common = len(np.intersect1d(left_set, other, assume_unique=True))
            keep.append(100 * common >= threshold * (len(left_set) + len(other) - common))
        yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], ["a", "b"])
    give_back_memory()


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame, gram: int, threshold: int, name: str) -> DataFrame:
    """Suffix filter, then each distinct pair (``a, b``) once on its texts; the links are written."""
    node = lambda x: sets.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("parts").alias(f"parts_{x}"))
    sized = pairs.join(node("a"), "a").join(node("b"), "b")
    apart = F.aggregate(F.zip_with("parts_a", "parts_b", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    close = sized.filter((F.col("n_a") + F.col("n_b") - apart) / 2 >= least_common(F.col("n_a"), F.col("n_b"), threshold))
    close = written(close.select("a", "b"), f"{name}-pairs")
    ends = close.select(F.col("a").alias("doc_id")).union(close.select(F.col("b").alias("doc_id"))).distinct()
    texts = written(docs.join(ends, "doc_id", "left_semi"), f"{name}-texts")
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    both = close.join(text("b"), "b").join(text("a"), "a").select("a", "b", "text_a", "text_b")
    return written(both.mapInArrow(lambda it: _alike(it, gram, threshold), "a long, b long"), f"{name}-links")


def _sets_of(docs: DataFrame, gram: int) -> DataFrame:
    """``doc_id, n, k1, k2, grams``: the whole set of each text with words, as bytes."""

    def rows(batches):
        for batch in sliced(batches, 1):
            of = [(i, *_keys(s), s) for i, s in enumerate(gram_sets(batch.column(1), gram)) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in of], pa.int64())), pa.array([len(r[3]) for r in of], pa.int64()),
                 *[pa.array([r[k] for r in of], pa.int64()) for k in (1, 2)], pa.array([r[3].tobytes() for r in of], pa.binary())],
                ["doc_id", "n", "k1", "k2", "grams"],
            )
        give_back_memory()

    return docs.mapInArrow(rows, "doc_id long, n long, k1 long, k2 long, grams binary")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every two sets of two lists, by products of incidence tables."""
    out = np.zeros((len(left), len(right)), np.float32)
    every = [np.concatenate(side) for side in (left, right)]
    rows = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    both = np.intersect1d(np.unique(every[0]), np.unique(every[1]), assume_unique=True)
    for lo in range(0, len(both), COLUMNS):
        part = both[lo : lo + COLUMNS]
        tables = []
        for values, row, side in zip(every, rows, (left, right), strict=True):
            place = np.minimum(np.searchsorted(part, values), len(part) - 1)
            held = part[place] == values
            table = np.zeros((len(side), len(part)), np.float32)
            table[row[held], place[held]] = 1
            tables.append(table)
        out += tables[0] @ tables[1].T
    return out


def _count_links(nodes: DataFrame, docs: DataFrame, links: DataFrame, gram: int, threshold: int) -> DataFrame:
    """``rep, n, k1, k2, others``: how many rows beside those of its own set link with a set.

    ``nodes`` has ``rep, n, k1, k2, c, copies``; links lie within a component ``c``. In one of two nodes the link
    that proves it is the only one. Of a larger one all pairs are compared, a block of sets with another at a
    time: a task holds two blocks, and a set is sent to as many pairs of blocks as there are blocks."""
    per = nodes.groupBy("c").agg(F.count(F.lit(1)).alias("m"), F.countDistinct("rep").alias("reps")).filter("m > 1")
    sized = written(nodes.join(per, "c"), "jaccard-components-of-nodes")
    pairs = sized.filter("m = 2 AND reps = 2")
    ends = links.select("a", "b").union(links.select("b", "a")).toDF("rep", "other").distinct()
    other = pairs.select(F.col("rep").alias("other"), F.col("copies").alias("others"))
    of_two = pairs.join(ends, "rep").join(other, "other").select("rep", "n", "k1", "k2", "others")

    large = sized.filter("NOT (m = 2 AND reps = 2)").withColumnRenamed("rep", "doc_id")
    found = _sets_of(docs.join(large.select("doc_id").distinct(), "doc_id", "left_semi"), gram).dropDuplicates(["doc_id", "n", "k1", "k2"])
    held = written(found.join(large, ["doc_id", "n", "k1", "k2"]), "jaccard-sets-of-nodes")
    n_blocks = F.ceil(F.col("m") / F.lit(BLOCK))
    block = F.pmod(F.xxhash64("doc_id", "k1"), n_blocks)
    dealt = held.withColumn("own", block).select(
        "c", "own", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1)).alias("with"), "doc_id", "n", "k1", "k2", "copies", "grams"
    )
    dealt = dealt.select(F.least("own", "with").alias("low"), F.greatest("own", "with").alias("high"), *dealt.columns)

    def count(table: pa.Table) -> pa.Table:
        n, copies = (table.column(c).to_numpy() for c in ("n", "copies"))
        own, low, high = (table.column(c).to_numpy() for c in ("own", "low", "high"))
        sets = [np.frombuffer(g.as_buffer(), _U) for g in table.column("grams")]
        others = np.zeros(len(n), np.int64)
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        for lo in range(0, len(left), BLOCK):
            some = left[lo : lo + BLOCK]
            for at in range(0, len(right), BLOCK):
                more = right[at : at + BLOCK]
                common = np.rint(_overlaps([sets[i] for i in some], [sets[i] for i in more])).astype(np.int64)
                near = 100 * common >= threshold * (n[some][:, None] + n[more][None, :] - common)
                near &= some[:, None] != more[None, :]
                others[some] += near @ copies[more]
                if low[0] != high[0]:
                    others[more] += copies[some] @ near
        return table.select(["doc_id", "n", "k1", "k2"]).append_column("others", pa.array(others, pa.int64()))

    of_large = dealt.groupBy("c", "low", "high").applyInArrow(count, "doc_id long, n long, k1 long, k2 long, others long")
    of_large = of_large.groupBy(F.col("doc_id").alias("rep"), "n", "k1", "k2").agg(F.sum("others").alias("others"))
    return of_two.unionByName(of_large)


def similar_sets(docs: DataFrame, gram: int = GRAM, threshold: int = THRESHOLD, count_links: bool = True) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_proof_links, n_links`` for each row of ``docs`` (``doc_id`` long, ``text``).

    Equal sets are one node, named by its least doc_id, so copies are never joined with each other; the
    nodes' component is the least doc_id that links lead to. ``n_links`` counts all other rows the row links with,
    copies included, those between members of one component too; without ``count_links`` it is left out.
    ``n_proof_links`` counts the links of the node that were verified to find the component. Texts without
    words (null, empty) link with nothing. Rows with null doc_id are returned with an empty component and not
    linked. Rows with one doc_id should have one text; if not, all texts of the id count as linked through it.

    The join runs in two rounds. First each list of nodes that share a prefix n-gram is joined with its
    least node only; components of these links are found; then all pairs of a list whose components still
    differ are joined. Pairs of one component need no proof, so a large group of near copies costs about
    one pair a member, yet no link between different components is lost. Links within components are counted
    afterwards, all pairs of a component against each other in blocks of sets.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    known = docs.filter("doc_id IS NOT NULL")
    signed = written(_signatures(known, gram), "jaccard-sets")
    sets = written(
        signed.filter("n > 0")
        .groupBy("n", "k1", "k2")
        .agg(F.min("doc_id").alias("rep"), F.first("parts").alias("parts"), F.count(F.lit(1)).alias("copies")),
        "jaccard-nodes",
    )
    bits = table_bits(text_bytes(known))
    tables = _tables(known, gram, bits)
    lists = written(
        _prefixes(known, gram, threshold, tables, bits)
        .groupBy("token", "n", "k1", "k2")
        .agg(F.min("doc_id").alias("rep"), F.min("place").alias("place")),
        "jaccard-lists",
    )
    tables.destroy()
    lists = lists.select("token", "rep", "n", "place")
    least = lists.groupBy("token").agg(F.min(F.struct("rep", "n", "place")).alias("x"), F.count(F.lit(1)).alias("m")).filter("m > 1")

    def possible(x: str) -> Column:
        n, m = F.col(f"{x}n"), F.col("n")
        need = least_common(n, m, threshold)
        length = F.least(n, m) * 100 >= F.greatest(n, m) * threshold
        return length & (F.least(n - F.col(f"{x}place"), m - F.col("place")) >= need)

    first = (
        lists.join(least, "token")
        .filter((F.col("rep") > F.col("x.rep")) & possible("x."))
        .select(F.col("x.rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    links = _verified(first, known, sets, gram, threshold, "jaccard-first")
    found = written(components(links), "jaccard-first-components")
    marked = lists.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep")
    )
    mixed_lists = marked.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    open_lists = written(marked.join(mixed_lists.select("token"), "token", "left_semi"), "jaccard-open")
    other = open_lists.select("token", *[F.col(c).alias(f"o_{c}") for c in ("rep", "n", "place", "component")])
    second = (
        open_lists.join(other, "token")
        .filter((F.col("o_rep") < F.col("rep")) & (F.col("o_component") != F.col("component")) & possible("o_"))
        .select(F.col("o_rep").alias("a"), F.col("rep").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    links = links.unionByName(_verified(second, known, sets, gram, threshold, "jaccard-second"))
    # Texts of one id link their nodes.
    texts = signed.filter("n > 0").select("doc_id", "n", "k1", "k2")
    several = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("doc_id")
    through = texts.join(several, "doc_id", "left_semi").join(sets.select("n", "k1", "k2", "rep"), ["n", "k1", "k2"])
    through = through.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).filter("a <> b").distinct()
    parts = written(components(links.unionByName(through)), "jaccard-components")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_proof_links"))
    nodes = sets.join(parts.withColumnRenamed("node", "rep"), "rep", "left").join(ends.withColumnRenamed("node", "rep"), "rep", "left")
    nodes = nodes.select(
        "rep", "n", "k1", "k2", "copies", F.coalesce("component", "rep").alias("c"), F.coalesce("n_proof_links", F.lit(0)).alias("n_proof_links")
    )
    if count_links:
        nodes = written(nodes, "jaccard-linked-nodes")
        others = _count_links(nodes.drop("n_proof_links"), known, links, gram, threshold)
        nodes = nodes.join(others, ["rep", "n", "k1", "k2"], "left").withColumn("n_links", F.col("copies") - 1 + F.coalesce("others", F.lit(0)))
    counted = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    out = signed.join(nodes, ["n", "k1", "k2"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("c", "doc_id").alias("component_id"),
        F.coalesce("n_proof_links", F.lit(0)).cast("long").alias("n_proof_links"),
        *counted,
    )
    unnamed = _signatures(docs.filter("doc_id IS NULL"), gram)
    return out.unionByName(
        unnamed.select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(0).cast("long").alias("n_proof_links"),
            *[F.lit(0).cast("long").alias(c) for c in out.columns[4:]])
    )


def keep_one(docs: DataFrame, gram: int = GRAM, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each group of similar texts: that with the least doc_id. Of rows with that
    doc_id the one with the least text stays (null first), of equal ones any. Rows without doc_id stay."""
    found = similar_sets(docs.select("doc_id", "text"), gram, threshold, count_links=False).filter("doc_id IS NOT NULL AND component_id = doc_id")
    mark, row = (free_name(c, docs.columns) for c in ("similar_id", "similar_row"))
    kept = found.select(F.col("doc_id").alias(mark)).distinct()
    chosen = docs.join(kept, F.col("doc_id") == F.col(mark), "left_semi")
    order = F.struct(F.col("text").isNotNull(), "text", F.xxhash64(*docs.columns), F.struct(*docs.columns).alias("whole"))
    one = chosen.groupBy(F.col("doc_id").alias(mark)).agg(F.min_by(F.struct(*docs.columns), order).alias(row))
    return one.select(f"{row}.*").unionByName(docs.filter("doc_id IS NULL"))
