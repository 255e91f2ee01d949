"""Toxicity from subword-bag embeddings.

A word's vector is the mean of the vectors of its character n-grams, so an unseen spelling shares the
vectors of its parts. The vectors of a stretch of words are averaged and go into a linear softmax; both are
trained jointly. Whole texts are cut into overlapping stretches and the highest score of a stretch is the
text's, so that a few words count as much in a long text as in a short one. The mean is over all words of a
stretch; one that comes again within a half of it has no vector the second time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from rollbook.llm.common import give_back_memory, text_or_empty, written
from rollbook.llm.hashing import blocks, column_bytes, mixed, sliced, word_hashes

#: Character n-grams of a word between its marks, and the rows of the embedding table.
GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
WIDTH = 4
#: Words of half a stretch; a stretch is two halves, the next begins after one. A word counts once a half.
HALF = 20
#: A stretch's mean counts so many times in the logit: what its words would add if it were full.
FULL = 2.0 * HALF
#: Labelled rows of each class that the model is fitted on, their whole texts.
MOST_ROWS = 1500
#: A clean stretch counts as so many toxic ones.
CLEAN = 4
EPOCHS = 30
THRESHOLD = 0.3


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of words (byte ranges of ``data``) between < and >, and whose word each is."""
    length = ends - starts
    at = np.cumsum(length + 2) - (length + 2)
    total = int((length + 2).sum())
    owner = np.repeat(np.arange(len(starts), dtype=np.int32), length + 2)
    line = np.zeros(total, np.uint64)
    inside = np.ones(total, bool)
    inside[at] = inside[at + length + 1] = False
    line[at], line[at + length + 1] = ord("<"), ord(">")
    shift = np.repeat(starts - at - 1, length + 2)
    places = np.flatnonzero(inside)
    line[places] = data[places + shift[places]]
    buckets, words = [], []
    for n in GRAMS:
        m = total - n + 1
        if m <= 0:
            continue
        v = np.zeros(m, np.uint64)
        for j in range(n):
            v = v * np.uint64(257) + line[j : j + m]
        whole = np.flatnonzero(owner[:m] == owner[n - 1 :])
        buckets.append((mixed(v[whole] * np.uint64(8) + np.uint64(n)) & np.uint64(BUCKETS - 1)).astype(np.int32))
        words.append(owner[whole])
    return np.concatenate([np.zeros(0, np.int32), *buckets]), np.concatenate([np.zeros(0, np.int32), *words])


def cells(hashes: np.ndarray, row_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half stretches: which words count (each once per half stretch), the half stretch of every word, and
    the first half stretch of every row (one more at the end). Each row has at least one; words that fill no
    half are in the last one."""
    n = np.maximum(1, np.diff(row_starts) // HALF)
    first = np.append(0, np.cumsum(n))
    row = np.repeat(np.arange(len(n)), np.diff(row_starts))
    cell = first[row] + np.minimum((np.arange(len(hashes)) - row_starts[row]) // HALF, n[row] - 1)
    order = np.lexsort((hashes, cell))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (cell[order][1:] != cell[order][:-1])
    counts = np.zeros(len(hashes), bool)
    counts[order[new]] = True
    return counts, cell, first


class _Sum:
    """Sums of the rows of a matrix over sorted groups, empty groups allowed."""

    def __init__(self, groups: np.ndarray, n: int):
        self.order = np.argsort(groups, kind="stable").astype(np.int32)
        counts = np.bincount(groups, minlength=n)
        self.full = np.flatnonzero(counts)
        self.starts = (np.cumsum(counts) - counts)[self.full]
        self.n = n

    def __call__(self, rows: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Sums of ``rows[of]``, which are gathered once, in order."""
        out = np.zeros((self.n, *rows.shape[1:]), rows.dtype)
        if len(self.full):
            out[self.full] = np.add.reduceat(rows[of[self.order]], self.starts, axis=0)
        return out


def fit(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> dict:
    """The model: embedding table, softmax weights and bias. Full-batch Adam; after a third of the epochs
    each toxic text counts with its highest stretch only, since a stretch of it may be clean."""
    n_docs = len(texts)
    column = pa.array([t.lower() for t in texts], pa.string())
    data, offsets = column_bytes(column)
    h, starts, ends, at = word_hashes(data, offsets)
    del texts
    counts, cell, first = cells(h, at)
    _, index, cell_word = np.unique(h[counts], return_index=True, return_inverse=True)
    gram, gram_word = word_grams(data, starts[counts][index], ends[counts][index])
    cell_stretch, in_half = cell[counts], np.bincount(cell, minlength=int(first[-1]))
    n_words, n_stretch = len(index), int(first[-1])
    doc_of = np.repeat(np.arange(n_docs), np.diff(first))
    seen = np.zeros(BUCKETS, bool)
    seen[gram] = True
    used, gram = np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[gram]
    # The arrays below are the bulk of what training holds: four bytes each.
    cell_word, cell_stretch = cell_word.astype(np.int32), cell_stretch.astype(np.int32)
    del data, offsets, h, starts, ends, counts, cell, column
    per_word = np.maximum(np.bincount(gram_word, minlength=n_words), 1).astype(np.float32)[:, None]
    to_word, to_gram = _Sum(gram_word, n_words), _Sum(gram, len(used))
    to_stretch, back = _Sum(cell_stretch, n_stretch), _Sum(cell_word, n_words)
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((len(used), WIDTH)) * 0.1).astype(np.float32)
    # Two classes: the difference of the two rows of the softmax is what counts.
    weight, bias = (rng.standard_normal(WIDTH) * 0.5).astype(np.float32), np.float32(-2.0)
    inner = np.append(doc_of[1:] == doc_of[:-1], False).astype(np.float32)[:, None]
    in_stretch = in_half + np.append(in_half[1:], 0) * inner[:, 0]
    scale = (FULL / np.maximum(in_stretch, 1)).astype(np.float32)[:, None]
    toxic = labels[doc_of].astype(np.float32)
    n_of = np.maximum(np.bincount(doc_of, minlength=n_docs), 1)
    share = (1.0 / n_of)[doc_of].astype(np.float32)
    moment = [np.zeros_like(table), np.zeros_like(table), np.zeros(WIDTH + 1, np.float32), np.zeros(WIDTH + 1, np.float32)]
    for epoch in range(1, epochs + 1):
        word = to_word(table, gram) / per_word
        half = to_stretch(word, cell_word)
        # A stretch is a half and the one after it in the same text.
        follow = np.append(half[1:], np.zeros((1, WIDTH), np.float32), axis=0) * inner
        mean = (half + follow) * scale
        logit = mean @ weight + bias
        p = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        use = np.where(toxic > 0, share, CLEAN * np.maximum(share, 0.2))
        if epoch > epochs // 3:
            best = np.zeros(n_stretch, np.float32)
            order = np.lexsort((-logit, doc_of))
            top = order[np.append(True, doc_of[order][1:] != doc_of[order][:-1])] if n_stretch else order
            best[top] = 1
            use = np.where(toxic > 0, best, CLEAN * np.maximum(share, best))
        wrong = (use * (p - toxic) / n_docs).astype(np.float32)
        g_weight = np.append(mean.T @ wrong, wrong.sum())
        g_mean = wrong[:, None] * weight * scale
        g_mean[1:] += (g_mean * inner)[:-1]
        g_word = back(g_mean, cell_stretch) / per_word
        g_table = to_gram(g_word, gram_word) + 1e-7 * table
        for (x, g, m, v, rate) in ((table, g_table, 0, 1, 0.08), (None, g_weight, 2, 3, 0.08)):
            moment[m] = 0.9 * moment[m] + 0.1 * g
            moment[v] = 0.99 * moment[v] + 0.01 * g * g
            move = rate * (moment[m] / (1 - 0.9**epoch)) / (np.sqrt(moment[v] / (1 - 0.99**epoch)) + 1e-9)
            if x is None:
                weight, bias = weight - move[:-1].astype(np.float32), np.float32(bias - move[-1])
            else:
                table = table - move.astype(np.float32)
    whole = np.zeros((BUCKETS, WIDTH), np.float32)
    whole[used] = table
    return {"table": whole, "weight": weight, "bias": float(bias)}


def scores(model: dict, column: pa.Array) -> np.ndarray:
    """Scores of a column of lower-cased texts."""
    # The mean of vectors times the weights is the mean of what each n-gram adds to the logit.
    adds = model["adds"]
    data, offsets = column_bytes(column)
    out = []
    for lo, hi in blocks(offsets):
        part = offsets[lo : hi + 1]
        own = data[part[0] : part[-1]]
        h, starts, ends, at = word_hashes(own, part - part[0])
        counts, cell, first = cells(h, at)
        _, index, word = np.unique(h[counts], return_index=True, return_inverse=True)
        gram, gram_word = word_grams(own, starts[counts][index], ends[counts][index])
        n_words = len(index)
        each = np.bincount(gram_word, adds[gram], n_words) / np.maximum(np.bincount(gram_word, minlength=n_words), 1)
        half = np.bincount(cell[counts], each[word], int(first[-1]))
        in_half = np.bincount(cell, minlength=int(first[-1]))
        follows = np.append(np.diff(np.repeat(np.arange(hi - lo), np.diff(first))) == 0, False)
        stretch = half + np.append(half[1:], 0.0) * follows
        in_stretch = in_half + np.append(in_half[1:], 0) * follows
        out.append(np.maximum.reduceat(stretch * FULL / np.maximum(in_stretch, 1), first[:-1]))
    logit = np.concatenate(out) if out else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(logit + model["bias"], -30, 30)))


def training_rows(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS, label: str = "toxic") -> DataFrame:
    """At most ``most`` labelled rows of each class (``doc_id, text, label``), those with the least hashes;
    never rows held out: whose crc32 of the id as text leaves 2 when divided by 4."""
    picked = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    keys = []
    for value in (0, 1):
        of = picked.filter(F.col(label) == value).groupBy("doc_id").agg(F.max(label).alias("label"))
        keys.append(of.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most))
    chosen = keys[0].unionByName(keys[1]).groupBy("doc_id").agg(F.max("label").alias("label"))
    text = docs.select(F.col("doc_id").cast("long"), text_or_empty(F.col("text")).alias("text"))
    # At most 2 * most keys of two numbers: small enough to broadcast.
    joined = text.join(F.broadcast(chosen), "doc_id")
    return joined.groupBy("doc_id").agg(F.max("text").alias("text"), F.max("label").alias("label"))


def held_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_ROWS) -> dict:
    """Fit on the bounded training sample, in one task; without toxic or clean rows the model scores every
    text 0.05. Only the model comes to the driver."""

    def fitted(part: pa.Table) -> pa.Table:
        rows = sorted(part.to_pylist(), key=lambda r: r["doc_id"])
        target = np.array([r["label"] for r in rows])
        if len(set(target.tolist())) < 2:
            return part.select([]).slice(0, 0).append_column("model", pa.array([], pa.binary()))
        model = fit([r["text"] for r in rows], target)
        blob = model["table"].astype("<f4").tobytes() + np.append(model["weight"], model["bias"]).astype("<f4").tobytes()
        del rows, model
        give_back_memory()
        return pa.table({"model": pa.array([blob], pa.binary())})

    rows = training_rows(docs, labels, most).withColumn("all", F.lit(0))
    found = written(rows.groupBy("all").applyInArrow(fitted, "model binary"), "toxicity-model").first()
    if found is None:
        return {"table": np.zeros((BUCKETS, WIDTH), np.float32), "weight": np.zeros(WIDTH, np.float32), "bias": float(np.log(0.05 / 0.95))}
    values = np.frombuffer(found["model"], "<f4")
    table, rest = values[: BUCKETS * WIDTH].reshape(BUCKETS, WIDTH), values[BUCKETS * WIDTH :]
    return {"table": table, "weight": rest[:WIDTH], "bias": float(rest[WIDTH])}


def score(docs: DataFrame, model: dict, text_column: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1). Null, empty and blank texts score what no word gives; a
    column of that name is replaced."""
    adds = (model["table"] @ model["weight"]).astype(np.float64)
    shared = docs.sparkSession.sparkContext.broadcast({"adds": adds, "bias": model["bias"]})
    kept = docs.drop(*[c for c in docs.columns if c.lower() == name.lower()])
    place = kept.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            values = scores(shared.value, pc.utf8_lower(batch.column(place).fill_null("")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], [*batch.schema.names, name])
        give_back_memory()

    schema = StructType([*kept.schema.fields, StructField(name, DoubleType())])
    return kept.mapInArrow(run, schema)
