"""Language-model scores from a weighted backoff automaton.

Counts of words and n-grams are gathered from all training texts: texts are worked on in blocks, a block sends
each of its distinct n-grams once, with its count, to the shard of the n-gram's hash, and gets the count over the
corpus back. With them a block builds the part of the automaton that its texts can reach. Its states are the
contexts seen, an arc for each n-gram seen bears the log10 of its smoothed probability, and a failure arc to the
context without its first word bears the log10 of the share that context leaves to words not seen after it. One
pass over the tokens then carries the state and adds up the weights of the arcs taken.

Smoothing: the shorter context's probability counts as ``mass`` occurrences of the context; below all is the
word's share, where every word and one unknown word get ``add`` occurrences more.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import written
from rollbook.llm.hashing import blocks, column_bytes, mixed, runs, word_hashes
from rollbook.llm.sketch import text_bytes

#: Words of an n-gram, occurrences that a shorter context counts for, and those added to every word.
ORDER = 2
MASS = 250.0
ADD = 0.1
#: Bytes of text to a block and to a shard of n-grams; both grow with the root of a corpus beyond 1 TB, to 8
#: times as much, so that what a block has for a shard stays a row worth sending.
BLOCK_BYTES = 1 << 23
SHARD_BYTES = 1 << 25
#: Bits of an n-gram's hash beyond those that number the bytes of the corpus: one n-gram in a million meets another.
SPARE_BITS = 20
_U = np.uint64
#: What stands for the begin and the end of a text; no word.
BEGIN, END = (int(x) for x in mixed(np.array([0x6265676996, 0x656E64A996], _U)))

_BLOCK = "block long, ids array<long>, trains array<boolean>, lengths array<long>, vocabulary binary, tokens binary"
_GRAMS = "gram_order int, shard int, grams binary, counts binary"
_SCORES = "doc_id long, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _pack(values: np.ndarray) -> bytes:
    """Bytes of the numbers, those of equal weight side by side, compressed."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


class _Texts:
    """Tokens of a block of texts, each text with a begin before and an end after its words."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, order: int, bits: int):
        self.tokens, self.lengths = tokens, lengths
        self.begins = np.cumsum(lengths) - lengths
        inside = np.arange(len(tokens)) - np.repeat(self.begins, lengths)
        #: By order: places at which an n-gram ends, its number at each of them, and the distinct ones' hashes.
        self.places, self.numbers, self.grams = [], [], []
        for k in range(1, order + 1):
            place = np.flatnonzero(inside >= k - 1)
            h = tokens if k == 1 else runs(tokens, k)[place - k + 1] >> _U(64 - bits)
            distinct, number = np.unique(h, return_inverse=True)
            self.places.append(place)
            self.numbers.append(number)
            self.grams.append(distinct)


def _gathered(order: int, bits: int, n_shards: int, block_bytes: int):
    """Cuts batches of (doc_id, text, trained) into blocks: a row for the block, and one for each shard and
    order with the hashes of n-grams and their counts in training texts."""
    names = [f.split(" ")[0] for f in f"{_BLOCK}, {_GRAMS}".split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def rows_of(number, ids, trains, hashes, lengths):
        texts = _Texts(np.concatenate(hashes), np.array(lengths, np.int64), order, bits)
        block = TaskContext.get().partitionId() << 32 | number
        yield block, ids, trains, lengths, _pack(texts.grams[0]), _pack(texts.numbers[0]), None, None, None, None
        trained = np.repeat(np.array(trains, bool), texts.lengths)
        for k, (place, number_at, grams) in enumerate(zip(texts.places, texts.numbers, texts.grams, strict=True), 1):
            counts = np.bincount(number_at[trained[place]], minlength=len(grams))
            shard = _shards(grams, 64 if k == 1 else bits, n_shards)
            cuts = np.searchsorted(shard, np.arange(n_shards + 1))
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                part = grams[cuts[s] : cuts[s + 1]]
                yield block, None, None, None, None, None, k, s, _pack(np.diff(part, prepend=_U(0))), _pack(counts[cuts[s] : cuts[s + 1]])

    def gather(batches):
        number, ids, trains, hashes, lengths, size = 0, [], [], [], [], 0

        def given():
            every = list(rows_of(number, ids, trains, hashes, lengths))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in every], k) for i, k in enumerate(kinds)], names)

        for batch in batches:
            doc_ids, train = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            data, offsets = column_bytes(batch.column(1))
            for lo, hi in blocks(offsets):
                part = offsets[lo : hi + 1]
                h, _, _, at = word_hashes(data[part[0] : part[-1]], part - part[0], lower=True)
                n = np.diff(at) + 2
                tokens = np.full(int(n.sum()), END, _U)
                begins = np.cumsum(n) - n
                tokens[begins] = BEGIN
                tokens[np.arange(len(h)) + 2 * np.repeat(np.arange(hi - lo), np.diff(at)) + 1] = h
                hashes.append(tokens)
                lengths.extend(n.tolist())
                ids.extend(doc_ids[lo:hi])
                trains.extend(train[lo:hi])
                size += int(part[-1] - part[0])
                if size >= block_bytes:
                    yield given()
                    number, ids, trains, hashes, lengths, size = number + 1, [], [], [], [], 0
        if ids:
            yield given()

    return gather


def _shards(grams: np.ndarray, bits: int, n_shards: int) -> np.ndarray:
    """Shard of each hash, by ranges: sorted hashes have sorted shards."""
    top = grams >> _U(max(0, bits - 32)) if bits > 32 else grams << _U(32 - bits)
    return (top * _U(n_shards)) >> _U(32)


def _counted(part: pa.Table) -> pa.Table:
    """Counts over the corpus for what each block asked of one shard and order; a row without block has the
    number of training tokens and of distinct ones."""
    asked = part.column("block").to_pylist()
    grams = [np.cumsum(_unpack(b), dtype=_U) for b in part.column("grams").to_pylist()]
    counts = np.concatenate([_unpack(b) for b in part.column("counts").to_pylist()])
    distinct, number = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.bincount(number, weights=counts).astype(np.int64)
    cuts = np.cumsum([0, *[len(g) for g in grams]])
    k, shard = part.column("gram_order")[0].as_py(), part.column("shard")[0].as_py()
    rows = [(b, k, shard, _pack(total[number[x:y]]), None, None) for b, x, y in zip(asked, cuts, cuts[1:], strict=False)]
    if k == 1:
        words = total[distinct != _U(BEGIN)]
        rows.append((None, k, shard, None, int(words.sum()), int((words > 0).sum())))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["block", "gram_order", "shard", "counts", "n", "v"])


class BackoffAutomaton:
    """The part of the automaton that a block of texts can reach. A state is a context, by order and number
    among the block's n-grams; state of order 0 is the empty context."""

    def __init__(self, texts: _Texts, counts: list[np.ndarray], n: int, v: int, mass: float, add: float):
        share = (counts[0] + add) / (n + add * (v + 1))
        #: By order: log10 of an n-gram's probability (NaN: no arc), and of what its last word's state leaves
        #: when it fails as a context one longer.
        self.arcs, self.fails = [np.log10(share)], []
        for k in range(1, len(texts.grams)):
            place, number, grams = texts.places[k], texts.numbers[k], texts.grams[k]
            of = np.zeros(len(grams), np.int64)
            of[number] = np.arange(len(place))  # one place of each n-gram
            lower = np.full(len(texts.tokens), -1, np.int64)
            lower[texts.places[k - 1]] = texts.numbers[k - 1]
            context, shorter = lower[place[of] - 1], lower[place[of]]
            seen = counts[k - 1][context]
            share = (counts[k] + mass * share[shorter]) / (seen + mass)
            self.arcs.append(np.where(counts[k] > 0, np.log10(share), np.nan))
            self.fails.append(np.log10(mass / (counts[k - 1] + mass)))

    def walk(self, texts: _Texts) -> np.ndarray:
        """Weight of the arcs taken at each token, from the left: the state before a token is the longest
        context, the arc is its own or that of the first state along the failures that has one."""
        weight = np.zeros(len(texts.tokens))
        weight[texts.places[0]] = self.arcs[0][texts.numbers[0]]
        for k, fails in enumerate(self.fails, 1):
            place, number = texts.places[k], texts.numbers[k]
            state = np.zeros(len(texts.tokens), np.int64)
            state[texts.places[k - 1]] = texts.numbers[k - 1]
            arc = self.arcs[k][number]
            weight[place] = np.where(np.isnan(arc), fails[state[place - 1]] + weight[place], arc)
        return weight


def _scored(block: dict, counts: list[np.ndarray], n: int, v: int, order: int, bits: int, mass: float, add: float) -> pa.Table:
    lengths = np.array(block["lengths"], np.int64)
    vocabulary = _unpack(block["vocabulary"])
    texts = _Texts(vocabulary[_unpack(block["tokens"]).astype(np.int64)], lengths, order, bits)
    automaton = BackoffAutomaton(texts, counts, n, v, mass, add)
    token = np.ones(len(texts.tokens), bool)
    token[texts.begins] = False
    known = counts[0][texts.numbers[0]] > 0
    added = lambda x: np.add.reduceat(np.where(token, x, 0), texts.begins)
    columns = [
        pa.array(block["ids"], pa.int64()), pa.array(block["trains"], pa.bool_()), pa.array(lengths - 1, pa.int64()),
        pa.array(added(known.astype(np.int64)), pa.int64()), pa.array(np.full(len(lengths), n), pa.int64()),
        pa.array(added(automaton.arcs[0][texts.numbers[0]]), pa.float64()), pa.array(added(automaton.walk(texts)), pa.float64()),
    ]
    return pa.table(columns, [c.split(" ")[0] for c in _SCORES.split(", ")])


def score_texts(
    docs: DataFrame, trained: Column, order: int = ORDER, mass: float = MASS, add: float = ADD, block_bytes: int | None = None,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, trained, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows that ``trained`` marks (null: not) and scores all. Tokens are the words,
    A-Z lower-cased, and one end; a null, empty or blank text is the end alone. ``n_known`` tokens occur in
    training, ``train_tokens`` are all of training. ``base_score`` is the log10 probability by words alone,
    ``score`` that by the automaton. Repeated rows and ids, null ids and ties are rows of their own, other
    columns have no part in it, an empty table gives no rows. Without training rows all words are unknown.
    """
    given = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.coalesce(trained, F.lit(False)).alias("trained")
    )
    n_bytes = text_bytes(given)
    bits = min(64, SPARE_BITS + max(1, math.ceil(math.log2(n_bytes + 2))))
    wider = min(8.0, max(1.0, math.sqrt(n_bytes / 1e12)))
    n_shards = 1 + int(n_bytes / (SHARD_BYTES * wider))
    cut = _gathered(order, bits, n_shards, block_bytes or int(BLOCK_BYTES * wider))
    parts = written(given.mapInArrow(cut, f"{_BLOCK}, {_GRAMS}"), "lm-blocks")
    asked = parts.filter("shard IS NOT NULL").select("block", "gram_order", "shard", "grams", "counts")
    told = asked.groupBy("shard", "gram_order").applyInArrow(_counted, "block long, gram_order int, shard int, counts binary, n long, v long")
    answers = written(told, "lm-counts")
    sums = answers.filter("block IS NULL").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = sums["n"] or 0, sums["v"] or 0
    texts = parts.filter("shard IS NULL").select(*[f.split(" ")[0] for f in _BLOCK.split(", ")])
    replies = answers.filter("block IS NOT NULL").select("block", "gram_order", "shard", "counts")

    def score(block: pa.Table, told: pa.Table) -> pa.Table:
        by_order: list[list] = [[] for _ in range(order)]
        for k, s, blob in sorted(zip(*[told.column(c).to_pylist() for c in ("gram_order", "shard", "counts")], strict=True)):
            by_order[k - 1].append(_unpack(blob))
        counts = [np.concatenate(x).astype(np.float64) if x else np.zeros(0) for x in by_order]
        return _scored(block.to_pylist()[0], counts, n, v, order, bits, mass, add)

    return texts.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, _SCORES)
