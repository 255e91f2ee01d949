"""Runs of periodic words, found with a suffix automaton under link-cut access.

Words are appended one at a time. The states that hold the suffixes of what was read lie on one path of the
automaton's tree of suffix links; a link-cut forest keeps that tree as paths whose states last occurred at
the same place. Appending a word recolours the path of its suffixes. A piece of the path that ended at ``e``
before, now ends at ``r``: its words stand ``r - e`` apart, so where that distance is the length of a suffix
in the piece, the suffix is the second half of a square. Squares are extended to runs.

The automaton is built for stretches that may hold a run: in one, every few neighbouring words occur again
within the stretch, which array operations tell for whole blocks of texts. Words outside of them lie in no run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from rollbook.llm.common import let, words
from rollbook.llm.hashing import blocks, column_bytes, mixed, runs, word_hashes

#: Least number of words of a run, and of its periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
_RUN = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
_U = np.uint64


class SuffixPaths:
    """Suffix automaton of the words appended so far; a splay tree for each path of its links whose states
    last ended at the same word. ``seen`` holds that word's number at the root of the splay tree."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]
        self.up, self.low, self.high, self.seen = [-1], [-1], [-1], [-1]
        self.last, self.n = 0, 0

    def _state(self, length: int, link: int, steps: dict) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.length.append(length)
        self.up.append(link)
        self.low.append(-1)
        self.high.append(-1)
        self.seen.append(-1)
        return len(self.link) - 1

    def _splay(self, x: int) -> None:
        """Makes ``x`` the root of its path's tree, which its ``seen`` moves along with."""
        up, low, high = self.up, self.low, self.high
        while True:
            y = up[x]
            if y == -1 or (low[y] != x and high[y] != x):
                return
            z = up[y]
            if z == -1 or (low[z] != y and high[z] != y):
                self._rotate(x, y, z)
                self.seen[x] = self.seen[y]
                return
            top = up[z]
            whole = top == -1 or (low[top] != z and high[top] != z)
            if (low[y] == x) == (low[z] == y):
                self._rotate(y, z, top)
                self._rotate(x, y, top)
            else:
                self._rotate(x, y, z)
                self._rotate(x, z, top)
            if whole:
                self.seen[x] = self.seen[z]
                return

    def _rotate(self, x: int, y: int, z: int) -> None:
        up, low, high = self.up, self.low, self.high
        if low[y] == x:
            b = high[x]
            high[x], low[y] = y, b
        else:
            b = low[x]
            low[x], high[y] = y, b
        if b != -1:
            up[b] = y
        if z != -1:
            if low[z] == y:
                low[z] = x
            elif high[z] == y:
                high[z] = x
        up[x], up[y] = z, x

    def _extend(self, w) -> int:
        """The state of the whole text after one more word."""
        nxt, link, length = self.next, self.link, self.length
        new, p = self._state(self.n + 1, 0, {}), self.last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            if length[q] != length[p] + 1:
                q = self._split(p, q, w)
            link[new] = self.up[new] = q
        return new

    def _split(self, p: int, q: int, w) -> int:
        """A state for the shorter strings of ``q``: it comes next to ``q`` on the same path."""
        new = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self._splay(q)
        above = self.low[q]
        self.low[new], self.low[q], self.up[new] = above, new, q
        if above != -1:
            self.up[above] = new
        self.link[q] = new
        nxt, link = self.next, self.link
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def append(self, w) -> list[int]:
        """Periods of the squares with an indivisible half that end at ``w``."""
        below = new = self._extend(w)
        at, found = self.n, []
        up, high, length, seen = self.up, self.high, self.length, self.seen
        x, distance, longest = up[new], 0, -1
        while x != -1:
            self._splay(x)
            # Of the piece left behind, the lengths above those of this one ended so far back.
            if length[x] < distance <= longest:
                found.append(distance)
            distance, longest = at - seen[x], length[x]
            if high[x] != -1:
                seen[high[x]] = seen[x]
            high[x] = below
            below, x = x, up[x]
        if 0 < distance <= longest:
            found.append(distance)
        seen[below] = at
        self.last, self.n = new, at + 1
        return found


def word_runs(words: list, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """``start, length, period`` of the maximal runs with ``least`` words and so many periods (2 at least)."""
    paths, until, out, n = SuffixPaths(), {}, [], len(words)
    for r, w in enumerate(words):
        for q in paths.append(w):
            if until.get(q, -1) >= r:
                continue
            end, start = r + 1, r + 1 - 2 * q
            while end < n and words[end] == words[end - q]:
                end += 1
            while start > 0 and words[start - 1] == words[start - 1 + q]:
                start -= 1
            until[q] = end - 1
            if end - start >= max(least, periods * q):
                out.append((start, end - start, q))
    return sorted(out, key=lambda x: (x[0], x[2]))


def _gram(least: int, periods: int) -> int:
    """So many neighbours, all through any run, occur again in the run, a period before or after: in a run of
    ``length`` words and period ``q`` that holds for up to ``length - 2 * q + 1`` of them."""
    return min(5, min(max(least, periods * q) - 2 * q + 1 for q in range(1, least + 1)))


def repetitive(h: np.ndarray, row: np.ndarray, gram: int) -> list[tuple[int, int]]:
    """Stretches of words in which each ``gram`` neighbours occur again within the stretch; every run lies
    in one. ``row`` tells the text of each word."""
    n = len(h) - gram + 1
    if n <= 0:
        return []
    place = np.flatnonzero(row[:n] == row[gram - 1 :])
    key, group, first = runs(h, gram)[place], row[place], True
    while len(place):
        of = mixed(key + group.astype(_U) * _U(0xD6E8FEB86659FD93))
        order = np.argsort(of, kind="stable")
        same = np.zeros(len(of) + 1, bool)
        same[1:-1] = np.diff(of[order]) == 0
        keep = np.zeros(len(of), bool)
        keep[order] = same[1:] | same[:-1]
        if keep.all() and not first:
            break
        place, key, first = place[keep], key[keep], False
        group = np.cumsum(np.diff(place, prepend=-2) != 1)
    if not len(place):
        return []
    new = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    last = np.append(new[1:], len(place)) - 1
    return [(int(place[a]), int(place[b]) + gram) for a, b in zip(new, last, strict=True)]


def _texts(column: pa.Array, least: int, periods: int) -> Iterator[tuple[list, bytes]]:
    """Runs and the text without their repeats, of each row of a batch."""
    data, offsets = column_bytes(column)
    for lo, hi in blocks(offsets):
        part = offsets[lo : hi + 1] - offsets[lo]
        own = data[offsets[lo] : offsets[hi]]
        h, starts, ends, at = word_hashes(own, part)
        row = np.repeat(np.arange(hi - lo), np.diff(at))
        raw, found = own.tobytes(), {}
        for a, b in repetitive(h, row, _gram(least, periods)):
            if b - a >= least:
                stretch = raw[starts[a] : ends[b - 1]].split()
                base = a - int(at[row[a]])
                found.setdefault(int(row[a]), []).extend((base + s, n, q) for s, n, q in word_runs(stretch, least, periods))
        for i in range(hi - lo):
            every = raw[part[i] : part[i + 1]].split()
            spans = sorted(found.get(i, ()), key=lambda x: (x[0], x[2]))
            if spans:
                edge = np.zeros(len(every) + 1, np.int64)
                for s, n, q in spans:
                    edge[s + q] += 1
                    edge[s + n] -= 1
                every = [w for w, gone in zip(every, (np.cumsum(edge) > 0).tolist(), strict=False) if not gone]
            yield spans, b" ".join(every)


def find_runs(docs: DataFrame, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS, text_column: str = "text") -> DataFrame:
    """``docs`` with ``runs`` (``start, length, period`` in words, by start, then period) and ``collapsed``.

    A run is a stretch of consecutive words with a smallest period, of at least ``least`` words and
    ``periods`` periods (2 at least), that no neighbouring word extends. ``collapsed`` is the text without the
    words that a run has after its first period, joined by one space. Null, empty and blank texts have no
    runs and collapse to the empty text. Rows are judged one by one: repeated rows and ids, null ids and
    extra columns pass through. Columns named like a result are replaced. An empty table gives an empty one.
    """
    if least < 2 or periods < 2:
        raise ValueError("a run has two words and two periods at least")
    kept = [c for c in docs.columns if c.lower() not in ("runs", "collapsed")]
    place = kept.index(text_column)
    kinds = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def told(batches):
        for batch in batches:
            spans, texts = [], []
            for s, t in _texts(batch.column(place), least, periods):
                spans.append([dict(zip(("start", "length", "period"), x, strict=True)) for x in s])
                texts.append(t)
            told_of = [pa.array(spans, kinds), pa.array(texts, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *told_of], [*kept, "runs", "collapsed"])

    schema = StructType([*[docs.schema[c] for c in kept], StructField("runs", ArrayType(_RUN)), StructField("collapsed", StringType())])
    return docs.select(*kept).mapInArrow(told, schema)


def with_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` in which a tenth of the texts, by the crc32 of the id, repeat a few of their words to the end;
    rows without an id or without words stay as they are. Words of changed texts are joined by one space."""
    crc = F.crc32(F.col(id_column).cast("string").cast("binary"))
    g = F.floor(crc / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        start = g % n
        period = 1 + F.floor((n - start) / (3 + g % 8))
        return let(
            F.struct(start.alias("a"), period.alias("p")),
            lambda x: F.array_join(
                F.transform(
                    w, lambda own, i: F.when(i < x["a"], own).otherwise(F.get(w, (x["a"] + (i - x["a"]) % x["p"]).cast("int")))
                ),
                " ",
            ),
        )

    chosen = (crc % 10 == 0) & F.col(text_column).rlike(r"[^\x20\x09-\x0D]")
    return docs.withColumn(text_column, F.when(chosen, let(words(F.col(text_column)), repeated)).otherwise(F.col(text_column)))
