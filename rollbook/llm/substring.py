"""Substring dedup with suffix automata of reference shards.

A window is so many consecutive words of one text. Each has an anchor that depends on its words only, the
least hash of a short run in it, so equal windows have equal anchors. A bit table of bounded size tells
anchors that no second text can have: their windows are left alone. The rest is cut into pieces with one
anchor. The distinct
pieces of a range of anchors are a reference shard: a suffix automaton over its words, each state marked
with the least document that has it. Pieces are streamed through their shard for matching statistics, and
windows that begin in an earlier document are taken out as maximal spans.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rollbook.llm.common import give_back_memory, let, text_or_empty, written
from rollbook.llm.hashing import blocks, column_bytes, runs, sliced, word_hashes
from rollbook.llm.sketch import is_shared, shared_bits, table_bits, text_bytes

#: Words of a window, and of the runs whose least hash is its anchor.
WINDOW = 13
RUN = 5
#: Groups of equal texts that are broadcast; more are joined by shuffle.
BROADCAST_COPIES = 500_000
#: Bound of the broadcast bit table (32 MB); a fuller one lets more pieces through, and loses none.
MOST_BITS = 28
#: Bytes of text to a reference shard; its pieces are about an eighth of them.
SHARD_BYTES = 150_000
#: Anchors that more rows have are hot: their pieces shrink to distinct ones before they meet.
HOT_ROWS = 200
#: Hot places to a salt: so many of one form at most, by a hash, meet its answer in one group.
SALT_ROWS = 20_000
_U = np.uint64


def _windows(data: np.ndarray, part: np.ndarray, window: int, run: int):
    """Per window that lies in one row: row, first word, anchor's word and hash; and the words."""
    h, starts, ends, at = word_hashes(data, part)
    n = len(h) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, _U), (starts, ends, at)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = np.flatnonzero(row[:n] == row[window - 1 :])
    short = runs(h, run)
    width = window - run + 1
    view = np.lib.stride_tricks.sliding_window_view(short, width)[first]
    least = view.argmin(axis=1) + first
    return row[first], first, least, short[least], (starts, ends, at)


def _row_anchors(window: int, run: int):
    def rows_of(batch: pa.RecordBatch):
        data, offsets = column_bytes(batch.column(1))
        for lo, hi in blocks(offsets):
            part = offsets[lo : hi + 1]
            row, _, _, anchor, _ = _windows(data[part[0] : part[-1]], part - part[0], window, run)
            cuts = np.searchsorted(row, np.arange(hi - lo + 1))
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    yield anchor[a:b]

    return rows_of


def _pieces(docs: DataFrame, window: int, run: int, shared: Broadcast, bits: int, hot: bool) -> DataFrame:
    """``anchor, piece, doc_id, th, start``: maximal runs of windows with one anchor that may be shared; the
    words of a piece are joined by single spaces, ``start`` is its first word. Of hot anchors or the others."""

    def cut(batches):
        of_anchor, hot_anchor = shared.value
        for batch in sliced(batches, 1):
            ids, ths = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            data, offsets = column_bytes(batch.column(1))
            out = ([], [], [], [], [])
            for lo, hi in blocks(offsets):
                part = offsets[lo : hi + 1]
                own = data[part[0] : part[-1]]
                row, first, place, anchor, (starts, ends, at) = _windows(own, part - part[0], window, run)
                maybe = is_shared(of_anchor, anchor, bits)
                maybe = np.flatnonzero(maybe & (is_shared(hot_anchor, anchor, bits - 3) == hot))
                if not len(maybe):
                    continue
                row, first, place, anchor = row[maybe], first[maybe], place[maybe], anchor[maybe]
                new = np.ones(len(maybe), bool)
                new[1:] = (np.diff(first) != 1) | (np.diff(place) != 0) | (np.diff(row) != 0)
                begin = np.flatnonzero(new)
                end = np.append(begin[1:], len(maybe)) - 1
                raw = own.tobytes()
                for b, e in zip(begin.tolist(), end.tolist(), strict=True):
                    w0, w1 = first[b], first[e] + window
                    out[0].append(anchor[b])
                    out[1].append(b" ".join(raw[starts[w0] : ends[w1 - 1]].split()))
                    out[2].append(ids[lo + row[b]])
                    out[3].append(w0 - at[row[b]])
                    out[4].append(ths[lo + row[b]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(out[0], _U).view(np.int64)), pa.array(out[1], pa.binary()).cast(pa.string()),
                 pa.array(out[2], pa.int64()), pa.array(out[4], pa.int64()), pa.array(out[3], pa.int32())],
                ["anchor", "piece", "doc_id", "th", "start"],
            )
        give_back_memory()

    return docs.mapInArrow(cut, "anchor long, piece string, doc_id long, th long, start int")


class Automaton:
    """Suffix automaton over words. Strings are added in ascending order of their documents; ``least`` of a
    state is the first document in which its strings occur."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.least = [-1], [0], [-1]

    def add(self, words: list, doc: int) -> None:
        nxt, link, length, least = self.next, self.link, self.length, self.least
        last = 0
        for w in words:
            at = nxt[last].get(w)
            if at is not None and length[at] == length[last] + 1:
                last = at
                continue
            if at is None:
                new = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                least.append(doc)
                p = last
                while p != -1 and w not in nxt[p]:
                    nxt[p][w] = new
                    p = link[p]
                if p != -1:
                    q = nxt[p][w]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, q, w)
                last = new
            else:
                last = self._split(last, at, w)

    def _split(self, p: int, q: int, w) -> int:
        """A state of its own for the shorter strings of ``q``."""
        nxt, link, length = self.next, self.link, self.length
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        self.least.append(self.least[q])
        link[q] = new
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = new
            p = link[p]
        return new

    def first_documents(self, words: list, window: int) -> list[int]:
        """For each window of ``words`` the first document that has it, or -1."""
        nxt, link, length, least = self.next, self.link, self.length, self.least
        state, matched, out = 0, 0, []
        for i, w in enumerate(words):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                matched += 1
            while state and length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if i >= window - 1:
                out.append(least[state] if matched >= window else -1)
        return out


def _first_documents(keys: list, pieces: list[str], docs: list[int], window: int) -> list[list[int]]:
    """Of each piece, the first document of each of its windows among pieces with its key (anchor). An
    automaton is built where an anchor has pieces of more than one form of words."""
    order = sorted(range(len(keys)), key=lambda i: (keys[i], docs[i]))
    out: list[list[int]] = [[]] * len(keys)
    i = 0
    while i < len(order):
        j = i
        while j < len(order) and keys[order[j]] == keys[order[i]]:
            j += 1
        forms: dict[str, int] = {}
        for k in order[i:j]:  # in order of their documents
            forms.setdefault(pieces[k], docs[k])
        if len(forms) == 1:  # all its windows begin where it does first
            ((form, doc),) = forms.items()
            first = {form: [doc] * (form.count(" ") + 2 - window)}
        else:
            shard = Automaton()
            split = {form: form.split(" ") for form in forms}
            for form, doc in forms.items():
                shard.add(split[form], doc)
            first = {form: shard.first_documents(split[form], window) for form in forms}
        for k in order[i:j]:
            out[k] = first[pieces[k]]
        i = j
    return out


def _spans(first: list[int], doc: int) -> list[tuple[int, int]]:
    """Runs (from, length) of windows that begin in an earlier document."""
    out, i = [], 0
    while i < len(first):
        j = i
        while j < len(first) and first[j] < doc:
            j += 1
        if j > i:
            out.append((i, j - i))
        i = j + 1
    return out


def _found_spans(docs: DataFrame, window: int, run: int) -> tuple[DataFrame, Broadcast]:
    """``repeated_spans`` before it is written, and the bit tables that it needs until then."""
    n_bytes = text_bytes(docs)
    bits = table_bits(n_bytes, per_byte=0.3, most=MOST_BITS)
    tables = docs.sparkSession.sparkContext.broadcast(tuple(shared_bits(docs, _row_anchors(window, run), bits, (2, HOT_ROWS))))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(1 + n_bytes // SHARD_BYTES)).cast("int").alias("shard")

    def answer(part: pa.Table) -> pa.Table:
        keys, pieces, ids, ths, starts = (part.column(c).to_pylist() for c in ("anchor", "piece", "doc_id", "th", "start"))
        out: tuple[list, ...] = ([], [], [])
        for first, doc, th, start in zip(_first_documents(keys, pieces, ids, window), ids, ths, starts, strict=True):
            spans = [{"at": start + at, "n": n} for at, n in _spans(first, doc)]
            if spans:
                for values, x in zip(out, (doc, th, spans), strict=True):
                    values.append(x)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])))
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds, strict=True)], ["doc_id", "th", "spans"])

    # Within a shard half the anchor's bits tell anchors apart; should two share them, they share an automaton.
    usual = _pieces(docs, window, run, tables, bits, False).select(
        shard, F.shiftright("anchor", 32).cast("int").alias("anchor"), "doc_id", "th", "start", "piece"
    )
    told = usual.groupBy("shard").applyInArrow(answer, "doc_id long, th long, spans array<struct<at: int, n: int>>")

    crowded = written(_pieces(docs, window, run, tables, bits, True).withColumn("form", F.xxhash64("piece")), "substring-hot", "zstd")
    # An anchor may have a form for every document, so they never meet in one task: the least document of a
    # window is an aggregate over the windows of all forms (equal windows have equal anchors).
    distinct = written(crowded.groupBy("anchor", "form", "piece").agg(F.min("doc_id").alias("doc_id")), "substring-forms", "zstd")
    in_form = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - window), lambda i: F.array_join(F.slice(w, i + 1, F.lit(window)), " ")
    )
    windows = distinct.select("anchor", "form", "doc_id", F.posexplode(let(F.split("piece", " "), in_form)).alias("place", "words"))
    windows = windows.select(
        "anchor", "form", "doc_id", "place", F.xxhash64("words").alias("h0"), F.xxhash64(F.lit(1), "words").alias("h1")
    )
    least = windows.groupBy("h0", "h1").agg(F.min("doc_id").alias("least"))
    resolved = (
        windows.drop("doc_id").join(least, ["h0", "h1"])
        .groupBy("anchor", "form").agg(F.sort_array(F.collect_list(F.struct("place", "least"))).alias("p"))
        .select("anchor", "form", F.transform("p", lambda x: x["least"]).alias("first"))
    )
    # A form may stand in a third of all texts: its places are dealt over salts, and each salt that has any gets
    # the form's answer, which is given to them in a window.
    salt = F.pmod(F.xxhash64("doc_id", "start"), F.lit(1 + crowded.count() // SALT_ROWS)).alias("salt")
    places = crowded.select("anchor", "form", salt, "doc_id", "th", "start")
    given = resolved.join(places.select("anchor", "form", "salt").distinct(), ["anchor", "form"])
    together = Window.partitionBy("anchor", "form", "salt")
    found = places.unionByName(given, allowMissingColumns=True).withColumn("first", F.max("first").over(together)).filter("start IS NOT NULL")
    # Runs of windows that begin earlier, from their first and last windows.
    earlier = lambda i: F.coalesce(F.get("first", i) < F.col("doc_id"), F.lit(False))
    every = F.sequence(F.lit(0), F.size("first") - 1)
    begins = F.filter(every, lambda i: earlier(i) & ~earlier(i - 1))
    ends = F.filter(every, lambda i: earlier(i) & ~earlier(i + 1))
    spans = F.zip_with(begins, ends, lambda x, y: F.struct((F.col("start") + x).cast("int").alias("at"), (y - x + 1).cast("int").alias("n")))
    hot_spans = found.select("doc_id", "th", spans.alias("spans")).filter(F.size("spans") > 0)
    whole = told.unionByName(hot_spans).repartition("doc_id", "th")
    return whole.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")), tables


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """``doc_id, th, spans``: (first window, number of windows) that an earlier document has too, of the rows
    of ``docs`` (``doc_id, text, th``) that have any; ``th`` is a hash of the text.

    Pieces go to the shard of their anchor as they are, and a shard tells each its spans. Hot anchors would
    bring too many rows together: their pieces are made distinct first, the windows of those get their first
    documents by an aggregate, and the answers are joined back."""
    found, tables = _found_spans(docs, window, run)
    spans = written(found, "substring-spans")
    tables.destroy()
    return spans


def without_repeats(
    docs: DataFrame, window: int = WINDOW, run: int = RUN, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` with ``n_words, n_removed`` (long) and its text without repeated spans.

    A word goes if a window of ``window`` words over it also begins in a document with a smaller id; windows
    are judged on the texts given. Cut out with a span are the blanks after it; other texts stay as they are.
    Null text: no words, stays null. Rows without id are neither cut nor compared. Of rows with one id
    none counts as earlier than another. Result columns that ``docs`` has already are replaced.
    """
    kept = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed")]
    rename = {c: f"given_{k}" for k, c in enumerate(kept)}
    given = docs.select(*[F.col(c).alias(n) for c, n in rename.items()])
    given = given.withColumns({"doc_id": F.col(rename[id_column]).cast("long"), "th": F.xxhash64(rename[text_column])})
    texts = given.filter("doc_id IS NOT NULL").select("doc_id", text_or_empty(F.col(rename[text_column])).alias("text"), "th")
    # Of equal texts only the first is looked into; in the others every window begins earlier.
    sha = F.sha2(rename[text_column], 256)
    copies = written(
        given.filter("doc_id IS NOT NULL").groupBy(sha.alias("sha")).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last"),
        "substring-copies",
    ).select("sha", "first")
    copies = F.broadcast(copies) if copies.count() <= BROADCAST_COPIES else copies
    earlier = copies.select("sha", F.col("first").alias("earlier"))
    firsts = texts.withColumn("of", F.sha2("text", 256)).join(copies, (F.col("of") == F.col("sha")) & (F.col("doc_id") > F.col("first")), "left_anti")
    spans = repeated_spans(firsts.select("doc_id", "text", "th"), window, run)
    spans = spans.select(F.col("doc_id").alias("span_doc"), F.col("th").alias("span_th"), "spans")
    joined = given.join(spans, (F.col("doc_id") == F.col("span_doc")) & (F.col("th") == F.col("span_th")), "left")
    joined = joined.withColumn("of", sha).join(earlier, (F.col("of") == F.col("sha")) & (F.col("doc_id") > F.col("earlier")), "left")
    joined = joined.select(*rename.values(), "spans", F.col("earlier").isNotNull().alias("copy"))
    place = kept.index(text_column)

    def cut(batches):
        for batch in sliced(batches, place):
            data, offsets = column_bytes(batch.column(place))
            spans_of, copy = batch.column(len(kept)).to_pylist(), batch.column(len(kept) + 1).to_pylist()
            texts: list = batch.column(place).to_pylist()
            n_words, n_removed = [], []
            for lo, hi in blocks(offsets):
                part = offsets[lo : hi + 1]
                own = data[part[0] : part[-1]]
                _, starts, _, at = word_hashes(own, part - part[0])
                for i in range(lo, hi):
                    a, b = at[i - lo], at[i - lo + 1]
                    n_words.append(int(b - a))
                    if not spans_of[i] and not (copy[i] and b - a >= window):
                        n_removed.append(0)
                        continue
                    edge = np.zeros(b - a + 1, np.int64)
                    if copy[i]:
                        edge[0], edge[-1] = 1, -1
                    for s in spans_of[i] or ():
                        edge[s["at"]] += 1
                        edge[s["at"] + s["n"] + window - 1] -= 1
                    gone = np.cumsum(edge)[:-1] > 0
                    n_removed.append(int(gone.sum()))
                    base, raw = part[i - lo] - part[0], texts[i].encode()
                    bounds = np.append(starts[a:b] - base, len(raw))
                    head = raw[: bounds[0]] if len(gone) else raw
                    turn = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    runs_kept = [raw[bounds[x] : bounds[y]] for x, y in zip(turn[::2], turn[1::2], strict=True)]
                    texts[i] = (head + b"".join(runs_kept)).decode()
            columns = [pa.array(texts, batch.schema.field(k).type) if k == place else batch.column(k) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*kept, "n_words", "n_removed"]
            )
        give_back_memory()

    fields = [docs.schema[c] for c in kept]
    schema = StructType([*fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    return joined.mapInArrow(cut, schema)
