"""Keywords found in names by an Aho-Corasick automaton, one pass over each distinct name of a batch.

The automaton (a trie of all keywords with failure links) is built in the task from a broadcast list, so the
cost of a name does not depend on the number of keywords. Lists beyond MOST_KEYWORDS are not broadcast: the parts
of a name that have the length of a keyword, and by a bit table of bounded size may be one, are joined with the
keywords, and a name takes the best of its finds. Both forms fold case and find word borders by the same functions.

Case is folded by one rule for keywords and names: each character to upper, then to lower case, where that is
one character; so lengths stay, and the forms of a letter (sigma, long s, dotted i) meet.
"""

from __future__ import annotations

import unicodedata
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.sources.scratch import staged

#: Keywords of one automaton: some 100 bytes each, broadcast to the tasks.
MOST_KEYWORDS = 500_000
#: log2 of the size of the bit table of longer lists; a keyword sets two of some 16 bits, fewer in very long lists.
LEAST_BITS, MOST_BITS = 16, 28
_BITMAP = 1 << 15  # bits of a row of Spark's bitmap aggregates
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_FOUND = "struct<shorter: int, section_ord: int, kw_ord: int, keyword: string, section: string>"
_FIELDS = ["shorter", "section_ord", "kw_ord", "keyword", "section"]
_KINDS = pa.struct([*[(c, pa.int32()) for c in _FIELDS[:3]], *[(c, pa.string()) for c in _FIELDS[3:]]])
_JOINERS = ("‌", "‍")


class _Folding(dict):
    """Code point to its folded one, worked out when it is first met."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        upper = c.upper()
        c = upper if len(upper) == 1 else c
        lower = c.lower()
        # The dotted capital I is the one letter whose lower case is a letter and a mark.
        self[code] = folded = ord(lower if len(lower) == 1 else lower[0] if lower[1:] == "̇" else c)
        return folded


_FOLDING = _Folding()


def fold(text: str) -> str:
    return text.translate(_FOLDING)


def _is_word(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c) in ("Mn", "Mc", "Me", "Nd", "Nl", "Pc") or c in _JOINERS


def _at_borders(text: str, start: int, end: int) -> bool:
    """Whether a word begins or ends at both ends of a find."""

    def border(i: int) -> bool:
        before, after = i > 0 and _is_word(text[i - 1]), i < len(text) and _is_word(text[i])
        return before != after

    return border(start) and border(end)


def automaton(keywords: list[str], ignore_case: bool):
    """The automaton of keywords in order of rank; a find has the best rank of its spelling and its length."""
    import ahocorasick

    best: dict[str, int] = {}
    for rank, keyword in enumerate(keywords):
        best.setdefault(fold(keyword) if ignore_case else keyword, rank)
    made = ahocorasick.Automaton()
    for spelling, rank in best.items():
        made.add_word(spelling, (rank, len(spelling)))
    if best:
        made.make_automaton()
    return made


def best_rank(text: str, made, word_boundary: bool, ignore_case: bool) -> int | None:
    """The least rank of the keywords in a text."""
    if not len(made):
        return None
    best = None
    for end, (rank, size) in made.iter(fold(text) if ignore_case else text):
        if (best is None or rank < best) and (not word_boundary or _at_borders(text, end + 1 - size, end + 1)):
            best = rank
    return best


#: The automata this worker has built, by the rule list they are of; the last two stay.
_BUILT: dict[tuple, tuple] = {}


def _rules_and_automaton(shared, name: str, ignore_case: bool) -> tuple:
    if (name, ignore_case) not in _BUILT:
        while len(_BUILT) > 1:
            _BUILT.pop(next(iter(_BUILT)))
        rows = shared.value
        _BUILT[name, ignore_case] = rows, automaton([r[3] for r in rows], ignore_case)
    return _BUILT[name, ignore_case]


def _finder(shared, word_boundary: bool, ignore_case: bool):
    """The column function of one automaton: a name to its best rule, or null."""
    name = uuid.uuid4().hex

    @F.arrow_udf(_FOUND)
    def find(names: pa.Array) -> pa.Array:
        rows, made = _rules_and_automaton(shared, name, ignore_case)
        coded = names.dictionary_encode()
        ranks = [None if t is None else best_rank(t, made, word_boundary, ignore_case) for t in coded.dictionary.to_pylist()]
        found = pa.array([None if r is None else dict(zip(_FIELDS, rows[r], strict=True)) for r in ranks], _KINDS)
        return found.take(coded.indices)

    return find


def _usable(rules: DataFrame, longest_match: bool) -> DataFrame:
    shorter = -F.char_length("keyword") if longest_match else F.lit(0)
    return rules.where(F.col("keyword") != "").select(shorter.cast("int").alias("shorter"), *[F.col(c) for c in _FIELDS[1:]])


def with_best_match(
    names: DataFrame, column: str, name: Column, rules: DataFrame, word_boundary: bool = False, ignore_case: bool = False,
    longest_match: bool = False,
) -> DataFrame:
    """``names`` with a struct ``column``: ``section, keyword`` (and their order) of the first rule whose keyword
    the name holds, by section and keyword order, or with ``longest_match`` of the longest first; null where none
    does, and for null.

    ``rules`` has ``section, section_ord, kw_ord, keyword``; empty and null keywords match nothing. With
    ``word_boundary`` a word begins or ends at both ends of the find."""
    usable = _usable(rules, longest_match)
    if usable.limit(MOST_KEYWORDS + 1).count() > MOST_KEYWORDS:
        return _joined(names, column, name, usable, word_boundary, ignore_case)
    ranked = sorted((tuple(r) for r in usable.collect()), key=lambda r: tuple((x is not None, x) for x in r))
    return names.withColumn(column, _finder(rules.sparkSession.sparkContext.broadcast(ranked), word_boundary, ignore_case)(name))


def _letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text ends in the row of all their characters; sums of the characters, each times a power of
    the base by its place, before each place; and the powers that shift a difference of sums to place 0."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    powers = np.cumprod(np.full(len(codes), _BASE), dtype=np.uint64)
    back = np.cumprod(np.full(len(codes) + 1, _BACK), dtype=np.uint64)
    return ends, np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * powers, dtype=np.uint64)]), back


def _bit_places(sums: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of a part of a text."""
    mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(31)
    return mixed >> np.uint64(64 - bits), mixed & np.uint64((1 << bits) - 1)


def _bit_table(words: DataFrame, bits: int) -> np.ndarray:
    """The bits of all spellings, of bounded size."""

    def places(batches):
        for batch in batches:
            ends, sums, back = _letters(batch.column(0).to_pylist())
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            every = np.unique(np.concatenate(_bit_places((sums[ends] - sums[starts]) * back[starts], bits)))
            yield pa.RecordBatch.from_arrays([pa.array(every.astype(np.int64))], ["place"])

    place = F.col("place")
    rows = words.select("spelling").mapInArrow(places, "place long").groupBy(F.floor(place / _BITMAP).alias("chunk"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for row in rows.agg(F.bitmap_construct_agg(place % _BITMAP).alias("bits")).toLocalIterator():
        table[row["chunk"] * _BITMAP // 8 : (row["chunk"] + 1) * _BITMAP // 8] = np.frombuffer(row["bits"], np.uint8)
    return table


def _joined(names: DataFrame, column: str, name: Column, usable: DataFrame, word_boundary: bool, ignore_case: bool) -> DataFrame:
    """``with_best_match`` for a list too long to be broadcast: an equality join of spellings, so exact whatever the
    bit table lets through."""
    spark = names.sparkSession

    @F.arrow_udf("string")
    def folded(keywords: pa.Array) -> pa.Array:
        return pa.array([fold(k) for k in keywords.to_pylist()], pa.string())

    spelling = folded("keyword") if ignore_case else F.col("keyword")
    best = usable.withColumn("spelling", spelling).groupBy("spelling").agg(F.min(F.struct(*_FIELDS)).alias("found"))
    words = staged(best, "keyword-spellings")
    sizes = sorted(r["size"] for r in words.select(F.char_length("spelling").alias("size")).distinct().collect())
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * words.count()).bit_length()))
    shared = spark.sparkContext.broadcast(_bit_table(words, bits))

    def parts(batches):
        table = shared.value
        for batch in batches:
            given = batch.column(0).to_pylist()
            texts = [fold(t) if ignore_case else t for t in given]
            ends, sums, back = _letters(texts)
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            owner = np.repeat(np.arange(len(texts)), ends - starts)
            left = ends[owner] - np.arange(len(owner))  # characters from here to the end of the name
            out: set[tuple[int, str]] = set()
            for size in sizes:
                at = np.flatnonzero(left >= size)
                if not len(at):
                    break
                here = (sums[at + size] - sums[at]) * back[at]
                one, two = _bit_places(here, bits)
                is_set = lambda place: (table[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
                held = is_set(one)
                at, two = at[held], two[held]
                at = at[is_set(two)]
                for i in at.tolist():
                    of = int(owner[i])
                    start = i - int(starts[of])
                    if not word_boundary or _at_borders(given[of], start, start + size):
                        out.add((of, texts[of][start : start + size]))
            rows = list(out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array([r[0] for r in rows], pa.int64())), pa.array([r[1] for r in rows], pa.string())],
                ["matched_name", "spelling"],
            )

    every = names.select(name.alias("matched_name")).where("matched_name IS NOT NULL").distinct()
    found = every.mapInArrow(parts, "matched_name string, spelling string").join(words, "spelling")
    found = staged(found.groupBy("matched_name").agg(F.min("found").alias(column)), "keyword-finds")
    named = names.withColumn("name_to_match", name)
    return named.join(found, F.col("name_to_match") == F.col("matched_name"), "left").drop("name_to_match", "matched_name")
