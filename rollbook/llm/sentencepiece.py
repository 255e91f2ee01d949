"""SentencePiece encoding and decoding as relations.

Texts are cut into segments that no piece crosses, and each distinct segment is encoded once: its
substrings of bounded length are exploded and joined with the piece table, the edges found are grouped by
segment, and a fold with ``aggregate`` picks the path. For unigram models the fold is Viterbi; a byte-pair
model defines its result by merges instead of by the best sum of scores, so there the fold takes the merge
of the best piece first, on the same edges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from rollbook.llm.common import give_back_memory, let, text_or_empty, written
from rollbook.llm.hashing import blocks, column_bytes

SPACE = "▁"
#: Cut before a run of spaces and around line ends; no piece has a space after another character.
SEGMENT = f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+"
#: Longest piece that edges are looked up for, and longest segment whose borders fit into a long.
MOST_PIECE = 16
MOST_FOLDED = 60
#: Encodings of the most frequent segments are broadcast, so many at most.
BROADCAST_SEGMENTS = 300_000
#: Rare segments whose encodings a task remembers.
CACHE = 50_000
#: Bytes of text that a task encodes at once.
SLICE_BYTES = 1 << 20
_TOP_COUNT = 4096
Batches = Iterator[pa.RecordBatch]
LOW = -1e9


def piece_table(spark: SparkSession, model_file: str) -> tuple[DataFrame, dict]:
    """``piece, id, score, rank`` of the ordinary pieces, ``rank`` from 0 by falling score; and what else
    the model says: ``byte_base`` (id of byte 0), ``unknown``, ``kind`` (``bpe`` or ``unigram``)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    ids = range(model.get_piece_size())
    rows = [
        (model.id_to_piece(i), i, model.get_score(i))
        for i in ids
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]
    ranks = {s: n for n, s in enumerate(sorted({r[2] for r in rows}, reverse=True))}
    base = next((i for i in ids if model.is_byte(i)), None)
    # A byte-pair model has whole ranks for scores, a unigram model logarithms.
    kind = "bpe" if all(float(r[2]).is_integer() for r in rows) else "unigram"
    longest = max(len(r[0]) for r in rows)
    if longest > MOST_PIECE:
        raise ValueError(f"pieces of up to {longest} characters; edges are looked up for {MOST_PIECE}")
    if any(SPACE in r[0].lstrip(SPACE) or "\n" in r[0] for r in rows):
        raise ValueError("a piece crosses the borders of segments")
    table = spark.createDataFrame([(p, i, float(s), ranks[s]) for p, i, s in rows], "piece string, id int, score double, rank int")
    return table, {"byte_base": base, "unknown": model.unk_id(), "kind": kind}


def segments(text: Column) -> Column:
    """Segments of a text, spaces as their mark, one put before it; none for null and empty text."""
    shown = F.concat(F.lit(SPACE), F.replace(text_or_empty(text), F.lit(" "), F.lit(SPACE)))
    return F.when(F.coalesce(F.length(text), F.lit(0)) == 0, F.array().cast("array<string>")).otherwise(
        F.regexp_extract_all(shown, F.lit(SEGMENT), F.lit(0))
    )


def _bit(n: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), n)


def _lattice(words: DataFrame, pieces: DataFrame) -> DataFrame:
    """``segment, n_chars, edges``: edges (rank, at, ends, inner, id, score, size) in order of rank and place.
    ``ends`` and ``inner`` have a bit for each border at and inside an edge."""
    n = F.char_length("segment")
    starts = F.sequence(F.lit(0), n - 1)
    cut = lambda s, k: F.struct(s.alias("at"), k.alias("size"), F.substring("segment", s + 1, k).alias("part"))
    parts = F.flatten(
        F.transform(starts, lambda s: F.transform(F.sequence(F.lit(1), F.least(F.lit(MOST_PIECE), n - s)), lambda k: cut(s, k)))
    )
    exploded = words.select("segment", n.alias("n_chars"), F.explode(parts).alias("e")).select("segment", "n_chars", "e.*")
    # The piece table is the model's vocabulary: tens of thousands of rows.
    edges = exploded.join(F.broadcast(pieces), F.col("part") == F.col("piece"), "left")
    # What is no piece goes, but for a row that stands for the segment.
    edges = edges.filter(F.col("id").isNotNull() | (F.col("at") + F.col("size") == 1))
    inner = (_bit(F.col("at") + F.col("size")) - _bit(F.col("at"))).bitwiseAND(F.bitwise_not(_bit(F.col("at"))))
    edge = F.struct("rank", "at", (_bit(F.col("at")) + _bit(F.col("at") + F.col("size"))).alias("ends"), inner.alias("inner"), "id", "score", "size")
    found = F.collect_list(F.when(F.col("id").isNotNull(), edge))
    return edges.groupBy("segment", "n_chars").agg(F.sort_array(found).alias("edges"))


def _merged(edges: Column, n: Column) -> Column:
    """Borders left after all merges: each step takes the first edge in order that joins two neighbours."""
    every = _bit(n + 1) - 1

    def step(state: Column, _: Column) -> Column:
        fits = F.filter(
            edges,
            lambda e: (state["b"].bitwiseAND(e["ends"]) == e["ends"]) & (F.bit_count(state["b"].bitwiseAND(e["inner"])) == 1),
        )
        taken = let(
            F.get(fits, F.lit(0)),
            lambda e: F.struct(
                F.when(e.isNull(), state["b"]).otherwise(state["b"].bitwiseAND(F.bitwise_not(e["inner"]))).alias("b"),
                e.isNull().alias("done"),
            ),
        )
        return F.when(state["done"], state).otherwise(taken)

    start = F.struct(every.alias("b"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)["b"]


def _best_path(edges: Column, n: Column) -> Column:
    """Borders of the path with the greatest sum of scores (Viterbi); a character without piece costs more
    than any piece. The state has score and borders of the best path to each place so far."""
    worst = F.lit(LOW / 1e6)

    def step(paths: Column, end: Column) -> Column:
        here = F.filter(edges, lambda e: e["at"] + e["size"] == end)
        grow = lambda p, s: F.struct((p["score"] + s).alias("score"), (p["b"] + _bit(end)).alias("b"))
        options = F.transform(here, lambda e: grow(F.get(paths, e["at"]), e["score"]))
        return F.concat(paths, F.array(F.array_max(F.concat(options, F.array(grow(F.get(paths, end - 1), worst))))))

    start = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(1).cast("long").alias("b")))
    return F.element_at(F.aggregate(F.sequence(F.lit(1), n), start, step), -1)["b"]


def _ids(edges: Column, n: Column, borders: Column, model: dict) -> Column:
    """Ids of the pieces between borders; characters without piece as bytes, or unknown."""
    chosen = F.filter(edges, lambda e: (borders.bitwiseAND(e["ends"]) == e["ends"]) & (borders.bitwiseAND(e["inner"]) == 0))
    known = F.transform(chosen, lambda e: F.struct(e["at"].alias("at"), F.array(e["id"]).alias("ids")))

    def of_char(i: Column) -> Column:
        if model["byte_base"] is None:
            return F.array(F.lit(model["unknown"]))
        code = F.hex(F.encode(F.substring("segment", i + 1, F.lit(1)), "utf-8"))
        places = F.sequence(F.lit(1), F.length(code) - 1, F.lit(2))
        return F.transform(places, lambda j: F.conv(F.substring(code, j, F.lit(2)), 16, 10).cast("int") + model["byte_base"])

    def with_bytes(spans: Column) -> Column:
        missing = F.filter(
            F.sequence(F.lit(0), n - 1),
            lambda i: (F.bit_count(borders.bitwiseAND(_bit(i) + _bit(i + 1))) == 2) & ~F.exists(spans, lambda s: s["at"] == i),
        )
        return F.concat(spans, F.transform(missing, lambda i: F.struct(i.alias("at"), of_char(i).alias("ids"))))

    whole = F.size(known) == F.bit_count(borders) - 1
    return F.flatten(
        F.transform(F.sort_array(F.when(whole, known).otherwise(let(known, with_bytes))), lambda s: s["ids"])
    )


def merge_long(text: str, ranks: dict, ids: dict, model: dict) -> list[int]:
    """Byte-pair merges of a long segment with a heap: best rank first, then leftmost."""
    import heapq

    n = len(text)
    after, before, parts = [*range(1, n), -1], list(range(-1, n - 1)), list(text)
    heap: list = []

    def offer(i: int) -> None:
        j = after[i]
        if j != -1 and (r := ranks.get(parts[i] + parts[j])) is not None:
            heapq.heappush(heap, (r, i, j, parts[i] + parts[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, j, both = heapq.heappop(heap)
        if parts[i] is None or after[i] != j or parts[i] + (parts[j] or "") != both:
            continue
        parts[i], parts[j] = both, None
        after[i] = after[j]
        if after[j] != -1:
            before[after[j]] = i
        offer(i)
        if before[i] != -1:
            offer(before[i])
    out: list[int] = []
    for p in parts:
        if p is not None:
            out += [ids[p]] if p in ids else [b + model["byte_base"] for b in p.encode()] if model["byte_base"] is not None else [model["unknown"]]
    return out


def encode_segments(words: DataFrame, pieces: DataFrame, model: dict) -> DataFrame:
    """``segment, ids`` of distinct segments (a column ``segment``).

    Segments of more than MOST_FOLDED characters have more borders than a long has bits; byte-pair models
    merge them with a heap in Python, for unigram models they are cut after so many characters."""
    short = F.char_length("segment") <= MOST_FOLDED
    fold = _merged if model["kind"] == "bpe" else _best_path
    n = F.col("n_chars")
    folded = _lattice(words.filter(short), pieces).select(
        "segment", let(F.col("edges"), lambda e: let(fold(e, n), lambda b: _ids(e, n, b, model))).alias("ids")
    )
    if model["kind"] != "bpe":
        chunks = words.filter(~short).select(
            F.col("segment").alias("whole"),
            F.posexplode(F.regexp_extract_all("segment", F.lit(f"(?s).{{1,{MOST_FOLDED}}}"), F.lit(0))).alias("place", "segment"),
        )
        parts = _lattice(chunks.select("segment").distinct(), pieces).select(
            "segment", let(F.col("edges"), lambda e: let(fold(e, n), lambda b: _ids(e, n, b, model))).alias("ids")
        )
        joined = chunks.join(parts, "segment").groupBy("whole").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("p"))
        return folded.unionByName(joined.select(F.col("whole").alias("segment"), F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids")))
    return folded.unionByName(merge_segments(words.filter(~short).select("segment"), pieces, model))


def merge_segments(rows: DataFrame, pieces: DataFrame, model: dict) -> DataFrame:
    """``rows`` (last column ``segment``) with ``ids``, each merged in the task that holds it."""
    vocabulary = pieces.select("piece", "id", "rank").collect()  # tens of thousands of rows
    tables = {r["piece"]: r["rank"] for r in vocabulary}, {r["piece"]: r["id"] for r in vocabulary}
    shared = rows.sparkSession.sparkContext.broadcast((*tables, model))

    def merge(batches):
        ranks, ids, about = shared.value
        known: dict[str, list[int]] = {}
        for batch in batches:
            out = []
            for s in batch.column(batch.num_columns - 1).to_pylist():
                if s not in known:
                    if len(known) >= CACHE:
                        known.clear()
                    known[s] = merge_long(s, ranks, ids, about)
                out.append(known[s])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], [*batch.schema.names, "ids"])

    return rows.mapInArrow(merge, StructType([*rows.schema.fields, StructField("ids", ArrayType(IntegerType()))]))


def with_decoded(coded: DataFrame, pieces: DataFrame, model: dict, name: str, strip: bool = True) -> DataFrame:
    """``coded`` with the text of its ``ids`` in a new column ``name``: the bytes of their pieces in order.

    The space put before a text is taken off (``strip``). Ids that the model has not give nothing; the mark of
    a space in the source text comes back as a space. The vocabulary is broadcast."""
    given = StructType([*coded.schema.fields, StructField(name, StringType())])
    return coded.mapInArrow(_decoder(pieces, model, coded.columns.index("ids"), name, strip), given)


def _decoder(pieces: DataFrame, model: dict, place: int, name: str, strip: bool = True) -> Callable[[Batches], Batches]:
    """What ``with_decoded`` does to batches whose column number ``place`` has the ids."""
    table = {r["id"]: r["piece"].replace(SPACE, " ").encode() for r in pieces.select("id", "piece").collect()}
    if model["byte_base"] is not None:
        table |= {model["byte_base"] + b: bytes([b]) for b in range(256)}
    # By id; the last one stands for ids that the model has not.
    n = max(table, default=-1) + 1
    shared = pieces.sparkSession.sparkContext.broadcast([table.get(i, b"") for i in range(n)] + [b""])

    def put(batches):
        pieces_by_id = pa.array(shared.value, pa.binary())
        for whole in batches:
            lists = whole.column(place)
            size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            for lo, hi in blocks(np.concatenate([[0], np.cumsum(size, dtype=np.int64)]) * 4):
                batch = whole.slice(lo, hi - lo)
                part = batch.column(place)
                ids = part.flatten().fill_null(n).to_numpy(zero_copy_only=False)  # null lists have no ids
                ends = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
                found = pieces_by_id.take(pa.array(np.where((ids >= 0) & (ids < n), ids, n)))
                cuts = np.frombuffer(found.buffers()[1], np.int32)[: len(found) + 1]
                raw = found.buffers()[2].to_pybytes() if len(found) and cuts[-1] else b""
                at = np.concatenate([[0], cuts[ends] if len(found) else np.zeros(len(ends), np.int64)]).tolist()
                texts = [raw[a + 1 : b] if strip and raw[a : min(a + 1, b)] == b" " else raw[a:b] for a, b in zip(at, at[1:], strict=False)]
                texts = pa.array([t.decode(errors="replace") for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    return put


def decode(coded: DataFrame, pieces: DataFrame, model: dict, key: str, strip: bool = True) -> DataFrame:
    """``key, text`` of rows with ``key`` and ``ids``; see ``with_decoded``."""
    return with_decoded(coded.select(key, "ids"), pieces, model, "text", strip)


def _cut(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The segments of a block of texts, spaces as such, in a row; and where those of each text end. A space is
    put before every text that has a character. New segments begin at a run of spaces, at a run of line ends
    and after one (SEGMENT)."""
    if pc.any(pc.match_substring(texts, SPACE)).as_py():
        texts = pc.replace_substring(texts, SPACE, " ")
    data, offsets = column_bytes(texts)
    filled = np.diff(offsets) > 0
    shift = np.cumsum(filled)
    starts = offsets[:-1] + shift - filled  # where texts begin, with the spaces before them
    given = np.ones(len(data) + int(shift[-1]) if len(shift) else 0, bool)
    given[starts[filled]] = False
    out = np.full(len(given), 32, np.uint8)
    out[given] = data
    blank, line = out == 32, out == 10
    new = ~given
    new[1:] |= (blank[1:] & ~blank[:-1]) | (line[1:] & ~line[:-1]) | (line[:-1] & ~blank[1:] & ~line[1:])
    begins = np.flatnonzero(new)
    cuts = np.append(begins, len(out)).astype(np.int32)
    column = pa.StringArray.from_buffers(len(begins), pa.py_buffer(cuts), pa.py_buffer(out))
    return column.dictionary_encode(), np.searchsorted(begins, np.append(starts[1:], len(out)))


def _floor_of_frequent(words: DataFrame) -> int:
    """The least ``n`` that at most BROADCAST_SEGMENTS rows of ``words`` reach."""
    # Frequencies beyond _TOP_COUNT by powers of two: a few thousand rows at most.
    level = F.when(F.col("n") < _TOP_COUNT, F.col("n")).otherwise(_bit(F.floor(F.log2("n")).cast("int")))
    counts = words.groupBy(level.alias("n")).agg(F.count(F.lit(1)).alias("m")).collect()
    floor, total = 1 << 62, 0
    for r in sorted(counts, key=lambda r: -r["n"]):
        total += r["m"]
        if total > BROADCAST_SEGMENTS:
            break
        floor = r["n"]
    return floor


def encode(docs: DataFrame, pieces: DataFrame, model: dict, text_column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int): every text encoded. Repeated rows have equal ids; null and
    empty texts have none. A column ``ids`` is replaced.

    For byte-pair models the most frequent segments go through the lattice once and are broadcast; each task
    puts the ids of its texts together from them and merges the other segments itself, so no occurrence of a
    segment is shuffled. Unigram models send all distinct segments through the lattice and join them back.
    """
    kept = [c for c in docs.columns if c.lower() != "ids" or c == text_column]
    if model["kind"] != "bpe":
        return _encode_joined(docs, pieces, model, text_column, kept)
    given = docs.select(*kept)
    schema = StructType([*given.schema.fields, StructField("ids", ArrayType(IntegerType()))])
    return given.mapInArrow(_encoder(docs, pieces, model, text_column, kept.index(text_column)), schema)


def _encoder(docs: DataFrame, pieces: DataFrame, model: dict, text_column: str, place: int) -> Callable[[Batches], Batches]:
    """What ``encode`` does to batches of ``docs`` whose column number ``place`` has the texts, by a byte-pair model."""
    words = docs.select(F.explode(segments(F.col(text_column))).alias("segment")).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))
    words = written(words, "pieces-segments", compression="zstd")
    often = encode_segments(words.filter(F.col("n") >= _floor_of_frequent(words)).select("segment"), pieces, model)
    found = often.toArrow()  # BROADCAST_SEGMENTS rows at most
    vocabulary = pieces.select("piece", "id", "rank").collect()
    tables = {r["piece"]: r["rank"] for r in vocabulary}, {r["piece"]: r["id"] for r in vocabulary}
    shared = docs.sparkSession.sparkContext.broadcast((found, *tables, model))

    def put(batches):
        coded, ranks, ids, about = shared.value
        lists = coded.column("ids").combine_chunks()
        usual = pc.replace_substring(coded.column("segment").combine_chunks(), SPACE, " ")
        flat, cuts = lists.values.to_numpy(), lists.offsets.to_numpy().astype(np.int64)
        rare: dict[str, list[int]] = {}

        def merged(s: str) -> list[int]:
            of = rare.get(s)
            if of is None:
                if len(rare) >= CACHE:
                    rare.clear()
                of = rare[s] = merge_long(s.replace(" ", SPACE), ranks, ids, about)
            return of

        for whole in batches:
            texts = whole.column(place)
            _, offsets = column_bytes(texts)
            for lo, hi in blocks(offsets, SLICE_BYTES):
                segment, ends = _cut(texts.slice(lo, hi - lo))
                # A segment is looked up once a block, its ids are dealt to all its places.
                names = segment.dictionary
                number = pc.index_in(names, value_set=usual).fill_null(-1).to_numpy().astype(np.int64)
                others = [merged(s) for s in names.filter(pa.array(number < 0)).to_pylist()]
                size = np.zeros(len(number), np.int64)
                size[number < 0] = [len(o) for o in others]
                size[number >= 0] = np.diff(cuts)[number[number >= 0]]
                begin = np.zeros(len(number), np.int64)
                begin[number >= 0] = cuts[number[number >= 0]]
                begin[number < 0] = len(flat) + np.cumsum(size[number < 0]) - size[number < 0]
                every = np.concatenate([flat, np.fromiter(chain.from_iterable(others), np.int32)])
                at = segment.indices.to_numpy()
                n, start = size[at], begin[at]
                upto = np.cumsum(n)
                values = every[np.repeat(start - (upto - n), n) + np.arange(int(upto[-1]) if len(upto) else 0)]
                stops = np.concatenate([[0], upto])[np.concatenate([[0], ends])]
                batch = whole.slice(lo, hi - lo)
                coded_texts = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), pa.array(values, pa.int32()))
                yield pa.RecordBatch.from_arrays([*batch.columns, coded_texts], [*batch.schema.names, "ids"])
        give_back_memory()

    return put


def encoded_and_checked(docs: DataFrame, pieces: DataFrame, model: dict) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, n_tokens, ids, exact``; ``exact`` tells whether the
    ids decode to the text itself (null as empty). A text with the mark of a space in it does not."""
    given = docs.select("doc_id", "text")
    if model["kind"] == "bpe":
        # Coded and decoded by one worker: two of them would each hold tables and batches.
        code, told = _encoder(given, pieces, model, "text", 1), _decoder(pieces, model, 2, "decoded")
        schema = StructType([*given.schema.fields, StructField("ids", ArrayType(IntegerType())), StructField("decoded", StringType())])
        decoded = given.mapInArrow(lambda batches: told(code(batches)), schema)
    else:
        decoded = with_decoded(encode(given, pieces, model), pieces, model, "decoded")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("decoded") == text_or_empty(F.col("text"))).alias("exact")
    )


def _encode_joined(docs: DataFrame, pieces: DataFrame, model: dict, text_column: str, kept: list[str]) -> DataFrame:
    texts = docs.select(F.col(text_column).alias("text")).distinct().withColumn("th", F.sha2("text", 256))
    placed = texts.select("th", F.posexplode_outer(segments(F.col("text"))).alias("place", "segment"))
    coded = encode_segments(placed.select("segment").filter("segment IS NOT NULL").distinct(), pieces, model)
    whole = (
        placed.join(coded, "segment", "left")
        .groupBy("th")
        .agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("p"))
        .select("th", F.flatten(F.filter(F.transform("p", lambda x: x["ids"]), lambda i: i.isNotNull())).alias("ids"))
    )
    named = docs.select(*kept, F.sha2(text_column, 256).alias("ids_th"))
    return named.join(whole.withColumnRenamed("th", "ids_of"), F.col("ids_th") == F.col("ids_of"), "left").select(
        *kept, F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    )
