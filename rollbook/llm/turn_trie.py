"""Prefix trie of conversations: ternary search trees per range shard, joined at their borders.

A turn is coded by the md5 of role and text, a conversation by the codes of its turns in a row. Equal
conversations are counted first, so a shard holds distinct ones: a range of them in order. In a shard turns
are numbered, and the conversations are inserted into a ternary search tree, the median first, so that it
stays flat. What lies under nodes that only one shard has is final there. The nodes on the way to a shard's
first and last conversation may go on in its neighbours: they are merged from shard to shard, two short paths
from each.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.llm.common import let, text_or_empty, written

#: Bytes of a coded turn.
CODE = 16
#: Equal conversations whose ids lie in one range of so many (a power of two) travel as one row.
ID_BITS = 9
#: Turns of distinct conversations to a shard.
SHARD_TURNS = 200_000

_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE_COLUMNS = [c.split(" ")[0] for c in _NODE.split(", ")]
_SUMS = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
_NONE = hashlib.sha256(b"").hexdigest()


def coded_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, code, size`` of rows with ``conv_id, turn, role, text``: null role or text is empty,
    ``size`` is the UTF-8 bytes of the text. Rows without a conv_id belong to no conversation and go."""
    role, text = text_or_empty(F.col("role")), text_or_empty(F.col("text"))
    code = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    return rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), code.alias("code"),
        F.octet_length(text).cast("long").alias("size"),
    )


def _sequence(turns: Column) -> list[Column]:
    return [
        F.unhex(F.array_join(F.transform(turns, lambda t: t["code"]), "")).alias("path"),
        F.transform(turns, lambda t: t["size"]).alias("sizes"),
    ]


def conversations(coded: DataFrame) -> DataFrame:
    """``conv_id, path, sizes``: the coded turns of every conversation in order of ``turn``, null first, then
    code (equal rows stay, as turns of their own). A conversation's codes are one row."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "code", "size")))
    return coded.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", *_sequence(F.col("turns")))


def with_openings(coded: DataFrame, five: int = 5, most: int = 9) -> DataFrame:
    """``conv_id, path, sizes`` as of ``conversations``, where each conversation c begins with the first turns of
    c - c % five, crc32(c) % most of them, instead of as many of its own; a conversation may lose all turns."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(five))
    rows = F.sort_array(F.collect_list(F.struct("conv_id", "turn", "code", "size")))
    near = coded.groupBy(base.alias("base")).agg(rows.alias("rows"))
    ids = F.array_distinct(F.transform("rows", lambda r: r["conv_id"]))
    each = near.select("base", "rows", F.explode(ids).alias("conv_id"))
    of = lambda c: F.filter("rows", lambda r: r["conv_id"] == c)
    n = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    own = let(of(F.col("conv_id")), lambda t: F.slice(t, n + 1, F.greatest(F.size(t), F.lit(1))))
    turns = F.concat(F.slice(of(F.col("base")), F.lit(1), n), own)
    return each.select("conv_id", turns.alias("turns")).select("conv_id", *_sequence(F.col("turns")))


def _distinct(convs: DataFrame) -> DataFrame:
    """``path, sizes, n, least, ends``: distinct conversations, how many, their least id and the digest of all
    their ids. Ids of a frequent one come in ranges, each a row, and are read as a stream in order."""
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    ranged = convs.groupBy("path", F.shiftright("conv_id", ID_BITS).alias("range")).agg(
        F.first("sizes").alias("sizes"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), ids.alias("ids")
    )
    columns = ["path", "sizes", "n", "least", "ids"]

    def streamed(batches):
        path, sizes, n, least, digest = None, None, 0, 0, None
        for batch in batches:
            out = []
            for p, s, k, lowest, text in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                if p != path:
                    if digest is not None:
                        out.append((path, sizes, n, least, digest.hexdigest()))
                    path, sizes, n, least, digest = p, s, k, lowest, hashlib.sha256(text.encode())
                else:
                    n += k
                    digest.update(b"," + text.encode())
            yield _rows(out)
        if digest is not None:
            yield _rows([(path, sizes, n, least, digest.hexdigest())])

    def _rows(rows):
        kinds = [pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["path", "sizes", "n", "least", "ends"])

    ordered = ranged.repartition("path").sortWithinPartitions("path", "range").select(*columns)
    return ordered.mapInArrow(streamed, "path binary, sizes array<long>, n long, least long, ends string")


def _codes(path: bytes) -> list[bytes]:
    return [path[i : i + CODE] for i in range(0, len(path), CODE)]


def _shared(a: list, b: list) -> int:
    """Length of the common prefix."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


class TernaryTree:
    """Ternary search tree over sequences of numbers. Node 0 is the empty sequence; every other node stands for
    the sequence of the numbers at which the way to it went on (``inner``), ``lower`` and ``higher`` are siblings."""

    def __init__(self):
        self.number, self.lower, self.higher, self.inner = [-1], [-1], [-1], [-1]

    def insert(self, sequence: list[int]) -> list[int]:
        """The nodes on the way, the one of the empty sequence first."""
        number, lower, higher, inner = self.number, self.lower, self.higher, self.inner
        way = [0]
        for t in sequence:
            at, links = way[-1], inner
            while links[at] != -1 and number[links[at]] != t:
                at = links[at]
                links = lower if t < number[at] else higher
            if links[at] == -1:
                links[at] = len(number)
                number.append(t)
                for of in (lower, higher, inner):
                    of.append(-1)
            way.append(links[at])
        return way

    def nodes_and_parents(self) -> list[tuple[int, int]]:
        """Every node after its parent (-1 for the empty sequence's)."""
        out, open_ = [], [(0, -1)]
        while open_:
            node, parent = open_.pop()
            out.append((node, parent))
            if node and self.lower[node] != -1:
                open_.append((self.lower[node], parent))
            if node and self.higher[node] != -1:
                open_.append((self.higher[node], parent))
            if self.inner[node] != -1:
                open_.append((self.inner[node], node))
        return out


def _median_first(n: int):
    spans = [(0, n)]
    while spans:
        a, b = spans.pop()
        if a < b:
            m = (a + b) // 2
            yield m
            spans += [(m + 1, b), (a, m)]


def shard_nodes(shard: int, rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Of distinct conversations (path, sizes, n, least, ends) in order: the nodes that no other shard has, and
    the paths to the first and to the last one. A node: shard, side, then its columns; its parent's id is null
    where the parent lies on the path ``side``. A path: shard, side, path, sizes, ends, and for each depth the
    least id and the sums of what lies under no deeper node of a path."""
    paths = [_codes(r[0]) for r in rows]
    number = {code: i for i, code in enumerate(sorted({c for p in paths for c in p}))}
    tree, first, last = TernaryTree(), [], []
    n, least, ends, size = [], [], [], []
    for m in _median_first(len(rows)):
        way = tree.insert([number[c] for c in paths[m]])
        for v in way[len(way) - (len(tree.number) - len(n)) :]:
            n.append(0)
            least.append(rows[m][3])
            ends.append(_NONE)
            size.append(0)
        for v, s in zip(way[1:], rows[m][1], strict=True):
            size[v] = s
        n[way[-1]], ends[way[-1]] = rows[m][2], rows[m][4]
        least[way[-1]] = min(least[way[-1]], rows[m][3])
        first, last = (way if m == 0 else first), (way if m == len(rows) - 1 else last)
    order = tree.nodes_and_parents()
    children, leaves, saved = [0] * len(n), [0] * len(n), [0] * len(n)
    side_of = {v: 1 for v in last} | {v: 0 for v in first}
    depth = [0] * len(n)
    for v, p in order:
        depth[v] = depth[p] + 1 if p >= 0 else 0
    for v, p in reversed(order):
        if v in side_of:
            continue
        if not children[v]:
            leaves[v] = 1
        saved[v] += (n[v] - 1) * size[v]
        n[p] += n[v]
        least[p] = min(least[p], least[v])
        children[p] += 1
        leaves[p] += leaves[v]
        saved[p] += saved[v]
    inside = [
        (shard, side_of.get(p), least[v], depth[v], None if p in side_of else least[p], n[v], children[v], leaves[v], saved[v], ends[v])
        for v, p in order if v not in side_of
    ]
    border = []
    for side, way, row in ((0, first, 0), (1, last, len(rows) - 1)):
        if side and last == first:
            break
        mine = [side_of[v] == side for v in way]
        sums = [[x[v] if own else 0 for v, own in zip(way, mine, strict=True)] for x in (n, children, leaves, saved)]
        lowest = [least[v] if own else None for v, own in zip(way, mine, strict=True)]
        told = [ends[v] if own else _NONE for v, own in zip(way, mine, strict=True)]
        border.append((shard, side, rows[row][0], list(rows[row][1]), told, lowest, *sums))
    return inside, border


def merged_paths(paths):
    """Rows of nodes (columns of ``_NODE``) and of places (shard, side, depth, conv_id) from the paths of all
    shards in order; only the nodes on the way to the present path are held."""
    open_: list[dict] = []
    codes: list[bytes] = []

    def closed():
        node = open_.pop()
        depth = len(open_)
        if not node["n_children"]:
            node["n_leaves"] = 1
        node["saved_tokens"] += (node["n_convs"] - 1) * node["size"]
        for row in node["waiting"]:
            yield "node", (row[0], row[1], node["least"], *row[2:])
        for shard, side in node["places"]:
            yield "place", (shard, side, depth, node["least"])
        row = (node["least"], depth, *[node[c] for c in _SUMS], node["ends"])
        if not open_:
            yield "node", (row[0], row[1], None, *row[2:])
            return
        above = open_[-1]
        above["waiting"].append(row)
        above["n_children"] += 1
        above["least"] = min(above["least"], node["least"])
        for c in ("n_convs", "n_leaves", "saved_tokens"):
            above[c] += node[c]

    for shard, side, path, sizes, ends, least, *sums in paths:
        now = _codes(path)
        keep = _shared(codes, now) + 1 if open_ else 0
        while len(open_) > keep:
            yield from closed()
        for depth in range(len(now) + 1):
            if depth == len(open_):
                size = sizes[depth - 1] if depth else 0
                open_.append(dict.fromkeys(_SUMS, 0) | {"size": size, "least": 1 << 63, "ends": _NONE, "waiting": [], "places": []})
            node = open_[depth]
            for c, values in zip(_SUMS, sums, strict=True):
                node[c] += values[depth]
            if least[depth] is not None:
                node["least"] = min(node["least"], least[depth])
                node["places"].append((shard, side))
            if ends[depth] != _NONE:
                node["ends"] = ends[depth]
        codes = now
    while open_:
        yield from closed()


_SHARD = (
    f"shard int, side int, {_NODE}, path binary, sizes array<long>, ends array<string>, least array<long>, "
    + ", ".join(f"{c}_at array<long>" for c in _SUMS)
)
_SHARD_COLUMNS = [c.split(" ")[0] for c in _SHARD.split(", ")]
_AT = [f"{c}_at" for c in _SUMS]


def _table(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def trie_nodes(convs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """A row per distinct prefix of the conversations (``conv_id, path, sizes``, ids unique): its least member's
    ``conv_id``, ``depth``, the parent's ``parent_conv_id``, ``n_convs`` members, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes that members after the first repeat, summed over the subtree) and ``ends_sha256`` of
    the ids that end there. A conversation without turns is a member of the root only; no rows give no nodes.
    """
    distinct = written(_distinct(convs), "trie-distinct")
    n_turns = distinct.agg(F.sum(F.size("sizes")).alias("n")).first()["n"] or 0
    ranged = distinct.repartitionByRange(1 + n_turns // shard_turns, "path").sortWithinPartitions("path")
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    node_kinds = [pa.int64()] * 7 + [pa.string()]
    kinds = [pa.int32(), pa.int32(), *node_kinds, pa.binary(), longs, texts, *[longs] * 5]

    def in_shard(batches):
        rows = [
            r for b in batches for r in zip(*[b.column(c).to_pylist() for c in ("path", "sizes", "n", "least", "ends")], strict=True)
        ]
        if rows:
            inside, border = shard_nodes(TaskContext.get().partitionId(), rows)
            for lo in range(0, len(inside), 10_000):
                part = inside[lo : lo + 10_000]
                yield _table([(*r, *[None] * 8) for r in part], kinds, _SHARD_COLUMNS)
            yield _table([(*r[:2], *[None] * 8, *r[2:]) for r in border], kinds, _SHARD_COLUMNS)

    parts = written(ranged.mapInArrow(in_shard, _SHARD), "trie-shards")

    def merge(batches):
        columns = ["shard", "side", "path", "sizes", "ends", "least", *_AT]
        rows = (r for b in batches for r in zip(*[b.column(c).to_pylist() for c in columns], strict=True))
        out = []
        kinds = [pa.int32(), pa.int32(), *node_kinds]
        for kind, row in merged_paths(rows):
            if kind == "node":
                out.append((None, None, *row))
            else:
                out.append((*row[:2], row[3], row[2], *[None] * 6))
            if len(out) >= 10_000:
                yield _table(out, kinds, ["shard", "side", *_NODE_COLUMNS])
                out = []
        yield _table(out, kinds, ["shard", "side", *_NODE_COLUMNS])

    # Two rows a shard, as wide as a conversation has turns.
    paths = parts.filter("path IS NOT NULL").select("shard", "side", "path", "sizes", "ends", "least", *_AT)
    border = written(
        paths.repartition(1).sortWithinPartitions("shard", "side").mapInArrow(merge, f"shard int, side int, {_NODE}"), "trie-border"
    )
    inside = parts.filter("path IS NULL").select("shard", "side", *_NODE_COLUMNS)
    known = inside.filter("side IS NULL").select(*_NODE_COLUMNS)
    places = border.filter("shard IS NOT NULL").select(
        F.col("shard").alias("at_shard"), F.col("side").alias("at_side"), F.col("depth").alias("at_depth"), F.col("conv_id").alias("above")
    )
    below = inside.filter("side IS NOT NULL").join(
        places, (F.col("shard") == F.col("at_shard")) & (F.col("side") == F.col("at_side")) & (F.col("depth") == F.col("at_depth") + 1)
    )
    below = below.withColumn("parent_conv_id", F.col("above")).select(*_NODE_COLUMNS)
    return border.filter("shard IS NULL").select(*_NODE_COLUMNS).unionByName(known).unionByName(below)


def prefix_trie(rows: DataFrame) -> DataFrame:
    """Nodes (see ``trie_nodes``) of the conversations in ``rows`` (``conv_id, turn, role, text``): null role
    and text are empty, turns go by ``turn``, null first, ties by their code; repeated rows are turns of their
    own, rows without a conv_id are left out, other columns don't matter. An empty table has no nodes."""
    return trie_nodes(conversations(coded_turns(rows)))
