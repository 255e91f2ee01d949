"""Prefix tries against a plain one."""

import hashlib
import random
import zlib

import pytest

from rollbook.llm import turn_trie
from rollbook.llm.queries import QUERIES


def plain_trie(convs):
    """Nodes of ``{conv_id: [(role, text), ...]}`` as rows of the operator."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, ids in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[: len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in sorted(c for c in ids if len(convs[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(ids), len(path), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def ordered(rows):
    convs = {}
    code = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, code(role or "", text or ""), role or "", text or ""))
    return {c: [x[3:] for x in sorted(t)] for c, t in convs.items()}


def made(seed, n=60):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, 9)):
            rows.append((c, turn if rng.random() < 0.95 else None, rng.choice(["user", "user", None, "a"]), rng.choice(["x", "y", "ü", "", None])))
    rows += [(c, t, "user", f"same {t}") for c in range(n, n + 40) for t in range(4)]
    rows += [(7, 0, "user", "x")] * 3 + [(None, 0, "user", "lost"), (-3, 1, "a", "neg"), (-3, 0, "a", "neg")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("shard_turns", [3, 40, 10_000])
def test_trie_against_plain(spark, shard_turns):
    rows = made(shard_turns)
    convs = turn_trie.conversations(turn_trie.coded_turns(spark.createDataFrame(rows, SCHEMA)))
    got = turn_trie.trie_nodes(convs, shard_turns)
    assert got.columns == turn_trie._NODE_COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(ordered(rows))


def test_query_against_plain(spark, tmp_path):
    rows = made(1)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    own = ordered(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    got = QUERIES["op13_prefix_trie"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_trie(rebuilt)


def test_empty_extra_and_deep(spark):
    none = spark.createDataFrame([], f"{SCHEMA}, code string, path int")
    assert turn_trie.prefix_trie(none).count() == 0
    deep = spark.createDataFrame([(c, t, "u", "z" * (t % 3)) for c in (1, 2) for t in range(700 + c)], SCHEMA).selectExpr("*", "1 AS code", "2 AS size")
    got = turn_trie.prefix_trie(deep).collect()
    assert len(got) == 703 and max(r["depth"] for r in got) == 702
    assert {r["n_convs"] for r in got if r["depth"] <= 701} == {2}


def test_sequences_keep_order_in_the_tree():
    rng = random.Random(3)
    seqs = sorted({tuple(rng.randint(0, 4) for _ in range(rng.randint(0, 6))) for _ in range(300)})
    tree = turn_trie.TernaryTree()
    ways = {seqs[m]: tree.insert(list(seqs[m])) for m in turn_trie._median_first(len(seqs))}
    assert len(ways) == len(seqs)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert len(tree.nodes_and_parents()) == len(prefixes) == len(tree.number)
    assert all(len(set(w)) == len(s) + 1 for s, w in ways.items())
