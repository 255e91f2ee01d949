"""Periodic runs against plain definitions."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rollbook.llm import periodic
from rollbook.llm.queries import QUERIES


def plain_runs(w, least, periods):
    """Every stretch of each period that can't be extended, of the smallest period only."""
    out, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            start, length = i - q, j - i + q
            if length >= max(least, periods * q):
                out.setdefault((start, length), q)
            i = j + 1
    return sorted(((s, n_, q) for (s, n_), q in out.items()), key=lambda x: (x[0], x[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.sampled_from([(2, 2), (6, 4), (3, 3), (6, 2)]))
def test_runs_of_small_words(w, limits):
    assert periodic.word_runs(w, *limits) == plain_runs(w, *limits)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from("ab c"), min_size=1, max_size=4), st.integers(1, 9)), max_size=5))
def test_runs_of_repeated_blocks(parts):
    w = [x for block, n in parts for x in block * n]
    assert periodic.word_runs(w) == plain_runs(w, 6, 4)


@pytest.mark.parametrize("w", [["a"] * 3000, ["a", "b"] * 1000 + ["a"], (list("aab") * 50 + list("aabb") * 40) * 5])
def test_long_runs(w):
    assert periodic.word_runs(w) == plain_runs(w, 6, 4)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "cc", "d"]), max_size=60), min_size=1, max_size=4), st.sampled_from([(6, 4), (6, 2), (3, 3)]))
def test_stretches_hold_every_run(texts, limits):
    from rollbook.llm.hashing import word_hashes

    data = "\n".join(" ".join(t) for t in texts).encode()
    cuts = np.cumsum([0, *[len(" ".join(t)) + 1 for t in texts]])
    cuts[-1] -= 1
    h, _, _, at = word_hashes(np.frombuffer(data, np.uint8), cuts)
    row = np.repeat(np.arange(len(texts)), np.diff(at))
    stretches = periodic.repetitive(h, row, periodic._gram(*limits))
    for i, t in enumerate(texts):
        for s, n, _q in plain_runs(t, *limits):
            assert any(a <= at[i] + s and at[i] + s + n <= b for a, b in stretches)


def plain_row(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    found = plain_runs(w, 6, 4)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(found), *best, best[1] * 1000 // best[2] if found else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_query_against_plain_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    texts = [None, "", " \t\n", "a", "a " * 500, "x y " * 40 + "z", "ä b " * 9 + "\x0b", ("p q r s t u v\n" * 6), "a b a b a b"]
    texts += [" ".join(rng.choice(list("abc"), rng.integers(1, 90))) for _ in range(120)]
    data = [(i, t) for i, t in enumerate(texts)] + [(None, "k " * 8), (5, "x y " * 4), (5, "x y " * 4)]
    spark.createDataFrame(data, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((plain_row(*r) for r in data), key=str)


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 7, "r", None)], "doc_id int, text string, runs string, COLLAPSED string")
    row = periodic.find_runs(docs).first()
    assert [tuple(x) for x in row["runs"]] == [(0, 7, 1)] and row["collapsed"] == "a"
    assert periodic.find_runs(docs.limit(0)).count() == 0
    assert [tuple(x) for x in periodic.find_runs(docs, 2, 2, "text").first()["runs"]] == [(0, 7, 1)]
