"""Scores of the backoff automaton against plain counting."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rollbook.llm import ngram_lm
from rollbook.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for b in BLANKS:
        low = low.replace(b, " ")
    return [w for w in low.split(" ") if w] + [("end",)]


def plain_scores(rows, order=ngram_lm.ORDER, mass=ngram_lm.MASS):
    """Rows (doc_id, text, trained), one by one."""
    counts = Counter()
    for _, text, trained in rows:
        if trained:
            t = [("begin",), *tokens(text)]
            for k in range(1, order + 1):
                counts.update(tuple(t[i : i + k]) for i in range(len(t) - k + 1))
    words = {g[0]: n for g, n in counts.items() if len(g) == 1 and g[0] != ("begin",)}
    n, v = sum(words.values()), len(words)

    def share(gram):
        if len(gram) == 1:
            return (words.get(gram[0], 0) + 0.1) / (n + 0.1 * (v + 1))
        return (counts[gram] + mass * share(gram[1:])) / (counts[gram[:-1]] + mass)

    out = []
    for doc_id, text, trained in rows:
        t = [("begin",), *tokens(text)]
        base = sum(math.log10(share((w,))) for w in t[1:])
        score = sum(math.log10(share(tuple(t[max(0, i + 1 - order) : i + 1]))) for i in range(1, len(t)))
        out.append((doc_id, trained, len(t) - 1, sum(w in words for w in t[1:]), n, base, score))
    return out


def made(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["A", "a", "b", "cc", "é", "D"]) for _ in range(rng.randint(0, 30))) for _ in range(80)]
    return [(i, t, i % 4 != 1) for i, t in enumerate([None, "", " \t\n", "zz zz", "end begin", *texts])] + [(3, "a b", True), (None, "a b", False)] * 2


def close(got, want):
    key = lambda r: tuple(str(x) for x in r[:5]) + (round(r[5], 6), round(r[6], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], rel=1e-12)


@pytest.mark.parametrize(("order", "block_bytes", "shard_bytes"), [(1, 10, 50), (2, 100, 1 << 20), (3, 60, 200), (4, 1 << 20, 40)])
def test_scores_against_plain(spark, monkeypatch, order, block_bytes, shard_bytes):
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", shard_bytes)
    rows = made(order)
    docs = spark.createDataFrame(rows, "doc_id long, text string, trained boolean").selectExpr("*", "1 AS block", "2 AS n_tokens")
    got = ngram_lm.score_texts(docs, F.col("trained"), order=order, mass=3.0, block_bytes=block_bytes)
    close([tuple(r) for r in got.collect()], plain_scores(rows, order, 3.0))


def test_shares_of_a_context_sum_to_one(spark):
    """Over all known words, the end and one unknown word."""
    rows = [(i, t, True) for i, t in enumerate(["a b a c", "b a b", "c c a"])]
    words = ["a", "b", "c", "", "never"]
    asked = [(10 + i, f"a {w}", False) for i, w in enumerate(words)] + [(20, "a", False)]
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score_texts(spark.createDataFrame(rows + asked, "doc_id long, text string, t boolean"), F.col("t"), mass=2.0).collect()}
    plain = {r[0]: r[6] for r in plain_scores(rows + asked, 2, 2.0)}
    assert got == pytest.approx(plain, rel=1e-12)
    # log10 P(w | a) without the end's share after w, from a text of one word more.
    n, v = 13, 4
    after = {"a": 4, "b": 3, "c": 3, "never": 0}
    word = lambda w: (after[w] + 0.1) / (n + 0.1 * (v + 1))
    end = lambda w: ({"a": 1, "b": 1, "c": 1, "never": 0}[w] + 2 * 3.1 / (n + 0.1 * (v + 1))) / (after[w] + 2)
    first = (1 + 2 * word("a")) / 5
    shares = [10 ** got[10 + i] / first / end(w) for i, w in enumerate(words) if w]
    shares.append(10 ** got[20] / first)
    assert sum(shares) == pytest.approx(1, rel=1e-9)


def test_empty_table_and_no_training(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_lm.score_texts(none, F.lit(True)).count() == 0
    rows = [(1, "a b", False), (2, None, False)]
    got = ngram_lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string, t boolean"), F.col("t"))
    close([tuple(r) for r in got.collect()], plain_scores(rows))


def test_query_learns_from_all_that_is_not_held_out(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"], zlib.crc32(str(r["doc_id"]).encode()) % 10 != 0) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = [tuple(r) for r in QUERIES["op11_lm_score"](spark, sf).collect()]
    close([(r[0], not r[1], *r[2:]) for r in got], plain_scores(rows))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)
