"""Toxicity, similarity join, substring dedup, SentencePiece, WARC and HTML against plain Python."""

import io
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from rollbook.llm import html_crf, jaccard, sentencepiece, substring, toxicity, warc
from rollbook.llm.components import components
from rollbook.llm.html_blocks import blocks
from rollbook.llm.html_pages import labelled_pages
from rollbook.llm.queries import TOKENIZER

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text):
    return WORD.findall((text or "").encode())


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


def synthetic(seed=1, n=60):
    """Texts with copies, near copies, shared passages, blanks of all kinds."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = []
    for i in range(n):
        w = [word() for _ in range(rng.choice([0, 1, 3, 12, 13, 30, 120]))]
        if i % 4 == 1 and texts:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = word()
        if i % 5 == 2:
            k = rng.randint(0, len(w))
            w[k:k] = passage[rng.randint(0, 10) : rng.randint(20, 40)]
        texts.append("".join(x + rng.choice([" ", "\n", " \t", "\x0b"]) for x in w))
    return [(rng.randrange(10**6) * 100 + i, t) for i, t in enumerate(texts)]


EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "word"), (5, "word"), (6, "x " * 5000), (7, "x " * 5000), (8, "\x85 \xa0 é"), (8, "\x85 \xa0 é")]


# ---------------------------------------------------------------- n-gram join


def plain_components(rows, gram, threshold):
    low = lambda w: bytes(c + 32 if 65 <= c <= 90 else c for c in w)
    sets = {}
    for i, t in rows:
        w = [low(x) for x in words_of(t)]
        sets[i] = {tuple(w[k : k + gram]) for k in range(len(w) - gram + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= threshold * len(x | y):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("gram", "threshold", "seed"), [(4, 85, 1), (2, 60, 2)])
def test_similar_sets_lose_no_link(spark, gram, threshold, seed):
    rows = synthetic(seed, 90) + [(5, "One two THREE four five"), (3, "one TWO three four five")]
    got = jaccard.similar_sets(frame(spark, rows), gram, threshold).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == plain_components(rows, gram, threshold)


@pytest.mark.parametrize("block", [256, 3])
def test_similar_sets_count_every_link(spark, monkeypatch, block):
    """Links inside a component as well, copies and near copies of near copies."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(60)]
    near = [(100 + i, " ".join(base[:k] + [f"v{i}"] + base[k + 1 :])) for i, k in enumerate([0, 0, 1, 2, 20, 40, 58, 59, 59])]
    rows = synthetic(3, 60) + near + [(i + 50, t) for i, t in near[:4]] + [(1, None), (2, "one two"), (3, "ONE  two")]
    rng.shuffle(rows)
    low = lambda b: bytes(c + 32 if 65 <= c <= 90 else c for c in b)
    sets = {}
    for i, t in rows:
        w = [low(x) for x in words_of(t)]
        sets[i] = {tuple(w[k : k + 4]) for k in range(len(w) - 3)} or ({tuple(w)} if w else set())
    links = dict.fromkeys(sets, 0)
    for a, b in itertools.permutations(sets, 2):
        x, y = sets[a], sets[b]
        links[a] += bool(x and y and 100 * len(x & y) >= 85 * len(x | y))
    got = {r["doc_id"]: r["n_links"] for r in jaccard.similar_sets(frame(spark, rows)).collect()}
    assert got == links and max(links.values()) > 5


def test_similar_sets_of_ids_with_several_texts(spark):
    """Each text of an id is compared, and all count as linked through it."""
    base = [f"w{i}" for i in range(80)]
    one, two = " ".join(base), " ".join(f"u{i}" for i in range(80))
    rows = [(1, one), (1, two), (2, one + " x"), (3, two + " x"), (5, "a b c d e"), (7, "a b c d e"), (7, "k l m n o"), (6, "k l m n o")]
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in jaccard.similar_sets(frame(spark, rows)).collect()}
    assert {k[0]: v for k, v in got.items()} == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5}


def test_chain_of_links_is_one_component(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base[:k] + [f"v{k}"] + base[k + 1 :] if k else base)) for i, k in enumerate([0, 5, 20, 35, 50])]
    rows = [(9 - i, t) for i, t in rows]
    got = {r["doc_id"]: r["component_id"] for r in jaccard.similar_sets(frame(spark, rows)).collect()}
    assert got == {k: v[1] for k, v in plain_components(rows, 4, 85).items()} and set(got.values()) == {5}


def test_similar_sets_of_odd_rows(spark):
    got = jaccard.similar_sets(frame(spark, [*EDGE, (None, "word")]).withColumn("n", F.lit(1)).withColumn("component_id", F.lit(2))).collect()
    assert len(got) == len(EDGE) + 1
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert (by[1], by[2], by[3], by[4], by[5], by[6], by[7]) == (1, 2, 3, 4, 4, 6, 6)
    assert by[None] is None
    assert jaccard.similar_sets(frame(spark, [])).count() == 0
    kept = jaccard.keep_one(frame(spark, EDGE).withColumn("similar_id", F.lit(0)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 3, 4, 6, 8]


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200 + i, 201 + i) for i in range(40)]
    root = {}
    find = lambda i: i if root.setdefault(i, i) == i else find(root[i])
    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {i: find(i) for i in root if any(a != b and i in (a, b) for a, b in links)}


# ---------------------------------------------------------------- substring


def plain_removed(rows, window=13):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        w = words_of(t)
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k : k + window]), i)
    out = {}
    for i, t in rows:
        w = words_of(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), [x for k, x in enumerate(w) if k not in gone])
    return out


@pytest.mark.parametrize(("seed", "hot"), [(1, 200), (2, 2), (3, 4)])
def test_repeated_spans_go(spark, seed, hot, monkeypatch):
    monkeypatch.setattr(substring, "HOT_ROWS", hot)
    rows = synthetic(seed, 80)
    got = substring.without_repeats(frame(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], words_of(r["text"])) for r in got} == plain_removed(rows)
    same = dict(rows)
    assert all(r["text"] == same[r["doc_id"]] for r in got if not r["n_removed"])


def test_forms_of_a_hot_anchor_meet_in_no_task(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_ROWS", 4)
    # One passage in contexts that differ from document to document: a form of its own for each.
    passage = " ".join(f"p{i}" for i in range(15))
    rows = [(i, " ".join(f"a{i}x{j}" for j in range(9)) + f" {passage} " + " ".join(f"b{i}x{j}" for j in range(9))) for i in range(30)]
    docs = frame(spark, rows).withColumn("th", F.xxhash64("text"))
    spans, _ = substring._found_spans(docs, substring.WINDOW, substring.RUN)
    # Only the pieces of usual anchors are handed to Python by group.
    assert spans._jdf.queryExecution().optimizedPlan().toString().count("FlatMapGroupsInArrow") == 1
    got = {r["doc_id"]: sum(s["n"] for s in r["spans"]) for r in spans.collect()}
    assert got == {i: 3 for i in range(1, 30)}


def test_automaton_finds_first_documents():
    rng = random.Random(4)
    for _ in range(40):
        texts = [[rng.choice("ab") for _ in range(rng.randint(3, 14))] for _ in range(6)]
        shard, first = substring.Automaton(), {}
        for doc, t in enumerate(texts):
            shard.add(t, doc)
            for k in range(len(t) - 2):
                first.setdefault(tuple(t[k : k + 3]), doc)
        for t in [*texts, list("abbaabab")]:
            assert shard.first_documents(t, 3) == [first.get(tuple(t[k : k + 3]), -1) for k in range(len(t) - 2)]


def test_substring_of_odd_rows(spark):
    rows = [*EDGE, (None, "x " * 40)]
    got = substring.without_repeats(frame(spark, rows).withColumn("spans", F.lit(1)).withColumn("N_words", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["text"] is None and by[7]["n_removed"] == 5000 and by[6]["n_removed"] == 0 and by[None]["n_removed"] == 0
    assert substring.without_repeats(frame(spark, [])).count() == 0


# ---------------------------------------------------------------- toxicity


def test_unseen_spellings_are_caught(spark):
    rng = random.Random(6)
    lexicon = ["".join(rng.choice("aeioukltrn") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    clean = lambda n: [rng.choice(lexicon) for _ in range(n)]
    rows, labels = [], []
    for i in range(600):
        w = clean(rng.randint(20, 200))
        if i % 4 == 0:
            for _ in range(3):
                w[rng.randrange(len(w))] = "grumzwick" + rng.choice(["", "s", "er", "ly"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(i % 4 == 0)))
    docs = frame(spark, rows)
    model = toxicity.train(docs, frame(spark, labels, "doc_id long, toxic int"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    right = sum((scored[i] >= toxicity.THRESHOLD) == t for i, t in labels)
    assert right >= 0.97 * len(labels)
    probe = [(1, " ".join([*clean(3000), "grumzwickest", "grumzwicky", *clean(3000)])), (2, " ".join(clean(6000))), (3, None), (4, ""), (4, ""), (5, "grumzwickers " * 3)]
    odd = frame(spark, probe).withColumn("score", F.lit("clash")).withColumn("SCORE_TEXT", F.lit(1))
    got = {r["doc_id"]: r["score"] for r in toxicity.score(odd, model).collect()}
    assert got[1] >= toxicity.THRESHOLD > got[2] and got[5] >= toxicity.THRESHOLD
    assert got[3] == got[4] < toxicity.THRESHOLD
    assert toxicity.score(frame(spark, []), model).count() == 0


def test_scores_are_those_of_plain_python():
    """The highest mean over two halves of a text, each n-gram bag and mean spelled out."""
    from rollbook.llm.hashing import mixed

    rng = np.random.default_rng(3)
    model = {"adds": rng.standard_normal(toxicity.BUCKETS), "bias": -0.4}

    def word_logit(w):
        line, found = [ord("<"), *w.encode(), ord(">")], []
        for n in toxicity.GRAMS:
            for k in range(len(line) - n + 1):
                v = 0
                for c in line[k : k + n]:
                    v = (v * 257 + c) % 2**64
                found.append(int(mixed(np.array([(v * 8 + n) % 2**64], np.uint64))[0]) % toxicity.BUCKETS)
        return sum(model["adds"][g] for g in found) / max(1, len(found))

    def plain(text):
        w = text.split()
        n = max(1, len(w) // toxicity.HALF)
        halves = [w[k * toxicity.HALF : (k + 1) * toxicity.HALF if k < n - 1 else None] for k in range(n)]
        adds = [sum(word_logit(x) for x in set(h)) for h in halves]
        best = max(
            (adds[k] + (adds[k + 1] if k + 1 < n else 0)) * toxicity.FULL / max(1, len(halves[k]) + (len(halves[k + 1]) if k + 1 < n else 0))
            for k in range(n)
        )
        return 1 / (1 + np.exp(-np.clip(best + model["bias"], -30, 30)))

    texts = ["", "a", "bad bad", " ".join(f"w{k % 17}é" for k in range(39)), " ".join(f"x{k}" for k in range(40)), " ".join(f"y{k % 50}" for k in range(131))]
    assert toxicity.scores(model, pa.array(texts)) == pytest.approx([plain(t) for t in texts], rel=1e-9)


def test_held_out_rows_are_never_trained_on(spark):
    import zlib

    docs = frame(spark, [(i, f"text {i}") for i in range(200)])
    labels = frame(spark, [(i, i % 2) for i in range(200)] + [(None, 1), (3, None), (5, 7)], "doc_id long, toxic int")
    rows = toxicity.training_rows(docs, labels, most=40).collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 for r in rows)
    assert Counter(r["label"] for r in rows) == {0: 40, 1: 40}
    empty = toxicity.train(docs, labels.filter("toxic = 0"))
    assert {round(r["score"], 3) for r in toxicity.score(docs, empty).collect()} == {0.05}


# ---------------------------------------------------------------- sentencepiece


TEXTS = [
    "a b", "  a  b ", "a\nb", "\ta", "é x", "ａ日本", "", None, "▁a", " ", "日本語 test", "a\n\n b \n", "x" * 300 + " y", "   ",
    "internationalization of tokenizers 12345678", "ab" * 200 + "日" * 70, "🎉🎉 hi", "a b", "<s>hi</s><0x0A><unk>",
]


def test_ids_equal_the_library_and_decode(spark):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=TOKENIZER)
    pieces, model = sentencepiece.piece_table(spark, TOKENIZER)
    assert model["kind"] == "bpe"
    texts = TEXTS + [t for _, t in synthetic(3, 30)]
    docs = frame(spark, list(enumerate(texts))).withColumn("IDS", F.lit("clash"))
    coded = sentencepiece.encode(docs, pieces, model)
    got = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert got == {i: lib.encode(t or "") for i, t in enumerate(texts)}
    back = {r["doc_id"]: r["text"] for r in sentencepiece.decode(coded, pieces, model, "doc_id").collect()}
    assert back == {i: (t or "").replace("▁", " ") for i, t in enumerate(texts)}


def test_ids_by_lattice_or_merges_and_in_small_blocks(spark, monkeypatch):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=TOKENIZER)
    pieces, model = sentencepiece.piece_table(spark, TOKENIZER)
    rows = list(enumerate(TEXTS)) + [(0, "a b"), (7, None), (None, "a b")]
    want = Counter((i, *lib.encode(t or "")) for i, t in rows)
    for most, size in ((150_000, 1 << 22), (5, 1 << 22), (5, 7)):
        monkeypatch.setattr(sentencepiece, "BROADCAST_SEGMENTS", most)
        monkeypatch.setattr(sentencepiece, "SLICE_BYTES", size)
        coded = sentencepiece.encode(frame(spark, rows), pieces, model)
        assert Counter((r["doc_id"], *r["ids"]) for r in coded.collect()) == want
        back = sentencepiece.with_decoded(coded, pieces, model, "back").collect()
        assert all(r["back"] == (r["text"] or "").replace("▁", " ") for r in back)
    assert sentencepiece.encode(frame(spark, []), pieces, model).count() == 0


def test_segments_cut_in_tasks_are_those_of_the_expression(spark):
    rng = random.Random(9)
    texts = TEXTS + ["".join(rng.choice("a é\n▁日") for _ in range(rng.randint(0, 30))) for _ in range(300)]
    want = [r[0] for r in frame(spark, list(enumerate(texts))).orderBy("doc_id").select(sentencepiece.segments(F.col("text"))).collect()]
    column, ends = sentencepiece._cut(pa.array(texts, pa.string()))
    flat = [s.replace(" ", "▁") for s in column.to_pylist()]
    starts = [0, *ends.tolist()]
    assert [flat[x:y] for x, y in zip(starts, starts[1:], strict=False)] == want


def test_decode_of_null_lists_and_unknown_ids(spark):
    pieces, model = sentencepiece.piece_table(spark, TOKENIZER)
    rows = spark.createDataFrame([(1, None), (2, []), (3, [-5, 10**9]), (4, [300, 301])], "k int, ids array<int>")
    got = {r["k"]: r["text"] for r in sentencepiece.decode(rows, pieces, model, "k").collect()}
    assert got[1] == got[2] == got[3] == "" and got[4]


def test_query_gives_ids_that_decode(spark, tmp_path):
    from rollbook.llm.queries import op9_sentencepiece

    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=TOKENIZER)
    rows = list(enumerate(TEXTS)) + [(0, "a b"), (7, None), (None, "a b")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = op9_sentencepiece(spark, str(tmp_path)).collect()
    want = Counter((i, tuple(lib.encode(t or "")), "▁" not in (t or "")) for i, t in rows)
    assert Counter((r["doc_id"], tuple(r["ids"]), r["exact"]) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)


def test_viterbi_fold_finds_the_best_path(spark):
    rng = random.Random(8)
    table = {p: -rng.uniform(1, 6) for p in ["▁", "a", "b", "c", "ab", "bc", "abc", "▁a", "▁ab", "ca", "cab"]}
    pieces = spark.createDataFrame([(p, i, s, 0) for i, (p, s) in enumerate(table.items())], "piece string, id int, score double, rank int")
    model = {"byte_base": None, "unknown": 99, "kind": "unigram"}
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 9))) for _ in range(40)] + ["azb"]
    got = {r["text"]: r["ids"] for r in sentencepiece.encode(frame(spark, list(enumerate(texts))), pieces, model).collect()}
    names = list(table)

    def best(s):
        if not s:
            return 0.0, []
        options = [(best(s[k:]), table[s[:k]], names.index(s[:k])) for k in range(1, len(s) + 1) if s[:k] in table]
        options += [(best(s[1:]), -1000.0, 99)] if s[0] not in table else []
        return max((r[0] + v, [i, *r[1]]) for r, v, i in options)

    for t in texts:
        score = lambda ids: sum(table[names[i]] if i != 99 else -1000 for i in ids)
        assert score(got[t]) == pytest.approx(best("▁" + t)[0])


# ---------------------------------------------------------------- WARC


def test_archives_round_trip(spark, tmp_path):
    pages = [(i, f"http://x/{i}\n%", "<p>same</p>" if i % 5 == 0 else f"<p>é{i}</p>" * (i + 1)) for i in range(120)]
    pages += [(500, None, None), (501, "u", ""), (None, "u", "<p>alone</p>"), (None, "u", "<p>same</p>"), (119, "again", "<p>é119</p>" * 120)]
    archives = warc.write_archives(frame(spark, pages, "page_id long, url string, html string").repartition(3), archive_bytes=5000)
    for r in archives.collect():
        (tmp_path / r["archive"]).write_bytes(r["content"])
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    got = warc.read_archives(files).collect()
    assert len(got) == len(pages) and len({r["archive"] for r in got}) > 5
    last = {}
    for i, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    rows = Counter()
    for i, u, h in pages:
        h = h or ""
        revisit = last[h] >= 0 and i != last[h]
        rows[(f"<urn:page:{'' if i is None else i}>", u, "revisit" if revisit else "response", len(h.encode()), warc.digest(h.encode()), f"<urn:page:{last[h]}>" if revisit else None)] += 1
    assert Counter((r["record_id"], r["uri"], r["record_type"], r["payload_bytes"], r["payload_digest"], r["refers_to"]) for r in got) == rows
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in got)


def test_short_payloads_are_all_responses(spark):
    pages = frame(spark, [(1, "a", "xx"), (2, "b", "xx"), (3, "c", "xxxx"), (4, "d", "xxxx")], "page_id long, url string, html string")
    got = warc.read_archives(warc.write_archives(pages, least_bytes=3)).collect()
    assert {r["record_id"][10:-1]: r["record_type"] for r in got} == {"1": "response", "2": "response", "3": "revisit", "4": "response"}
    assert warc.read_archives(warc.write_archives(pages.filter("page_id > 9"))).count() == 0


def test_wrong_records_are_refused():
    raw = warc.record("response", "<urn:page:1>", "u", b"hello", None, warc.digest(b"hello"))
    assert warc.parse_record(raw)["payload"] == b"hello"
    for wrong in (raw[:-1], raw.replace(b"hello", b"jello"), raw.replace(b"WARC/1.1", b"WARC/9"), raw.replace(b"WARC-Date", b"WARC-Data"), raw + b"x"):
        with pytest.raises(ValueError):
            warc.parse_record(wrong)
    whole = warc.archive([raw] * 3)
    assert list(warc.frames(whole)) == [raw] * 3
    with pytest.raises(ValueError, match="cut off"):
        list(warc.frames(whole[:-3]))
    plain = io.BytesIO()
    plain.write(zstandard.ZstdCompressor().compress(raw))
    assert list(warc.frames(plain.getvalue())) == [raw]


# ---------------------------------------------------------------- HTML


@pytest.fixture(scope="module")
def model():
    return html_crf.train(labelled_pages(300))


def test_held_out_pages(model):
    right = total = 0
    for page in labelled_pages(150, seed=77):
        b = blocks(page)
        y = html_crf.viterbi([sum(model["weights"].get(x, 0.0) for x in f) for f in html_crf.features(b)], model["step"])
        right += sum(bool(p) == q.labelled for p, q in zip(y, b, strict=True))
        total += len(b)
    assert right >= 0.97 * total


def test_viterbi_is_the_best_of_all_sequences():
    rng = np.random.default_rng(1)
    for n in range(1, 8):
        s, step = rng.normal(size=n).tolist(), rng.normal(size=(2, 2)).tolist()
        value = lambda y: sum(a for a, b in zip(s, y, strict=True) if b) + sum(step[a][b] for a, b in zip(y, y[1:], strict=False))  # noqa: E731, B023
        assert value(html_crf.viterbi(s, step)) == pytest.approx(max(map(value, itertools.product((0, 1), repeat=n))))


def test_blocks():
    html = '<title>t</title><style>p{}</style><p>A &amp; <b>b\n c<br>d<p>e<ul><li>f<li>g</ul><script>"<p>"</script>h<!-- <p>x</p> --> i<div>j</div>k<3 &lt;l'
    assert [b.text for b in blocks(html)] == ["A & b c d", "e", "f", "g", "h i", "j", "k<3 <l"]
    assert [b.text for b in blocks("plain  text")] == ["plain text"]
    assert blocks(None) == blocks("") == blocks("<p> </p>") == []
    blocks("<p " + "a='" * 20000), blocks("<" * 20000), blocks("<div>" * 3000 + "x")


def test_extract(spark, model):
    page = (
        '<html><head><title>T</title></head><body><nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>'
        '<div class="ad">Buy this now, it is cheap.</div><article><h1>The title</h1><p>First text, with &eacute; and more words in it.</p>'
        '<p>Second   one,\nlonger than that.</p></article><section class="comments"><p>Nice text, thank you!</p></section><footer>&copy; me</footer></body></html>'
    )
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (3, "u", ""), (4, "u", "<script>x</script>")]
    got = html_crf.extract(frame(spark, rows, "page_id long, url string, html string").withColumn("Text", F.lit(5)), model).collect()
    texts = {r["page_id"]: (r["text"], r["n_chars"]) for r in got}
    want = "The title\n\nFirst text, with é and more words in it.\n\nSecond one, longer than that."
    assert len(got) == 5 and texts[1] == (want, len(want)) and texts[2] == texts[3] == texts[4] == ("", 0)
    assert html_crf.extract(frame(spark, [], "page_id long, url string, html string"), model).count() == 0


def test_formulas_and_fallbacks_of_an_article_are_text():
    page = "<article><p>The area is <math><mi>x</mi><mo>=</mo><mn>2</mn></math> in this case.</p><object><p>A film of it.</p></object></article>"
    assert [b.text for b in blocks(page)] == ["The area is x=2 in this case.", "A film of it."]


def test_encoding_and_checking_take_one_worker_a_task(spark):
    rows = [(1, None), (2, ""), (3, "Plain words,  twice words"), (4, "a▁b"), (5, "line\n\n two é")]
    pieces, model = sentencepiece.piece_table(spark, TOKENIZER)
    got = sentencepiece.encoded_and_checked(frame(spark, rows), pieces, model)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    coded = {r["doc_id"]: r["ids"] for r in sentencepiece.encode(frame(spark, rows), pieces, model).collect()}
    assert {r["doc_id"]: (r["ids"], r["exact"]) for r in got.collect()} == {i: (coded[i], i != 4) for i, _ in rows}
