"""Every stage of the pipeline against plain versions of it, on the smallest tables."""

from collections import Counter

import pytest

import corpus_pipeline
from rollbook.llm.queries import TOKENIZER
from tests.llm.test_free import plain_components, plain_removed, words_of

SF_DIR = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.written(stage(spark, before, SF_DIR), name)
        kept[name] = after
        if name != "encode":
            assert after.columns == columns
        before = after
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}
    given, clean = texts(docs), texts(kept["toxicity"])
    assert clean.items() <= given.items() and len(clean) >= 0.8 * len(given)
    one = texts(kept["near_duplicates"])
    assert one == {i: clean[i] for _, i in plain_components(list(clean.items()), 5, 80).values()}
    cut = {i: words_of(t) for i, t in texts(kept["repeats"]).items()}
    assert cut == {i: w for i, (_, _, w) in plain_removed(list(one.items())).items()}
    mixed = kept["mix"].collect()
    taken = Counter()
    for r in mixed:
        taken[r["doc_id"]] += len(words_of(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert all(n <= 2 * len(cut[i]) for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(map(len, cut.values())), abs=40)
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=TOKENIZER)
    want = Counter((r["doc_id"], len(lib.encode(r["text"]))) for r in mixed)
    coded = kept["encode"].collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in coded) == want and all(r["exact"] for r in coded)


def test_run_is_all_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "mix", "encode"]
    assert corpus_pipeline.run.__doc__ and corpus_pipeline.ORACLE_SQL is None
