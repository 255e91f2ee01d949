"""A pipeline over documents: each stage works on all that the one before it kept.

Toxic documents go; of each group of similar documents one stays; passages repeated across documents are
cut out of the later ones; sources are mixed to their weights; what is left is encoded into pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollbook.llm import jaccard, mixing, sentencepiece, substring, toxicity
from rollbook.llm.common import written
from rollbook.llm.queries import TOKENIZER


def _with_n_chars(docs: DataFrame) -> DataFrame:
    """The count of code points follows the text, where the table has one."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold, by a model fitted on labelled documents of this stage's input."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    scored = toxicity.score(docs, model, name="toxicity_score")
    return scored.filter(F.col("toxicity_score") < toxicity.THRESHOLD).drop("toxicity_score")


def near_duplicates_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that five-word shingles link at 0.8 or more, the document with the least doc_id."""
    return jaccard.keep_one(docs, gram=5, threshold=80)


def repeats_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that an earlier one has."""
    return _with_n_chars(substring.without_repeats(docs).drop("n_words", "n_removed"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents as often as it takes them, the one at a source's cut with its first words."""
    return _with_n_chars(mixing.repeat_documents(mixing.mix(docs), docs.columns))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per document of the mix: its tokens counted, their ids, and whether they decode to the text."""
    pieces, model = sentencepiece.piece_table(spark, TOKENIZER)
    return sentencepiece.encoded_and_checked(docs.select("doc_id", "text"), pieces, model)


STAGES = [
    ("toxicity", toxic_out),
    ("near_duplicates", near_duplicates_out),
    ("repeats", repeats_out),
    ("mix", mix_sources),
    ("encode", encode),
]

#: Trained scores, links and lattices are beyond SQL; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each result is written and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
