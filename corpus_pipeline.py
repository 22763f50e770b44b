"""The corpus pipeline: toxicity, language, near-duplicates, mixture, encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result to the shared folder as Parquet and reads it back as the next
stage's docs. All but the last return the columns of docs.

* toxicity: documents predicted toxic go; the model learns from the labels of the documents at hand. With fewer than five labels of a class none goes.
* language: documents without letters go, and documents of 100 bytes or more that two languages' dictionaries compress alike (a text of one phrase repeated, say).
* near_duplicates: of each group of similarity 0.8 or more over five-word shingles the document of smallest doc_id stays.
* mixture: no document goes; documents of small sources are repeated, up to MAX_REPEATS readings, so that weights are flatter than the sources' shares.
* encoding: token ids of every row.

Defined cases: null and empty texts, which have no language, go in the second stage; rows without doc_id are never labelled, never near-duplicates, and stay; rows
sharing a doc_id stay or go together; further columns of any name pass through to the last stage; an empty documents table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm.common import materialise, read_table
from tessella.llm.langid import with_known_language
from tessella.llm.lattice import encode_documents
from tessella.llm.minhash import deduplicated
from tessella.llm.mixing import mixed_documents
from tessella.llm.toxicity import without_toxic

MAX_REPEATS = 1.5


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return with_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return deduplicated(docs, words=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture reads them."""
    return mixed_documents(docs, max_repeats=MAX_REPEATS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row."""
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("encoding", encoding),
]

# Trained models, signatures and merges are beyond SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
