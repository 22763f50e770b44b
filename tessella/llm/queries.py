"""Registered queries of the corpus operators: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessella.llm.balls import ball_kmeans
from tessella.llm.chunking import fingerprints
from tessella.llm.common import read_table
from tessella.llm.hilbert import hilbert_shards
from tessella.llm.html_text import extract_main_text
from tessella.llm.langid import language_id
from tessella.llm.lattice import encode_documents
from tessella.llm.media import text_media
from tessella.llm.minhash import near_duplicates
from tessella.llm.mixing import mix_sources
from tessella.llm.oracle import balls_sql, hilbert_sql, mixing_sql, near_duplicates_sql, similar_sets_sql
from tessella.llm.partenum import similar_sets
from tessella.llm.periodic import periodic_runs
from tessella.llm.token_counts import token_counts
from tessella.llm.toxicity import toxicity


def op1_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards along the Hilbert curve of source, language and size; law: rows."""
    return hilbert_shards(read_table(spark, sf_dir, "documents"), 24)


def op2_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of two-word shingles have a similarity of 0.8 or more."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=2, percent=80)


def op3_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every source read at least once, weights flattened as far as two readings of a row allow."""
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from the labels outside the held-out fifth."""
    return toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_media_sniffing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text as a wave file, told by its signature and read back."""
    return text_media(read_table(spark, sf_dir, "documents"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article text of every page."""
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression, learned outside the held-out third."""
    return language_id(read_table(spark, sf_dir, "documents"))


def op8_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk fingerprints of every document and its edited text, with containments."""
    return fingerprints(read_table(spark, sf_dir, "documents"))


def op9_sentencepiece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document under piece_bpe_32k.model, and whether they decode to the text."""
    return encode_documents(read_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under piece_bpe_32k.model."""
    return token_counts(read_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return periodic_runs(read_table(spark, sf_dir, "documents"))


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of the vectors after three rounds."""
    return ball_kmeans(read_table(spark, sf_dir, "embeddings"), k=16, rounds=3)


def op13_partenum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a similarity of 0.85 or more."""
    return similar_sets(read_table(spark, sf_dir, "documents"), words=4, percent=85)


QUERIES = {
    "op1_hilbert_sharding": op1_hilbert_sharding,
    "op2_minhash_forest": op2_minhash_forest,
    "op3_temperature_mixing": op3_temperature_mixing,
    "op4_toxicity": op4_toxicity,
    "op5_media_sniffing": op5_media_sniffing,
    "op6_html_main_text": op6_html_main_text,
    "op7_language_id": op7_language_id,
    "op8_chunk_fingerprints": op8_chunk_fingerprints,
    "op9_sentencepiece_lattice": op9_sentencepiece_lattice,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_ball_kmeans": op12_ball_kmeans,
    "op13_partenum_join": op13_partenum_join,
}
ORACLE: dict[str, str] = {
    "op1_hilbert_sharding": hilbert_sql(),
    "op2_minhash_forest": near_duplicates_sql(),
    "op3_temperature_mixing": mixing_sql(),
    "op12_ball_kmeans": balls_sql(),
    "op13_partenum_join": similar_sets_sql(),
}
