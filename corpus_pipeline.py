"""Training-corpus pipeline: each stage reads what its predecessor kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that ``run`` writes to the shared scratch folder as
Parquet and rereads as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from finseries.llm import decontaminate, langid, pii, sentencepiece, simhash
from finseries.llm.common import load, release, save


#: SentencePiece model of the last stage.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one clear language stay; those without letters or with no majority language go."""
    return langid.accepted(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (contract's shingle length and distance)."""
    return simhash.keep_first(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return decontaminate.clean(docs, load(spark, sf_dir, "benchmark"), window=10, k=6)


def redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by [KIND]; every document stays."""
    return pii.redact(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, round_trip."""
    return sentencepiece.encode_documents(docs, PIECE_MODEL)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("pii_redaction", redaction),
    ("sentencepiece_encoding", encoding),
]

#: SQL cannot express the stages (XXH64 fingerprints, trained models); see the brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), name)
        release(spark)
    return docs
