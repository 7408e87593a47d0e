"""Corpus pipeline: rules, toxicity, near copies, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns of
documents; the last returns the pieces of the packed sequences.

What becomes of odd rows: null and empty texts have no words, so the first stage rejects them; stages called alone keep them (in
packing they are one piece, the end alone). Repeated rows pass the first two stages together, then one of them stays. Long texts are
read whole everywhere. Null ids, sources and labels, and columns with any names, change nothing. Empty tables give empty ones.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from readloom.llm import jaccard_join, packing, quality_rules, secrets, toxicity
from readloom.llm.store import cut, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the isolation forest."""
    return quality_rules.reject_anomalous(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return jaccard_join.deduplicate(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: Learnt verdicts, minwise samples and a tokenizer have no SQL form; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STAGES one after another over documents, each but the last written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
