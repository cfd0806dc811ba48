"""The corpus pipeline: language ID, near-dedup by five-word shingles, benchmark decontamination, secret scans, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each one's rows to the shared folder as Parquet and gives
the next stage what it reads there. All but the last return the columns of ``documents``.

Nulls and odd rows: a null or letterless text goes in the first stage. Rows that repeat an id or have none are near copies
of others by their texts only; a row with an id stays before one without. A text that a stage changes gets its new length as n_chars.
Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plazaflow.llm import decontaminate, language, near_copies, pieces, secrets
from plazaflow.llm._common import table
from plazaflow.llm.scratch import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language isn't clear, go."""
    return language.keep_identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return near_copies.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly such passages go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text."""
    return secrets.redact(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and their number."""
    return pieces.with_ids(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scans", secret_scans), ("sentencepiece", sentencepiece)]

#: Shingle hashes, the language model and BPE can't be written in SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
