"""The queries of this subpackage, by name, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language, media, pieces, secrets, simhash, substring_dedup, suffix_tree, token_counts, urls
from ._common import table


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op2_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_features(media.store_text(table(spark, sf_dir, "documents")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.report(token_counts.count_tokens(table(spark, sf_dir, "documents")))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digest(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.report(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(simhash.near_duplicates(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_secret_scans, op2_media_columns, op3_language_id, op4_token_counts, op5_sentencepiece, op6_substring_dedup, op7_lm_scoring, op8_url_filters, op9_decontamination, op10_simhash)}

SQL = {"op6_substring_dedup": substring_dedup.SQL, "op9_decontamination": decontaminate.SQL}
