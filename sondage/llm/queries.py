"""Registered queries of the operators, with the SQL that checks them where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sondage.llm import (
    bpe, decontaminate, divergence, embeddings, language_model, minhash, oracles, piece_model, quality, resample, suffix, token_files, toxicity, urls,
)
from sondage.llm.tables import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
END_OF_DOCUMENT = 50256

# The listed hosts and opening paths of the URL query.
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)


def op1_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(table(spark, folder, "documents"), TOKENIZER)


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scores(table(spark, folder, "documents"))


def op7_urls(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = urls.judge(pages, urls.rule_table(spark, URL_RULES))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.document_counts(table(spark, folder, "documents"), TOKENIZER, END_OF_DOCUMENT)


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffix.digests(table(spark, folder, "documents"))


def op11_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op12_piece_model(spark: SparkSession, folder: str) -> DataFrame:
    return piece_model.round_trip(table(spark, folder, "documents"), RANKS, public_tokenizers.PATTERN)


def op13_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"))


QUERIES = {
    "op1_embeddings": op1_embeddings, "op2_bpe": op2_bpe, "op3_minhash": op3_minhash, "op4_toxicity": op4_toxicity,
    "op5_quality": op5_quality, "op6_language_model": op6_language_model, "op7_urls": op7_urls,
    "op8_token_counts": op8_token_counts, "op9_decontamination": op9_decontamination, "op10_suffixes": op10_suffixes,
    "op11_resampling": op11_resampling, "op12_piece_model": op12_piece_model, "op13_divergence": op13_divergence,
}
#: The others learn, draw or compress what SQL cannot; tests/llm compares them with plain versions.
ORACLES = {
    "op1_embeddings": oracles.EMBEDDINGS, "op3_minhash": oracles.MINHASH, "op7_urls": oracles.urls(URL_RULES),
    "op11_resampling": oracles.resample(resample.LEAST_WORDS, resample.PERCENT, resample.BUCKETS, resample.SEED),
    "op13_divergence": oracles.divergence(divergence.LEAST_DOCUMENTS, divergence.PLACES),
}
