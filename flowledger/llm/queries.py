"""Registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, bpe, chat, ctw, decontaminate, embed_dedup, licenses, line_dedup, minhash, packing, quality, resample, spelling
from .common import read_table

BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.op1_query(read_table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.op2_query(read_table(spark, sf_dir, "documents"), BYTE_RANKS)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.op3_query(read_table(spark, sf_dir, "conversations"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.op4_query(read_table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.op5_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.op6_query(read_table(spark, sf_dir, "documents"))


def op7_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.op7_query(read_table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.op8_query(read_table(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.op9_query(read_table(spark, sf_dir, "embeddings"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.op10_query(read_table(spark, sf_dir, "documents"))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.op11_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.op12_query(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.op13_query(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_byte_bpe, op3_chat_format, op4_ann, op5_quality, op6_license_scan, op7_ctw, op8_packing, op9_embedding_dedup,
        op10_minhash_dedup, op11_decontamination, op12_importance_resampling, op13_spelling_variants,
    )
}
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE, "op3_chat_format": chat.ORACLE,
    "op11_decontamination": decontaminate.ORACLE, "op12_importance_resampling": resample.ORACLE, "op13_spelling_variants": spelling.ORACLE,
}
