"""Queries of the operators, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (alignment, forest_dedup, mixing, oracles, phrases, pieces, quality_crf, secret_scan, sharding, simhash,
                        suffix_dedup, token_files, url_filter, winnowing)
from strata.llm.common import read_table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(read_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_rows(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.choose(read_table(spark, sf_dir, "documents"))


def op4_forest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest_dedup.groups(read_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.edit_likeness(read_table(spark, sf_dir, "documents"), F.col("doc_id") % 100 == 0)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(read_table(spark, sf_dir, "documents"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"),
                                   digests=True)


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return quality_crf.judge_documents(docs, *quality_crf.fit_field(docs, labels))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read_table(spark, sf_dir, "pages"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                           public_tokenizers.path("piece_bpe_32k.model"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_secret_scan, op2_token_files, op3_mixing, op4_forest_dedup, op5_simhash, op6_suffix_dedup,
    op7_sharding, op8_pieces, op9_quality_crf, op10_url_filter,
    op11_alignment, op12_winnowing, op13_phrases)}
ORACLES: dict[str, str] = {"op3_mixing": oracles.mixing_sql(), "op7_sharding": oracles.sharding_sql(), "op10_url_filter": oracles.url_filter_sql(),
                           "op12_winnowing": oracles.winnowing_sql(), "op13_phrases": oracles.phrases_sql()}
